"""Evidence of advertising and scan logs over grids: verdicts of every source, their fold, candidates, chains, groups."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import AFFILIATE_NAMES, CODE_NAMES, DEFAULT, TRACKER_NAMES
from tessera.operators import chains, evidence, groups, scan
from tessera.plans.inputs import GRID, flag, grid, nothing, number, pick, read, sql_flag, sql_number, sql_pick
from tessera.plans.q_urls import s_has, s_host, s_hostname, s_part, s_ref
from tessera.plans.registry import query

OWN = dataclasses.replace(DEFAULT, ref_hosts=("known.example",), own_refs=("own.example/mine",))
#: Links, where they end, what they are, and how they were found.
URLS = ("https://trk.example/Zx9Qa", "https://plain.example/p", "https://go.acme.com/Ab3d", "https://globex.example/?btag=1", "https://sister-acme.example/", "https://s.example/get.apk", "https://s.example/go", "https://x.example/a\\u0026b=1", "https://known.example/x")
FINALS = ("https://globex.example/play", "https://plain.example/end", "https://www.reviews.example/r", "https://acme-mb.example/?pid=5", "")
KINDS = ("other", "topic_site", "target", "unknown", "needs_browser", "dead", "download", "off_topic")
VIAS = ("a", "home_redirect", "js:script", "js:data-modal", "external")
BRANDS = ("Globex", "?", "", "Umbra")
EVIDENCE = ("fields:x", "name_only", "download:zip")
RIVALS = (("Globex", "globex"), ("Initech", "initech|ini-tech"), ("Umbra", "umbra\\s?corp"), ("Hooli", "\\bhooli"))


def s_name(h: str) -> str:
    """Whom a host names."""
    return f"(CASE WHEN regexp_matches({h}, '(?i)acme') THEN 'Acme' " + " ".join(f"WHEN regexp_matches({h}, '(?i){rx}') THEN '{n}'" for n, rx in RIVALS) + " ELSE '' END)"


def s_coded(q: str) -> str:
    return f"({s_has(q, AFFILIATE_NAMES)} OR {s_has(q, TRACKER_NAMES)} OR {s_has(q, CODE_NAMES)})"


DESTS = f"""
g AS ({GRID}), a AS (SELECT k, 'd' || k % 3000 || '.example' AS domain, {sql_pick(0, 2, URLS)} AS url, {sql_pick(0, 8, FINALS)} AS f, {sql_pick(0, 13, KINDS)} AS kind, {sql_pick(1, 2, VIAS)} AS via, {sql_pick(1, 7, BRANDS)} AS brand, {sql_pick(1, 11, EVIDENCE)} AS ev, {sql_flag(1, 15, 5)} AS pid, {sql_flag(2, 2, 3)} AS route, {sql_flag(2, 6, 3)} AS hop, {sql_flag(2, 10, 4)} AS dead_code FROM g),
b AS (SELECT *, {s_host("url")} AS h, {s_hostname("url")} AS hn, {s_part("url", 3)} AS p, {s_part("url", 4)} AS q, {s_host("f")} AS t, {s_part("f", 4)} AS fq FROM a),
c AS (SELECT *, {s_coded("q")} OR {s_coded("fq")} AS coded, hop AND 'hop.example' NOT IN (h, t) AS passed, kind IN ('other', 'topic_site') AS trade, kind IN ('unknown', 'needs_browser', 'dead') AS open_, brand NOT IN ('', '?') AS known, {s_name("t")} AS by_host, t <> 'reviews.example' AS business, coalesce(nullif(t, ''), h) AS end_,
  {s_ref("url", "hn", "p", "q", "domain")} AS rk, h = 'trk.example' AS tracker FROM b),
d AS (SELECT *, coalesce(rk IN ('known_ref_host', 'brand_host') OR (rk = 'ref' AND (regexp_matches(h, '(acm|acme)\\.[a-z]+$') OR h = 'known.example')), false) AS bref, by_host NOT IN ('', 'Acme') AS oper FROM c),
v AS (SELECT *, CASE WHEN via = 'home_redirect' THEN 1 WHEN p IN ('/go', '/out/') AND via LIKE 'js:%' THEN 2 WHEN ends_with(p, '.apk') OR kind = 'download' OR ev LIKE 'download%' THEN 3 WHEN (open_ OR kind = 'off_topic') AND contains(h, 'acme') AND q = '' THEN 4 WHEN via = 'js:data-modal' THEN 5 WHEN contains(url, '\\u0026') THEN 6
  WHEN via LIKE 'js:%' AND trade AND dead_code THEN 7 WHEN tracker AND NOT trade THEN 8 WHEN bref THEN 9 WHEN kind = 'target' AND (pid OR coded OR (passed AND ev <> 'name_only')) THEN 10 WHEN kind = 'target' THEN 11 WHEN trade AND (coded OR passed) THEN 12 WHEN kind = 'other' AND known AND oper AND business THEN 13 WHEN trade AND contains(h, 'acme') THEN 14
  WHEN kind = 'other' AND business THEN 15 WHEN kind = 'other' THEN 16 WHEN kind = 'topic_site' AND oper AND business THEN 17 WHEN kind = 'topic_site' AND business THEN 18 WHEN open_ AND coded AND (regexp_matches(end_, '(acm|acme)\\.[a-z]+$') OR end_ = 'known.example') THEN 19 WHEN open_ AND coded AND NOT contains(end_, 'acme') THEN 20 WHEN open_ AND (passed OR route) THEN 21 ELSE 0 END AS rule FROM d),
w AS (SELECT k, domain, 1 AS source, k AS ordinal, url, f, CASE WHEN rule IN (8, 9, 10, 19) THEN 'target' WHEN rule IN (12, 13, 17, 20) THEN 'other' WHEN rule IN (15, 18) THEN 'plain' WHEN rule = 21 THEN 'unverified' ELSE 'none' END AS side,
  CASE WHEN rule IN (8, 9, 10, 19) THEN 'Acme' WHEN rule = 12 THEN CASE WHEN known THEN brand ELSE coalesce(nullif({s_hostname("f")}, ''), '?') END WHEN rule = 13 THEN brand WHEN rule = 17 THEN by_host WHEN rule = 15 THEN t WHEN rule = 18 THEN {s_hostname("f")} WHEN rule = 20 THEN end_ ELSE '' END AS name FROM v)
"""


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    hops = F.when(flag(2, 6, 3), F.array(F.lit("https://hop.example/1"))).otherwise(nothing())
    return grid(spark, sf_dir, wide=True).select(
        "k",
        F.concat(F.lit("d"), F.pmod("k", F.lit(3000)).cast("string"), F.lit(".example")).alias("domain"),
        F.col("k").alias("ordinal"),
        pick(0, 2, URLS).alias("url"),
        pick(0, 8, FINALS).alias("final_url"),
        pick(0, 13, KINDS).alias("kind"),
        pick(1, 2, VIAS).alias("via"),
        pick(1, 7, BRANDS).alias("brand"),
        pick(1, 11, EVIDENCE).alias("evidence"),
        F.when(flag(1, 15, 5), "5").otherwise("").alias("pid"),
        flag(2, 2, 3).alias("ad_route"),
        hops.alias("hops"),
        (~flag(2, 10, 4)).alias("live"),
    )


def known_trackers(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('trk.example'), ('other-trk.example') AS (host)")


@query(f"WITH {DESTS} SELECT k, side, name FROM w")
def destination_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC14, JN12: whom each destination is evidence of."""
    found = evidence.destination_verdicts(destinations(spark, sf_dir), known_trackers(spark), OWN)
    return found.select("k", "side", "name")


REFS = ("https://own.example/mine", "https://go.acme.com/Ab3d", "https://trk.example/Zx9Qa", "https://bcdfg.example/Qq1w", "https://plain.example/x", "https://globex.example/Zz9p")
CHAINS = (("https://d.example/go", "https://globex.example/x"), ("https://d.example/go", "https://trk.example/Zx9Qa"), ("https://d.example/go", "https://acme-fan.example/"), ("https://d.example/go", "https://plain.example/?btag=2"), ("https://d.example/go", "https://consent.some.example/"), ("https://d.example/go",), ("https://d.example/go", "https://bcdfg.example/Qq1w9"), ("https://d.example/go", "https://calmer.example/page"), ("https://d.example/go", "https://titled.example/page"))
PAGE_LINKS = (("https://own.example/mine", "own.example", "", ""), ("https://go.acme.com/Ab3d", "go.acme.com", "Acme", "ref"), ("https://trk.example/Zx9Qa", "trk.example", "", ""), ("https://bcdfg.example/Qq1w", "bcdfg.example", "", "ref"), ("https://globex.example/", "globex.example", "Globex", ""), ("https://plain.example/?btag=1", "plain.example", "", ""), ("https://acme-b.example/?btag=1", "acme-b.example", "", ""), ("https://plain.example/", "plain.example", "", ""), ("https://x.example/\\u0026", "x.example", "Umbra", ""))
REF_SIDES = ("ours", "target", "target", "other", "none", "other")
REF_NAMES = ("Acme", "Acme", "Acme", "via bcdfg.example", "", "Globex")
CHAIN_SIDES = ("other", "target", "none", "other", "none", "none", "other", "unverified", "none")
CHAIN_NAMES = ("Globex", "Acme", "", "plain.example", "", "", "via bcdfg.example", "", "")
LINK_SIDES = ("ours", "target", "target", "other", "other", "other", "none", "unverified", "none")
LINK_NAMES = ("Acme", "Acme", "Acme", "via bcdfg.example", "Globex", "plain.example", "", "", "")


def _referrals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir, wide=True).select("k", F.concat(F.lit("d"), F.pmod("k", F.lit(3000)).cast("string"), F.lit(".example")).alias("domain"), pick(3, 2, REFS).alias("ref_url"))


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = F.split(pick(3, 6, [" ".join(c) for c in CHAINS]), " ")
    return grid(spark, sf_dir, wide=True).select("k", F.concat(F.lit("d"), F.pmod("k", F.lit(3000)).cast("string"), F.lit(".example")).alias("domain"), F.col("k").alias("ordinal"), F.when(flag(3, 12, 5), "https://found.example/").alias("found"), packed.alias("chain"), F.when(flag(3, 16, 3), 404).otherwise(200).alias("last_status"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda k: pick(3, 20, [x[k] for x in PAGE_LINKS])
    return grid(spark, sf_dir, wide=True).select("k", F.concat(F.lit("d"), F.pmod("k", F.lit(3000)).cast("string"), F.lit(".example")).alias("domain"), F.col("k").alias("ordinal"), part(0).alias("url"), part(1).alias("host"), part(2).alias("brand"), part(3).alias("ref_kind"), flag(3, 25, 4).alias("scanned"))


def _titled(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('titled.example') AS (host)")


OTHER_SOURCES = f"""
r AS (SELECT k, 'd' || k % 3000 || '.example' AS domain, 2 AS source, 0 AS ordinal, {sql_pick(3, 2, REFS)} AS url, '' AS f, {sql_pick(3, 2, REF_SIDES)} AS side, {sql_pick(3, 2, REF_NAMES)} AS name FROM g),
h0 AS (SELECT k, 'd' || k % 3000 || '.example' AS domain, {sql_pick(3, 6, [c[1] if len(c) > 1 else "" for c in CHAINS])} AS url, {sql_pick(3, 6, CHAIN_SIDES)} AS side, {sql_pick(3, 6, CHAIN_NAMES)} AS name, {sql_flag(3, 12, 5)} AS found, {sql_flag(3, 16, 3)} AS gone FROM g),
h AS (SELECT k, domain, 3 AS source, k AS ordinal, url, CASE WHEN url = '' THEN 'https://d.example/go' ELSE url END AS f, CASE WHEN found THEN 'none' WHEN url LIKE '%btag=2' AND gone THEN 'other' ELSE side END AS side, CASE WHEN found THEN '' WHEN url LIKE '%btag=2' AND gone THEN 'via plain.example' ELSE name END AS name FROM h0),
l0 AS (SELECT k, 'd' || k % 3000 || '.example' AS domain, {sql_pick(3, 20, [x[0] for x in PAGE_LINKS])} AS url, {sql_pick(3, 20, LINK_SIDES)} AS side, {sql_pick(3, 20, LINK_NAMES)} AS name, {sql_flag(3, 25, 4)} AS scanned FROM g),
l AS (SELECT k, domain, 4 AS source, k AS ordinal, url, '' AS f, CASE WHEN side = 'unverified' AND scanned THEN 'none' ELSE side END AS side, name FROM l0)
"""


@query(f"WITH g AS ({GRID}), {OTHER_SOURCES} SELECT r.k, r.side AS ref_side, r.name AS ref_name, h.side AS chain_side, h.name AS chain_name, l.side AS link_side, l.name AS link_name FROM r JOIN h USING (k) JOIN l USING (k)")
def source_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC14: the referral row, follow chains and page links as sources of evidence."""
    t = known_trackers(spark)
    r = evidence.referral_verdicts(_referrals(spark, sf_dir), t, OWN).select("k", F.col("side").alias("ref_side"), F.col("name").alias("ref_name"))
    h = evidence.chain_verdicts(_chains(spark, sf_dir), t, _titled(spark), OWN).select("k", F.col("side").alias("chain_side"), F.col("name").alias("chain_name"))
    x = evidence.link_verdicts(_links(spark, sf_dir), t, OWN).select("k", F.col("side").alias("link_side"), F.col("name").alias("link_name"))
    return r.join(h, "k").join(x, "k")


@query(f"""
WITH {DESTS}, {OTHER_SOURCES}, u AS (SELECT k, domain, source, ordinal, url, f, side, name FROM w UNION ALL SELECT * FROM r UNION ALL SELECT * FROM h UNION ALL SELECT * FROM l UNION ALL SELECT DISTINCT NULL, domain, 0, 0, '', '', 'unverified', '' FROM w WHERE k % 7 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY domain, side, name ORDER BY source, ordinal, url, f) AS n, CASE side WHEN 'other' THEN 1 WHEN 'target' THEN 2 WHEN 'plain' THEN 3 END AS s FROM u WHERE side IN ('other', 'target', 'plain') AND url <> ''),
t AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY s, source, ordinal, side, name) AS place FROM o WHERE n = 1),
j AS (SELECT domain, '[' || string_agg('["' || side || '","' || name || '","' || replace(url, '\\', '\\\\') || '","' || CASE WHEN f = url THEN '' ELSE f END || '"]', ',' ORDER BY place) || ']' AS links FROM t WHERE place <= 6 GROUP BY domain)
SELECT a.*, coalesce(j.links, '') AS links FROM (SELECT domain, count(*) FILTER (WHERE side IN ('target', 'ours')) > 0 AS target, coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (WHERE side = 'other' AND name <> '')), ' '), '') AS other, coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (WHERE side = 'plain' AND name <> '')), ' '), '') AS plain, count(*) FILTER (WHERE side = 'unverified') AS unverified, count(*) FILTER (WHERE side = 'ours') > 0 AS ours FROM u GROUP BY domain) a LEFT JOIN j USING (domain)
""")
def site_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC14, DC21, ST7: all sources folded per site, with the links that decided."""
    t, dests = known_trackers(spark), destinations(spark, sf_dir)
    rows = evidence.verdict_rows(
        evidence.destination_verdicts(dests, t, OWN),
        evidence.referral_verdicts(_referrals(spark, sf_dir), t, OWN),
        evidence.chain_verdicts(_chains(spark, sf_dir), t, _titled(spark), OWN),
        evidence.link_verdicts(_links(spark, sf_dir), t, OWN),
    )
    found = evidence.ads(rows, dests.filter("k % 7 = 0").select("domain"))
    return found.withColumn("other", F.array_join("other", " ")).withColumn("plain", F.array_join("plain", " "))


LED = ("https://t1.example/a", "https://t2.example/a", "https://t3.example/a", "https://acme-t.example/a", "https://d5.example/a")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_pick(0, 2, LED)} AS url, {sql_pick(1, 2, ("target", "other", "target", "target"))} AS kind, {sql_flag(1, 6)} AS pid FROM g),
b AS (SELECT {s_host("url")} AS host, CASE WHEN url LIKE '%t2%' THEN 'target' ELSE kind END AS kind, pid OR url LIKE '%t1%' AS pid FROM a), c AS (SELECT host, bool_or(kind = 'target' AND pid) AS t, bool_or(kind = 'other') AS o FROM b GROUP BY host)
SELECT host FROM c WHERE t AND NOT o AND NOT contains(host, 'acme') AND host <> 'd5.example'
""")
def tracker_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG13: hosts that lead to the target alone."""
    url = pick(0, 2, LED)
    df = grid(spark, sf_dir).select(url.alias("url"), F.lit("https://end.example/").alias("final_url"), F.when(url.contains("t2"), "target").otherwise(pick(1, 2, ("target", "other", "target", "target"))).alias("kind"), F.when(flag(1, 6) | url.contains("t1"), "7").otherwise("").alias("pid"), nothing().alias("hops"))
    return evidence.tracker_hosts(df, spark.sql("SELECT 'www.d5.example' AS domain"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 'd' || k % 2000 AS domain, k, {sql_pick(0, 2, ("Acme guide", "Acme and Globex", "Garden"))} AS title, {sql_pick(0, 6, ("https://globex.example/x", "https://reviews.example/y", "https://p.example/coded", "https://d.example/own"))} AS url, {sql_flag(1, 2, 3)} AS hid, {sql_flag(1, 6, 3)} AS script FROM g),
b AS (SELECT *, CASE WHEN NOT hid AND url LIKE '%globex%' THEN 'Globex' WHEN NOT hid AND url LIKE '%coded' THEN 'Umbra' END AS b1, CASE WHEN script THEN 'Initech' END AS b2 FROM a WHERE title = 'Acme guide'), c AS (SELECT domain, k, unnest([b1, b2]) AS b FROM b)
SELECT domain, string_agg(DISTINCT b, ' ' ORDER BY b) AS brands, 'https://site.example/' || min(k) AS page FROM c WHERE b IS NOT NULL GROUP BY domain
""")
def page_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT10, JN13: whom pages about the target advertise."""
    domain = F.concat(F.lit("d"), F.pmod("k", F.lit(2000)).cast("string"))
    url = pick(0, 6, ("https://globex.example/x", "https://reviews.example/y", "https://p.example/coded", "https://d.example/own"))
    pages = grid(spark, sf_dir).select(domain.alias("domain"), F.col("k").alias("ordinal"), F.concat(F.lit("https://site.example/"), F.col("k").cast("string")).alias("page"), pick(0, 2, ("Acme guide", "Acme and Globex", "Garden")).alias("title"), F.array(F.struct(url.alias("url"), flag(1, 2, 3).alias("hidden"))).alias("links"), F.when(flag(1, 6, 3), F.array(F.lit("https://initech.example/s"))).otherwise(nothing()).alias("script_urls"))
    dests = grid(spark, sf_dir).select(domain.alias("domain")).distinct().select("domain", F.lit("https://p.example/coded").alias("url"), F.lit("https://e.example/?btag=1").alias("final_url"), F.lit("other").alias("kind"), F.lit("Umbra").alias("brand"), nothing().alias("hops"))
    return evidence.page_evidence(pages, dests).withColumn("brands", F.array_join("brands", " "))


CANDIDATES = (("https://site.example/go/x", "a", "internal_redirect_like", 2), ("https://site.example/about", "a", None, None), ("https://go.acme.com/Ab3d", "a", "external", 0), ("https://plain.example/page", "a", None, None), ("https://globex.example/", "a", "external", 3), ("https://bonus.example/", "area", "external", 4), ("https://s.example/x.css", "a", None, None), ("https://plain.example/app.js?clid=1", "script_url", None, None), ("https://plain.example/?clid=1", "script_nav", "js:script_nav", 1), ("https://site.example/", "a", None, None), ("https://metrics.example/bonus", "onclick", None, None), ("https://video.example/bonus", "a", None, None), ("https://calm.example/x", "onclick", "js:onclick", 1))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 'x' || k % 1500 || '.example' AS s, k, {sql_pick(0, 2, [c[0] for c in CANDIDATES])} AS url, {sql_pick(0, 2, [c[2] for c in CANDIDATES])} AS reason, {sql_pick(0, 2, [c[3] for c in CANDIDATES])} AS kind FROM g),
b AS (SELECT s, url, min(k) AS o, any_value(reason) AS reason, any_value(kind) AS kind, CASE WHEN any_value(reason) LIKE 'js:%' THEN 0 WHEN any_value(reason) = 'external' THEN 2 ELSE 1 END AS p FROM a WHERE reason IS NOT NULL GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY s, kind ORDER BY p, o) AS w FROM b), d AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY kind, p, o) AS rank FROM c WHERE kind <> 3 OR w <= 3)
SELECT s AS domain, url, reason, kind = 0 AS refish, kind, rank FROM d WHERE rank <= 4
""")
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC9, TK9: the first four links of each site to follow."""
    site = F.concat(F.lit("x"), F.pmod("k", F.lit(1500)).cast("string"), F.lit(".example"))
    df = grid(spark, sf_dir).select(F.lit("site.example").alias("domain"), site.alias("s"), pick(0, 2, [c[0] for c in CANDIDATES]).alias("url"), pick(0, 2, [c[1] for c in CANDIDATES]).alias("source"), F.col("k").alias("ordinal"))
    #: A site's own links lie on its host, so that links of all sites can be told apart.
    own = df.withColumn("url", F.replace("url", F.lit("https://site.example"), F.concat(F.lit("https://"), F.col("s")))).withColumn("domain", F.col("s"))
    found = scan.pick_candidates(own.drop("s"), 4)
    return found.select("domain", F.replace("url", F.concat(F.lit("https://"), F.col("domain")), F.lit("https://site.example")).alias("url"), "reason", "refish", "kind", F.col("rank").cast("long").alias("rank"))


PAGES = (("https://www.s.example/acme-bonus", "x", True), ("https://s.example/p1", "Acme here", True), ("https://s.example/register", "r", False), ("https://s.example/garden", "g", None), ("https://o.example/acme", "a", None), ("https://s.example/", "Acme", None), ("https://s.example/promo", "p", False), ("https://s.example/acme-2", "y", True), ("https://s.example/acme-3", "z", True))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k % 1500 AS d, k, {sql_pick(0, 2, [p[0] for p in PAGES])} AS url, {sql_pick(0, 2, [p[2] for p in PAGES])} AS post FROM g), b AS (SELECT d, url, post, min(k) AS o FROM a WHERE post IS NOT NULL GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY d, post ORDER BY o) AS w FROM b), e AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY post DESC, o) AS rank FROM c WHERE NOT post OR w <= 3)
SELECT 'n' || d AS site, url, post, rank FROM e WHERE rank <= 4
""")
def inner_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT12, DC9: pages of a site to look at."""
    df = grid(spark, sf_dir).select(F.concat(F.lit("n"), F.pmod("k", F.lit(1500)).cast("string")).alias("site"), pick(0, 2, [p[0] for p in PAGES]).alias("url"), pick(0, 2, [p[1] for p in PAGES]).alias("text"), F.col("k").alias("ordinal"))
    own = df.select(F.concat("site", F.lit(".s.example")).alias("domain"), F.regexp_replace("url", r"//(?:www\.)?s\.example", F.concat(F.lit("//"), "site", F.lit(".s.example"))).alias("url"), "text", "ordinal")
    found = scan.inner_pages(own)
    site = F.regexp_extract("domain", r"^(n\d+)\.", 1)
    back = F.regexp_replace("url", r"//n\d+\.s\.example", "//s.example")
    return found.select(site.alias("site"), F.replace(back, F.lit("https://s.example/acme-bonus"), F.lit("https://www.s.example/acme-bonus")).alias("url"), "post", F.col("rank").cast("long").alias("rank"))


SCRIPTS = (("https://s.example/app.js", True), ("https://s.example/jquery.js", False), ("https://cdn.example/app.js", False), ("https://s.example/b.js", True))
DEEP = (("https://s.example/acme/", True), ("https://s.example/acme", True), ("https://s.example/%61cme-x", True), ("https://s.example/garden", False), ("https://s.example/", False), ("https://s.example/acme-9", True))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k % 2000 AS d, k, {sql_pick(0, 2, [p[0] for p in DEEP])} AS url, {sql_pick(0, 2, [p[1] for p in DEEP])} AS named, {sql_flag(1, 3)} AS home, {sql_pick(2, 2, [p[0] for p in SCRIPTS])} AS js, {sql_pick(2, 2, [p[1] for p in SCRIPTS])} AS own FROM g),
b AS (SELECT *, regexp_replace(url, '/+$', '') AS u FROM a WHERE named), c AS (SELECT *, row_number() OVER (PARTITION BY d, u ORDER BY NOT home, k) AS n FROM b), e AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY NOT home, k, url) AS rank FROM c WHERE n = 1),
f AS (SELECT d, js, min(k) AS k FROM a WHERE own GROUP BY ALL), h AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY k, js) AS rank FROM f)
SELECT 'page' AS what, 'd' || d AS domain, url, rank FROM e WHERE rank <= 2 UNION ALL SELECT 'script', 'd' || d, js, rank FROM h WHERE rank <= 6
""")
def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT12, HT13: pages that name the target, the home page's first; a site's own scripts."""
    df = grid(spark, sf_dir).select(F.concat(F.lit("d"), F.pmod("k", F.lit(2000)).cast("string")).alias("domain"), pick(0, 2, [p[0] for p in DEEP]).alias("url"), F.col("k").alias("ordinal"), flag(1, 3).alias("home"), pick(2, 2, [p[0] for p in SCRIPTS]).alias("js"))
    pages = scan.deep_pages(df.filter("home"), df.filter("NOT home"), 2).select(F.lit("page").alias("what"), "domain", "url", "rank")
    site = lambda c: F.replace(c, F.lit("//s.example"), F.concat(F.lit("//"), "domain", F.lit(".s.example")))
    own = df.select(F.concat("domain", F.lit(".s.example")).alias("domain"), site(F.col("js")).alias("url"), "ordinal")
    found = scan.own_scripts(own).select(F.lit("script").alias("what"), F.regexp_extract("domain", r"^(d\d+)\.", 1).alias("domain"), F.regexp_replace("url", r"//d\d+\.s\.example", "//s.example").alias("url"), "rank")
    return pages.union(found).withColumn("rank", F.col("rank").cast("long"))


S_MOVES = """hop AS (SELECT url, min((location, status)) AS s FROM (
    SELECT a.url, b.url AS location, CASE WHEN a.page_id % 31 = 5 THEN 404 ELSE 302 END AS status FROM pages a LEFT JOIN pages b
    ON b.page_id = CASE WHEN a.page_id % 29 = 0 THEN a.page_id - 3 WHEN a.page_id % 37 > 0 THEN a.page_id + 1 END WHERE a.page_id % 41 > 0) GROUP BY url),
e AS (SELECT url, s[1] AS nxt, s[2] >= 400 AS gone FROM hop)"""


def s_chains(most: int) -> str:
    """Chains of at most so many hops, one hop at a time."""
    return f"""
WITH RECURSIVE {S_MOVES}, w AS (SELECT url AS start, url AS cur, 0 AS n, '' AS stop, [url] AS seen FROM (SELECT DISTINCT url FROM pages)
  UNION ALL SELECT start, CASE WHEN x.url IS NULL OR x.gone OR x.nxt IS NULL OR list_contains(seen, x.nxt) THEN cur ELSE x.nxt END, n + 1,
    CASE WHEN x.url IS NULL OR x.gone THEN 'error' WHEN x.nxt IS NULL OR list_contains(seen, x.nxt) THEN 'no_redirect' ELSE '' END, list_append(seen, x.nxt)
  FROM w LEFT JOIN e x ON w.cur = x.url WHERE w.stop = '' AND n < {most}),
f AS (SELECT *, row_number() OVER (PARTITION BY start ORDER BY n DESC) AS r FROM w)
SELECT start, cur AS final_url, CASE WHEN stop = '' THEN 'max_hops' ELSE stop END AS stop, (CASE WHEN stop = '' THEN n + 1 ELSE n END)::INT AS length FROM f WHERE r = 1
"""


def _moves(spark: SparkSession, sf_dir: str, most: int) -> DataFrame:
    """Every page's address leads to that of the next page or of one three back, is an error, stays, or was not captured."""
    own = read(spark, sf_dir, "pages").select("page_id", "url")
    k = F.col("page_id")
    to = F.when(k % 29 == 0, k - 3).when(k % 37 > 0, k + 1)
    there = own.select(F.col("page_id").alias("_to"), F.col("url").alias("location"))
    hops = own.filter(k % 41 > 0).withColumn("to", to).join(there, F.col("to") == F.col("_to"), "left")
    hops = hops.select("url", F.when(k % 31 == 5, 404).otherwise(302).alias("status"), "location")
    found = chains.follow(own.select("url").distinct(), hops, most)
    return found.select("start", "final_url", "stop", F.size("chain").alias("length"))


@query(s_chains(8))
def redirect_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT1: chains over the addresses of pages, at most eight hops, with the reason why each stops."""
    return _moves(spark, sf_dir, 8)


@query(s_chains(64))
def long_redirect_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT1: the same with 64 hops, which takes six joins."""
    return _moves(spark, sf_dir, 64)


@query(f"""
WITH g AS ({GRID}), q AS (SELECT k % 1000 AS s, k, 'g' || k % 37 AS url FROM g), l AS (SELECT DISTINCT 'g' || k % 37 AS url, 'l' || k % 53 AS link FROM g), p AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY link) AS r FROM l),
o AS (SELECT s, url, min(k) AS k FROM q GROUP BY ALL), m AS (SELECT o.s, p.link AS url, o.k, 5 - r AS place FROM o JOIN p USING (url) WHERE r <= 4), a AS (SELECT s, url, k, 0 AS place FROM o UNION ALL SELECT * FROM m WHERE (s, url) NOT IN (SELECT s, url FROM o)),
b AS (SELECT s, url, min((k, place)) AS o FROM a GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY o, url) AS rank FROM b)
SELECT s AS site, url, rank FROM c WHERE rank <= 12
""")
def expanded_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT3: a queue with the links of its gate pages, one level deep, within a budget."""
    g = grid(spark, sf_dir)
    gate = F.concat(F.lit("g"), F.pmod("k", F.lit(37)).cast("string"))
    q = g.select(F.pmod("k", F.lit(1000)).alias("site"), gate.alias("url"), F.col("k").alias("ordinal")).groupBy("site", "url").agg(F.min("ordinal").alias("ordinal"))
    links = g.select(gate.alias("url"), F.concat(F.lit("l"), F.pmod("k", F.lit(53)).cast("string")).alias("link"), F.lit(0).alias("place")).distinct()
    return chains.expand_once(q, links).withColumn("rank", F.col("rank").cast("long"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_number(0, 2, 3)} AS a, {sql_number(0, 6, 3)} AS b FROM g)
SELECT k, array_to_string(list_filter([CASE WHEN a > 0 THEN 'u0' END, CASE WHEN a > 1 THEN 'u1' END, CASE WHEN b > 0 AND a = 0 THEN 'u0' END, CASE WHEN b > 1 THEN 'v1' END], lambda x: x IS NOT NULL), ' ') AS chain FROM a
""")
def home_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT4, ST5: what a home page passed through in all logs, without each chain's end."""
    one = F.slice(F.array(F.lit("u0"), F.lit("u1"), F.lit("end")), 1, number(0, 2, 3) + 1)
    two = F.slice(F.array(F.lit("u0"), F.lit("v1"), F.lit("end")), 1, number(0, 6, 3) + 1)
    return grid(spark, sf_dir).select("k", F.array_join(chains.home_chain(F.array(one, two)), " ").alias("chain"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 's' || k % 900 AS domain, k, 'h' || k % 70 || '.example' AS host, {sql_pick(0, 2, ("article", "multibrand", "hacked"))} AS class FROM g), b AS (SELECT host, class, count(DISTINCT domain) AS n FROM a WHERE host NOT IN (SELECT 'h' || k % 7 || '.example' FROM g) GROUP BY ALL)
SELECT host, class FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, class) AS r FROM b) WHERE r = 1
""")
def move_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN14, AG18: hosts that sites move to, with the class of most of them."""
    g = grid(spark, sf_dir)
    host = lambda n: F.concat(F.lit("h"), F.pmod("k", F.lit(n)).cast("string"), F.lit(".example"))
    found = g.select(F.concat(F.lit("s"), F.pmod("k", F.lit(900)).cast("string")).alias("domain"), pick(0, 2, ("article", "multibrand", "hacked")).alias("class"), host(70).alias("host"))
    return chains.move_targets(found, g.select(host(7).alias("domain")))


DEST_KINDS = ("target", "other", "needs_browser", "internal", "dead", "unknown")
DEST_BRANDS = ("Globex", "Umbra", "")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k % 5000 AS d, k, k // 5000 AS i, {sql_pick(0, 2, DEST_KINDS)} AS kind, {sql_pick(0, 6, DEST_BRANDS)} AS brand, {sql_pick(1, 2, ("timeout", "x", "y"))} AS ev FROM g), kept AS (SELECT * FROM a WHERE ev <> 'timeout'),
b AS (SELECT d, kind, brand FROM kept UNION ALL SELECT DISTINCT d, 'other', 'Late' FROM a WHERE d % 3 = 0), c AS (SELECT d, count(*) FILTER (WHERE kind = 'target') > 0 AS t, count(*) FILTER (WHERE kind = 'other') > 0 AS o, coalesce(array_to_string(list_sort(list(DISTINCT brand) FILTER (WHERE kind = 'other' AND brand <> '')), ' '), '') AS brands, count(*) FILTER (WHERE kind IN ('dead', 'unknown', 'needs_browser')) AS un FROM b GROUP BY d)
SELECT 'd' || x.d AS domain, CASE WHEN t AND o THEN '4_mixed' WHEN t THEN '1_target_only' WHEN o THEN '3_other_only' ELSE '2_no_ads' END AS "group", coalesce(brands, '') AS brands, coalesce(un, 0)::INT AS unresolved FROM (SELECT DISTINCT d FROM a) x LEFT JOIN c USING (d)
""")
def regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HP12, AG15: groups after a later pass over what was left open."""
    d = F.concat(F.lit("d"), F.pmod("k", F.lit(5000)).cast("string"))
    one = F.struct(F.col("k").cast("string").alias("url"), pick(0, 2, DEST_KINDS).alias("kind"), pick(0, 6, DEST_BRANDS).alias("brand"), pick(1, 2, ("timeout", "x", "y")).alias("evidence"))
    records = grid(spark, sf_dir).select(d.alias("domain"), one.alias("x")).groupBy("domain").agg(F.collect_list("x").alias("dests"))
    late = F.array(F.struct(F.lit("u").alias("url"), F.lit("other").alias("kind"), F.lit("Late").alias("brand"), F.lit("z").alias("evidence")))
    later = records.filter(F.regexp_extract("domain", r"(\d+)", 1).cast("int") % 3 == 0).select("domain", late.alias("dests"))
    return groups.regroup(records, later).select("domain", "group", F.array_join("other_brands", " ").alias("brands"), "unresolved")


CACHED = ("https://x7q.example/Ab3d", "https://plain.example/p#f", "https://s.example/in", "https://open.example/q")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, k % 4000 AS d, {sql_pick(0, 2, CACHED)} AS url, {sql_pick(0, 6, ("needs_browser", "unknown", "other", "internal"))} AS kind, {sql_pick(1, 2, ("js:script", "a"))} AS via FROM g),
b AS (SELECT *, CASE WHEN kind IN ('unknown', 'needs_browser') AND url LIKE '%x7q%' THEN 'target' WHEN kind IN ('unknown', 'needs_browser') AND url LIKE '%plain%' THEN 'other' ELSE kind END AS k2 FROM a), c AS (SELECT d, bool_or(k2 = 'target') AS t, bool_or(k2 = 'other') AS o, count(*) FILTER (WHERE k2 IN ('dead', 'unknown', 'needs_browser')) AS un, bool_or(k2 = 'needs_browser' AND (via = 'js:script' OR url LIKE '%x7q%')) AS p FROM b WHERE k2 <> 'internal' GROUP BY d)
SELECT 'd' || d AS domain, CASE WHEN p THEN 'needs_browser' WHEN t AND o THEN '4_mixed' WHEN t THEN '1_target_only' WHEN o THEN '3_other_only' ELSE '2_no_ads' END AS "group", CASE WHEN NOT p THEN '' WHEN t AND o THEN '4_mixed' WHEN t THEN '1_target_only' WHEN o THEN '3_other_only' ELSE '2_no_ads' END AS undecided_group, un AS unresolved FROM c
""")
def cached_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN8, IN3: undecided destinations filled from decided ones of other runs, and the groups that follow."""
    d = F.concat(F.lit("d"), F.pmod("k", F.lit(4000)).cast("string"))
    dests = grid(spark, sf_dir).select(F.lit("s.example").alias("domain"), d.alias("d"), pick(0, 2, CACHED).alias("url"), pick(1, 2, ("js:script", "a")).alias("via"), pick(0, 6, ("needs_browser", "unknown", "other", "internal")).alias("kind"), F.lit("").alias("brand"), F.lit("").alias("final_url"))
    results = spark.sql("SELECT * FROM VALUES ('x7q.example/Ab3d', 'dead', '', 'f', 1), ('x7q.example/Ab3d', 'target', 'Acme', 'f', 2), ('https://plain.example/p', 'other', 'Globex', 'f', 1), ('https://s.example/in', 'internal', '', 'f', 1), ('https://open.example/q', 'dead', '', 'f', 1) AS (key, kind, brand, final_url, ordinal)")
    filled = scan.fill_from_cache(dests, scan.dest_cache(results)).withColumn("domain", F.col("d")).drop("d")
    return scan.resolved_groups(filled)


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 'd' || lpad((k % 300)::VARCHAR, 3, '0') || '.example' AS domain, k, {sql_pick(0, 2, CACHED)} AS url, {sql_flag(0, 6, 3)} AS nb FROM g), b AS (SELECT *, CASE WHEN url LIKE '%x7q%' THEN 'x7q.example/Ab3d' ELSE regexp_replace(url, '#.*$', '') END AS key FROM a WHERE nb)
SELECT key, domain, url FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY domain, k) AS r FROM b) WHERE r = 1
""")
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HP8: undecided destinations, once each."""
    domain = F.concat(F.lit("d"), F.lpad(F.pmod("k", F.lit(300)).cast("string"), 3, "0"), F.lit(".example"))
    one = F.array(F.struct(pick(0, 2, CACHED).alias("url"), F.when(flag(0, 6, 3), "needs_browser").otherwise("other").alias("kind")))
    records = grid(spark, sf_dir).select(domain.alias("domain"), F.lit(1).alias("ts"), F.col("k").alias("ordinal"), one.alias("destinations"))
    return scan.pending_destinations(records)


