"""Decision cascades over grids of captured fields; the SQL says each rule again, in the published order."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.operators import chains, decisions, groups
from tessera.plans.inputs import GRID, flag, grid, nothing, number, pick, sql_flag, sql_number, sql_pick
from tessera.plans.q_urls import s_host, s_hostname, s_has, s_part, s_random, s_ref
from tessera.config import AFFILIATE_NAMES, TRACKER_NAMES
from tessera.plans.registry import query

STALE = dataclasses.replace(DEFAULT, stale=("Initech", "Hooli"))

TITLES = ("Acme club", "Globex bonus", "Hooli day", "Free bonus", "Plain page", "Domain for sale", "Access denied", "Initech | Acme", "")
FINALS = ("https://www.acme-x.example/?pid=77", "https://globex.example/", "https://plain.example/a", "https://hooli.example/?ref=1", "https://registrar.example/", "https://go.initech.example/x?s1=2")
MARKUP = ('<img src="https://cdn.acme.example/a.png">', "<p>x</p>")
TEXTS = ("a bonus for you", "nothing of interest here, but long enough to be a page of its own, which says a lot of things about gardens and cooking", "")
NAMES = ("", "Globex Club")

#: identify in SQL, over title t, final address f, markup m, text x and application name n.
FIELDS = "(t || ' ' || h || ' ' || n)"
TOPIC = "regexp_matches(t || ' ' || x, '(?i)offer|bonus|deposit|discount|jackpot')"
RIVALS = (("Globex", "globex"), ("Initech", "initech|ini-tech"), ("Umbra", "umbra\\s?corp"), ("Hooli", "\\bhooli"))
OTHER = "CASE " + " ".join(f"WHEN regexp_matches({FIELDS}, '(?i){rx}') AND (topic OR regexp_matches(h, '(?i){rx}')) THEN '{n}'" for n, rx in RIVALS) + " END"
PART = "CASE " + " ".join(f"WHEN regexp_matches({FIELDS}, '(?i){rx}') AND (topic OR regexp_matches(h, '(?i){rx}')) THEN regexp_extract({FIELDS}, '(?i)({rx})', 1)" for n, rx in RIVALS) + " END"
LANDINGS = f"""
g AS ({GRID}), a AS (SELECT k, h1, h2, h3, {sql_pick(0, 2, TITLES)} AS t, {sql_pick(0, 7, FINALS)} AS f, {sql_pick(0, 12, MARKUP)} AS m, {sql_pick(0, 15, TEXTS)} AS x, {sql_pick(0, 19, NAMES)} AS n FROM g),
b AS (SELECT *, {s_hostname("f")} AS h, {TOPIC} AS topic FROM a), c AS (SELECT *, {OTHER} AS other, {PART} AS part, CASE WHEN n <> '' THEN n ELSE regexp_extract(t, '^(.*?)(?: \\| .*)?$', 1) END AS raw FROM b),
d AS (SELECT *, CASE WHEN contains(m, 'cdn.acme') THEN 'target' WHEN other IS NOT NULL THEN 'other' WHEN regexp_matches({FIELDS}, '(?i)acme') THEN 'target' WHEN topic THEN 'other' WHEN length(x) < 100 THEN 'unknown' ELSE 'off_topic' END AS kind,
  CASE WHEN contains(m, 'cdn.acme') THEN 'assets' WHEN other IS NOT NULL THEN 'fields:' || part WHEN regexp_matches({FIELDS}, '(?i)acme') THEN 'name_only' WHEN topic THEN 'topic_words' WHEN length(x) < 100 THEN 'empty_page' ELSE 'no_topic_words' END AS evidence FROM c),
e AS (SELECT *, CASE WHEN kind = 'target' THEN 'Acme' WHEN evidence LIKE 'fields:%' THEN other WHEN evidence = 'topic_words' THEN coalesce(nullif(raw, ''), '?') WHEN evidence = 'no_topic_words' THEN raw ELSE '' END AS brand, CASE WHEN kind = 'target' THEN regexp_extract(f, 'pid=([^&]*)', 1) ELSE '' END AS pid FROM d)
"""


def landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = pick(0, 19, NAMES)
    none = F.filter(F.array(names), lambda n: n != "")
    return grid(spark, sf_dir).select("k", "h1", "h2", "h3", pick(0, 2, TITLES).alias("title"), pick(0, 7, FINALS).alias("final_url"), pick(0, 12, MARKUP).alias("html"), pick(0, 15, TEXTS).alias("text"), none.alias("names"), none.alias("operator_names"))


@query(f"WITH {LANDINGS} SELECT k, kind, brand, evidence, pid FROM e")
def landing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC1: whose page a landing is, and what says so."""
    return decisions.identify(landings(spark, sf_dir)).select("k", "kind", "brand", "evidence", "pid")


#: refine in SQL, over kind, brand, evidence, title t, host h, route, hops and whether the row is open to it.
NAMED = "CASE " + " ".join(f"WHEN regexp_matches(t, '(?i){rx}') OR regexp_matches(h, '(?i){rx}') THEN '{n}'" for n, rx in RIVALS) + " END"
HEAD = "coalesce(nullif(substr(trim(regexp_extract(t, '^(.*?)(?: [|:•·»-] .*)?$', 1)), 1, 60), ''), '?')"


def s_refine(source: str, stale: tuple[str, ...], kept: str) -> str:
    patterns = dict(RIVALS)
    gone = " OR ".join(f"(brand = '{n}' AND NOT regexp_matches(t, '(?i){patterns[n]}') AND NOT regexp_matches(h, '(?i){patterns[n]}'))" for n in stale) or "false"
    return f"""
    r0 AS (SELECT *, kind IN ('other', 'topic_site') AND open AS o FROM {source}),
    r1 AS (SELECT *, o AND (regexp_matches(h, '(?i)(^|\\.)(registrar\\.example|parking\\.example)$') OR regexp_matches(t, '(?i)domain (name )?(is |may be )?for sale')) AS parked, regexp_matches(t, '(?i)acme') OR regexp_matches(h, '(?i)acme') AS own FROM r0),
    r2 AS (SELECT *, o AND NOT parked AND starts_with(evidence, 'fields:') AND ({gone}) AS stale FROM r1),
    r3 AS (SELECT {kept}, t, h, route, tracked, hops, o AND NOT parked AND NOT (stale AND own) AS o2, CASE WHEN parked THEN 'off_topic' WHEN stale AND own THEN CASE WHEN route THEN 'target' ELSE 'brand_site' END WHEN stale THEN CASE WHEN route THEN 'other' ELSE 'topic_site' END ELSE kind END AS kind,
      CASE WHEN parked THEN '' WHEN stale AND own THEN 'Acme' WHEN stale THEN {HEAD} ELSE brand END AS brand, CASE WHEN parked THEN 'parked_or_registrar' WHEN stale AND own THEN 'name_only' WHEN stale THEN 'topic_words' ELSE evidence END AS evidence FROM r2),
    r4 AS (SELECT *, o2 AND evidence = 'topic_words' AND kind = 'other' AND hops AND NOT tracked AS loose FROM r3),
    r5 AS (SELECT *, CASE WHEN o2 AND evidence = 'topic_words' AND NOT loose THEN {NAMED} END AS known FROM r4),
    r6 AS (SELECT *, o2 AND evidence = 'topic_words' AND NOT loose AND known IS NULL AND regexp_matches(t, '(?i)access denied|forbidden') AS blocked FROM r5),
    refined AS (SELECT {kept}, route, CASE WHEN loose THEN 'topic_site' WHEN blocked THEN 'unknown' ELSE kind END AS kind, CASE WHEN known IS NOT NULL THEN known WHEN blocked THEN '' ELSE brand END AS brand,
      CASE WHEN loose THEN 'unrecognized_no_tracker' WHEN known IS NOT NULL THEN 'title_or_host:' || known WHEN blocked THEN 'blocked_page' ELSE evidence END AS evidence FROM r6)
    """


DEMOTED = f"CASE WHEN kind = 'target' AND evidence = 'name_only' AND NOT route THEN 'brand_site' WHEN kind = 'other' AND regexp_matches({FIELDS}, '(?i)acme') AND NOT route THEN 'brand_site' WHEN kind = 'other' AND evidence = 'topic_words' AND NOT route THEN 'topic_site' END"


@query(f"""
WITH {LANDINGS}, s AS (SELECT *, {sql_flag(1, 3, 3)} OR {s_has(s_part("f", 4), AFFILIATE_NAMES)} AS route FROM e), p AS (SELECT * EXCLUDE (kind), coalesce({DEMOTED}, kind) AS kind, {DEMOTED} IS NULL AS open, false AS tracked, false AS hops FROM s),
{s_refine("p", (), "k, pid")} SELECT k, pid, kind, brand, evidence, route AS ad_route FROM refined
""")
def destination_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC2, DC3: landings with the way they were reached; plain links do not count as advertising."""
    df = landings(spark, sf_dir).withColumn("start_url", F.lit("https://start.example/")).withColumn("redirected", flag(1, 3, 3))
    return decisions.classify_destination(df).select("k", "pid", "kind", "brand", "evidence", "ad_route")


KINDS = ("other", "topic_site", "target", "unknown")
BRANDS = ("Initech", "Hooli", "Globex", "?", "Initech", "Hooli")
EVIDENCE = ("fields:initech", "topic_words", "fields:hooli")
STORED = f"""
g AS ({GRID}), s AS (SELECT k, {sql_pick(0, 2, TITLES)} AS t, {s_hostname(sql_pick(0, 7, FINALS))} AS h, {sql_pick(1, 2, KINDS)} AS kind, {sql_pick(1, 5, BRANDS)} AS brand, {sql_pick(1, 9, EVIDENCE)} AS evidence, {sql_flag(2, 3)} AS route,
  {sql_flag(2, 5)} AS hops, {s_has(s_part(sql_pick(0, 7, FINALS), 4), AFFILIATE_NAMES)} OR {sql_flag(2, 7)} AS tracked, true AS open FROM g)
"""


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    hops = F.when(flag(2, 5), F.when(flag(2, 7), F.array(F.lit("https://a.example/?clid=1"))).otherwise(nothing()))
    return grid(spark, sf_dir).select("k", pick(0, 2, TITLES).alias("title"), pick(0, 7, FINALS).alias("final_url"), pick(1, 2, KINDS).alias("kind"), pick(1, 5, BRANDS).alias("brand"), pick(1, 9, EVIDENCE).alias("evidence"), flag(2, 3).alias("ad_route"), hops.alias("hops"), pick(0, 7, FINALS).alias("start_url"))


@query(f"WITH {STORED}, {s_refine('s', ('Initech', 'Hooli'), 'k')} SELECT k, kind, brand, evidence FROM refined")
def refined_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC4: stored destinations judged again by final host and title, twice, which changes nothing more."""
    once = decisions.refine(stored(spark, sf_dir), STALE)
    return decisions.refine(once, STALE).select("k", "kind", "brand", "evidence")


WALLS = ("<p>sorry, you have been blocked</p>", '<div class="cf-turnstile">sorry, you have been blocked</div>', "cf_chl_opt", "challenges.cloudflare.com", "DDOS-GUARD", "sucuri", "hcaptcha", "g-recaptcha", "captcha", "plain", "/cdn-cgi/challenge-platform/scripts/jsd/main.js", "cloudflare plain")
WALL_KINDS = ("cloudflare_block", "cloudflare_turnstile", "cloudflare_challenge", "cloudflare_challenge", "ddos_guard", "sucuri", "hcaptcha", "recaptcha", "captcha", "bot_check", "bot_check", "cloudflare_challenge")
MARKED = (0, 1, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0)
SERVERS = ("cloudflare", "ddos-guard", "Sucuri/1", "nginx", None)
STATUSES = (200, 403, 503, 404, 451)


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_flag(0, 1)} AS titled, {sql_flag(1, 1)} AS short, {sql_pick(0, 4, MARKED)} AS marked, {sql_pick(0, 4, WALL_KINDS)} AS w, {sql_pick(0, 4, WALLS)} AS m, {sql_pick(1, 5, SERVERS)} AS server, {sql_pick(1, 9, STATUSES)} AS status, {sql_flag(2, 3, 5)} AS mitigated, {sql_flag(2, 7)} AS long FROM g)
SELECT k, CASE WHEN titled OR (short AND marked = 1) THEN w END AS wall,
  CASE WHEN mitigated OR contains(m, 'challenge-platform') THEN 'cloudflare_challenge' WHEN status < 400 AND long THEN NULL WHEN server = 'ddos-guard' OR m = 'DDOS-GUARD' THEN 'ddos_guard' WHEN server = 'Sucuri/1' THEN 'sucuri'
    WHEN m IN ('hcaptcha', 'g-recaptcha', 'captcha') THEN 'captcha' WHEN server = 'cloudflare' AND status >= 400 THEN 'cloudflare_' || status END AS protected FROM a
""".replace("WHEN m IN ('hcaptcha'", "WHEN m IN ('g-recaptcha', 'hcaptcha'"))
def bot_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC6: the kinds of bot checks and protections."""
    html = pick(0, 4, WALLS)
    long_ = F.when(flag(2, 7), F.concat(html, F.repeat(F.lit(" "), F.lit(9000)))).otherwise(html)
    return grid(spark, sf_dir).select(
        "k",
        decisions.challenge_kind(F.when(flag(0, 1), "Just a moment").otherwise("Page"), html, F.when(flag(1, 1), "short").otherwise(F.repeat(F.lit("long "), F.lit(300)))).alias("wall"),
        decisions.protection(pick(1, 9, STATUSES), pick(1, 5, SERVERS), F.when(flag(2, 3, 5), "challenge"), long_).alias("protected"),
    )


SCAN = {"home_ref": (0, 1, 9), "failed": (0, 4, 7), "protected": (0, 8, 7), "direct": (1, 1, 5), "chain": (1, 4, 5), "file_ref": (1, 7, 2), "script": (1, 9, 2)}


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in SCAN.items())}, {sql_pick(2, 1, (200, 200, 404))} AS status, {sql_pick(2, 4, ("text/html", "text/HTML; x", "image/png"))} AS ct, {sql_number(2, 8, 6)} AS mentions, {sql_number(2, 11, 2)} AS buttons, {sql_number(3, 2, 400)} AS n, {sql_number(3, 11, 10)} AS links FROM g),
b AS (SELECT *, CASE WHEN home_ref THEN 'affiliate' WHEN failed OR protected OR status >= 400 OR ct = 'image/png' THEN 'failed' WHEN direct OR chain THEN 'affiliate' WHEN mentions >= 3 AND buttons > 0 THEN CASE WHEN file_ref THEN 'affiliate' ELSE 'failed' END WHEN n < 200 AND links < 5 AND script THEN 'failed' ELSE 'not_affiliate' END AS grp FROM a)
SELECT k, grp AS "group", CASE WHEN grp <> 'affiliate' THEN '' WHEN home_ref THEN 'home_redirect' WHEN direct THEN 'direct:a' WHEN chain THEN 'chain:external' ELSE 'js_file' END AS method,
  CASE WHEN grp <> 'failed' THEN '' WHEN failed THEN 'timeout' WHEN protected THEN 'captcha' WHEN status >= 400 THEN 'http_404' WHEN ct = 'image/png' THEN 'not_html' WHEN mentions >= 3 AND buttons > 0 THEN 'needs_browser_js_buttons' ELSE 'js_shell' END AS reason,
  CASE WHEN grp = 'not_affiliate' AND n < 200 AND links < 5 THEN 'thin_page' ELSE '' END AS flag FROM b
""")
def referral_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC7: what a scan for referrals says of a captured site."""
    on = {c: flag(*v) for c, v in SCAN.items()}
    df = grid(spark, sf_dir).select(
        "k",
        F.when(on["home_ref"], "https://r.example/").alias("home_ref"),
        F.when(on["failed"], "timeout").alias("error"),
        pick(2, 1, (200, 200, 404)).alias("status"),
        F.when(on["protected"], "captcha").alias("protection"),
        pick(2, 4, ("text/html", "text/HTML; x", "image/png")).alias("content_type"),
        F.when(on["direct"], "a").alias("direct_source"),
        F.when(on["chain"], "external").alias("chain_reason"),
        number(2, 8, 6).alias("mentions"),
        number(2, 11, 2).alias("js_buttons"),
        on["file_ref"].alias("file_ref"),
        number(3, 2, 400).alias("text_len"),
        number(3, 11, 10).alias("links"),
        on["script"].alias("has_script"),
    )
    return groups.referral_scan(df).select("k", "group", "method", "reason", "flag")


GATES = (("https://s.example/go/1", 404, ""), ("https://s.example/go/2", 302, "out.example"), ("https://s.example/go/3", 200, ""))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k % 500 AS d, k, {sql_pick(0, 2, [u for u, _, _ in GATES])} AS url, {sql_pick(0, 2, [s for _, s, _ in GATES])} AS status, {sql_pick(0, 2, [o for _, _, o in GATES])} AS o, {sql_flag(1, 3)} AS gate FROM g)
SELECT 'd' || d AS domain, coalesce(string_agg(CASE WHEN status >= 400 THEN url END, ' ' ORDER BY k), '') AS dead, coalesce(string_agg(nullif(o, ''), ' ' ORDER BY k), '') AS other FROM a WHERE gate GROUP BY d
""")
def gate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC7: dead gates and the hosts that gates lead to, per site."""
    url, status, out = pick(0, 2, [u for u, _, _ in GATES]), pick(0, 2, [s for _, s, _ in GATES]), pick(0, 2, [o for _, _, o in GATES])
    first = F.struct(status.alias("status"), url.alias("url"))
    chain = F.when(out != "", F.array(first, F.struct(F.lit(200).alias("status"), F.concat(F.lit("https://"), out, F.lit("/x")).alias("url")))).otherwise(F.array(first))
    df = grid(spark, sf_dir).select(F.concat(F.lit("d"), F.pmod("k", F.lit(500)).cast("string")).alias("domain"), F.lit("s.example").alias("site"), F.col("k").alias("ordinal"), url.alias("url"), F.when(flag(1, 3), "internal_redirect_like").otherwise("external").alias("reason"), chain.alias("chain"))
    return groups.gate_flags(df).select("domain", F.array_join("gate_dead", " ").alias("dead"), F.array_join("gate_other", " ").alias("other"))


HOME = {"home": (0, 1, 9), "failed": (0, 4, 9), "markup": (0, 8, 9), "script": (1, 1, 2), "target": (1, 3, 3), "other": (1, 6, 3)}
SAID = ("", "Page about gardens and much more of it, at a length that makes it no empty page, " * 3, "This domain is parked", "not available in your country", "x")
DETAILS = ("Name or service not known", "Connection refused", "odd")
PROTECTED = (None, None, None, "captcha", "cloudflare_403")
REF_KINDS = ("target", "other", "needs_browser", "unknown")
MOVED = (None, None, None, "target", "other")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in HOME.items())}, {sql_pick(1, 9, REF_KINDS)} AS rk, {sql_pick(2, 1, ("connect_error", "timeout"))} AS err, {sql_pick(2, 3, DETAILS)} AS detail, {sql_pick(2, 6, PROTECTED)} AS prot, {sql_pick(2, 10, (200, 200, 200, 404, 451))} AS status,
  {sql_pick(3, 1, SAID)} AS x, {sql_pick(3, 5, ("text/html", "text/html", "image/png"))} AS ct, {sql_number(3, 8, 10)} AS links, {sql_pick(3, 12, MOVED)} AS moved, {sql_number(2, 14, 2)} AS pending, {sql_number(1, 13, 2)} AS cta, {sql_number(1, 15, 5)} AS mentions FROM g),
b AS (SELECT *, CASE WHEN target AND other THEN '4_mixed' WHEN target THEN '1_target_only' WHEN other THEN '3_other_only' ELSE '2_no_ads' END AS own, length(x) < 200 AND links < 5 AS thin FROM a),
c AS (SELECT *, CASE WHEN home AND rk = 'needs_browser' THEN 1 WHEN home THEN 2 WHEN failed THEN 3 WHEN prot = 'captcha' THEN 4 WHEN x LIKE '%is parked%' OR markup THEN 5 WHEN status >= 400 AND (x LIKE 'not available%' OR status = 451) THEN 6 WHEN status >= 400 THEN 7 WHEN ct = 'image/png' THEN 8 WHEN thin AND script THEN 9 WHEN thin AND length(x) < 30 THEN 10
  WHEN moved IS NOT NULL THEN 11 WHEN pending > 0 THEN 12 WHEN own = '2_no_ads' AND cta > 0 AND mentions >= 3 THEN 13 ELSE 0 END AS r FROM b)
SELECT k, CASE r WHEN 0 THEN own WHEN 2 THEN CASE rk WHEN 'target' THEN '1_target_only' WHEN 'other' THEN '3_other_only' ELSE '2_no_ads' END WHEN 3 THEN '5_dead' WHEN 5 THEN '5_dead' WHEN 10 THEN '5_dead' WHEN 6 THEN '5_not_shown' WHEN 7 THEN '5_not_shown' WHEN 8 THEN '5_not_shown' WHEN 11 THEN CASE moved WHEN 'target' THEN '1_target_only' ELSE '3_other_only' END ELSE 'needs_browser' END AS "group",
  CASE r WHEN 0 THEN '' WHEN 1 THEN 'home_redirect_needs_browser' WHEN 2 THEN 'home_redirect' WHEN 3 THEN CASE WHEN err = 'timeout' THEN 'timeout' WHEN detail LIKE 'Name%' THEN 'dns_fail' WHEN detail LIKE '%refused' THEN 'connection_refused' ELSE err END WHEN 4 THEN 'protection:captcha' WHEN 5 THEN 'parked' WHEN 6 THEN 'geo_block'
    WHEN 7 THEN coalesce(prot, 'http_' || status) WHEN 8 THEN 'not_html' WHEN 9 THEN 'js_shell' WHEN 10 THEN 'empty_page' WHEN 11 THEN 'home_redirect' WHEN 12 THEN 'destination_needs_browser' ELSE 'js_buttons' END AS reason, CASE WHEN r IN (12, 13) THEN own ELSE '' END AS undecided_group FROM c
""")
def home_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC8: what a plain scan of a home page says of a site."""
    on = {c: flag(*v) for c, v in HOME.items()}
    df = grid(spark, sf_dir).select(
        "k",
        F.when(on["home"], "https://r.example/").alias("home_ref"),
        pick(1, 9, REF_KINDS).alias("home_ref_kind"),
        F.when(on["failed"], pick(2, 1, ("connect_error", "timeout"))).alias("error"),
        pick(2, 3, DETAILS).alias("detail"),
        pick(2, 6, PROTECTED).alias("protection"),
        pick(2, 10, (200, 200, 200, 404, 451)).alias("status"),
        F.lit("").alias("title"),
        pick(3, 1, SAID).alias("text"),
        on["markup"].alias("parked_markup"),
        pick(3, 5, ("text/html", "text/html", "image/png")).alias("content_type"),
        number(3, 8, 10).alias("links"),
        on["script"].alias("has_script"),
        pick(3, 12, MOVED).alias("moved_brand"),
        on["target"].alias("target"),
        on["other"].alias("other"),
        number(2, 14, 2).alias("pending"),
        number(1, 13, 2).alias("js_cta"),
        number(1, 15, 5).alias("mentions"),
    )
    return groups.home_scan(df).select("k", "group", "reason", "undecided_group")


GROUPS = ("1_target_only", "2_no_ads", "3_other_only", "4_mixed", "5_dead", "5_not_shown", "7_unresolved", "8_no_mention")
POST_TITLES = ("acme.example club", "Shop", "this domain is parked", "Sorry, you have been blocked")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, h2, {sql_pick(0, 2, GROUPS)} AS grp, {sql_pick(0, 6, POST_TITLES)} AS t, {sql_number(1, 2, 3)} AS mentions, {sql_number(1, 5, 2)} AS nf, {sql_number(1, 7, 2)} AS un, {sql_pick(1, 9, ("http", "browser"))} AS mode, {sql_number(1, 11, 2)} AS jb, {sql_flag(2, 2, 3)} AS ever_t, {sql_flag(2, 5, 3)} AS ever_o, {sql_flag(2, 8, 2)} AS now_o, {sql_flag(2, 10, 3)} AS edge FROM g),
b AS (SELECT *, array_to_string(list_filter([CASE WHEN nf > 0 THEN 'not_followed=1' END, CASE WHEN un > 0 THEN 'unresolved=1' END, CASE WHEN mode = 'http' AND jb > 0 THEN 'js_buttons_not_clicked=1' END], lambda x: x IS NOT NULL), ' ') AS why,
  CASE WHEN grp IN ('2_no_ads', '5_not_shown') AND t = 'this domain is parked' THEN '5_dead' WHEN edge AND t <> 'Sorry, you have been blocked' THEN '6_check' ELSE grp END AS legacy,
  CASE WHEN grp IN ('2_no_ads', '5_not_shown') AND t = 'this domain is parked' THEN 'parked' WHEN edge AND t = 'Sorry, you have been blocked' THEN 'protection:cloudflare_block' WHEN edge THEN 'cloudflare_challenge' ELSE 'r' END AS legacy_reason FROM a),
c AS (SELECT *, CASE WHEN grp NOT IN ('1_target_only', '2_no_ads', '3_other_only', '4_mixed') THEN NULL WHEN t LIKE 'acme.example%' THEN '0_frontend' WHEN grp IN ('2_no_ads', '3_other_only') AND mentions = 0 THEN '8_no_mention' WHEN grp = '2_no_ads' AND why <> '' THEN '7_unresolved' END AS post,
  grp IN ('1_target_only', '4_mixed') OR ever_t AS tt, now_o OR ever_o AS oo FROM b)
SELECT k, legacy, legacy_reason, coalesce(post, grp) AS post, CASE post WHEN '0_frontend' THEN 'front_title' WHEN '8_no_mention' THEN 'not_on_home' WHEN '7_unresolved' THEN why ELSE '' END AS post_reason, why,
  CASE WHEN grp IN ('1_target_only', '2_no_ads', '3_other_only', '4_mixed', '7_unresolved', '8_no_mention') AND (tt OR (oo AND grp <> '8_no_mention')) THEN CASE WHEN tt AND oo THEN '4_mixed' WHEN tt THEN '1_target_only' ELSE '3_other_only' END ELSE grp END AS lifted FROM c
""")
def group_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC10, DC11: groups corrected after the scan, and lifted by what earlier scans saw."""
    why = groups.incomplete(number(1, 5, 2), number(1, 7, 2), pick(1, 9, ("http", "browser")), number(1, 11, 2))
    group, title = pick(0, 2, GROUPS), pick(0, 6, POST_TITLES)
    brands = lambda c: F.when(c, F.array(F.lit("Globex"))).otherwise(nothing())
    df = grid(spark, sf_dir).withColumns({"group": group, "title": title, "text_sample": F.lit(""), "reason": F.when(flag(2, 10, 3), "protection:cloudflare").otherwise("r"), "incomplete": why, "own": group})
    df = groups.regroup_legacy(df)
    new = groups.post_group(F.col("own"), F.col("title"), number(1, 2, 3), F.col("incomplete"))
    return df.select("k", F.col("group").alias("legacy"), F.col("reason").alias("legacy_reason"), F.coalesce(new["group"], "own").alias("post"), F.coalesce(new["reason"], F.lit("")).alias("post_reason"), F.array_join("incomplete", " ").alias("why"), groups.with_history(F.col("own"), brands(flag(2, 8, 2)), flag(2, 2, 3), brands(flag(2, 5, 3))).alias("lifted"))


MOVES = ("https://x7q.example/Ab3d?pid=1", "https://plain.example/", "https://www.d.example/", "https://new.example/?btag=9", "", "https://acme-mb.example/?ref=2")
MOVE_TITLES = ("Acme", "Jackpot", "Domain for sale", "Garden")
JUMPS = ("https://go.acme.com/Zz9x", "https://bcdfg.example/1", "https://plain.example/x", "https://short-list.example/y", "")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_pick(0, 2, MOVES)} AS f, {sql_pick(0, 6, MOVE_TITLES)} AS t, {sql_flag(1, 2, 7)} AS home, {sql_flag(1, 5, 5)} AS direct, {sql_flag(1, 8, 4)} AS pids, {sql_flag(1, 11, 4)} AS brands, {sql_flag(2, 2, 5)} AS grp, {sql_flag(2, 5, 3)} AS named, {sql_pick(3, 2, JUMPS)} AS j FROM g),
b AS (SELECT *, {s_hostname("f")} AS h, {s_host("f")} AS hb, {s_part("f", 3)} AS p, {s_part("f", 4)} AS q, CASE WHEN named THEN 'acme.d.example' ELSE 'd.example' END AS domain, {s_host("j")} AS jb, {s_hostname("j")} AS jh, {s_part("j", 3)} AS jp, {s_part("j", 4)} AS jq FROM a),
c AS (SELECT *, h <> '' AND NOT (hb = domain OR ends_with(hb, '.' || domain) OR ends_with(domain, '.' || hb)) AS away, {s_has("q", AFFILIATE_NAMES)} OR {s_has("q", TRACKER_NAMES)} OR {s_ref("f", "h", "p", "q", "domain")} IS NOT NULL AS marked,
  ({s_random("h")} AND NOT (p IN ('', '/') AND q = '')) OR (regexp_matches(p, '^/[A-Za-z0-9_-]{{4,12}}/?$') AND regexp_matches(p, '[A-Z0-9]')) OR {s_has("q", AFFILIATE_NAMES)} OR {s_has("q", TRACKER_NAMES)} AS looks,
  ({s_random("jh")} AND NOT (jp IN ('', '/') AND jq = '')) OR (regexp_matches(jp, '^/[A-Za-z0-9_-]{{4,12}}/?$') AND regexp_matches(jp, '[A-Z0-9]')) AS jlooks FROM b),
d AS (SELECT *, CASE WHEN home THEN 1 WHEN direct AND h = '' AND pids THEN 2 WHEN direct AND h = '' AND brands THEN 3 WHEN NOT (away AND marked) THEN 4 WHEN pids OR grp OR (contains(q, 'pid=') AND t = 'Acme') THEN 5 WHEN NOT (brands OR t = 'Jackpot' OR looks) THEN 6 WHEN t = 'Domain for sale' THEN 7 WHEN NOT named AND t <> 'Acme' THEN 8 ELSE 0 END AS r FROM c)
SELECT k, CASE r WHEN 1 THEN 'redirect_ref' WHEN 2 THEN 'redirect_ref' WHEN 3 THEN 'redirect_other' WHEN 5 THEN 'redirect_ref' WHEN 7 THEN 'parked' WHEN 8 THEN 'other_topic' WHEN 0 THEN 'redirect_other' END AS redirect,
  CASE r WHEN 1 THEN 'redirect: a referral link' WHEN 2 THEN 'redirect: pid 77' WHEN 3 THEN 'redirect: Globex' WHEN 4 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN 'parking page' ELSE 'redirect: ' || h END AS redirect_why,
  CASE WHEN jb = '' THEN NULL WHEN jb = 'short-list.example' THEN 'redirect_ref' WHEN {s_ref("j", "jh", "jp", "jq", "domain")} IS NOT NULL OR contains(jb, 'acme') THEN 'redirect_ref' WHEN jlooks THEN 'redirect_other' END AS script_redirect FROM d
""")
def site_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC17: home pages that send visitors away, by the server or by a script."""
    df = grid(spark, sf_dir).select(
        "k",
        F.when(flag(2, 5, 3), "acme.d.example").otherwise("d.example").alias("domain"),
        pick(0, 2, MOVES).alias("final_url"),
        F.when(flag(1, 2, 7), "home_redirect").alias("home_group"),
        F.when(flag(1, 5, 5), "home_redirect").alias("scan_method"),
        F.lit(None).cast("string").alias("ref_method"),
        pick(0, 6, MOVE_TITLES).alias("title"),
        F.when(flag(1, 8, 4), "77").otherwise("").alias("pids"),
        F.when(flag(2, 2, 5), "1_target_only").otherwise("2_no_ads").alias("group"),
        F.when(flag(1, 11, 4), "Globex").otherwise("").alias("brands"),
        pick(3, 2, JUMPS).alias("js_redirect"),
    )
    resolved = spark.sql("SELECT * FROM VALUES ('https://short-list.example/y/', 'https://www.go.acme.com/1'), ('https://plain.example/x', 'https://nobody.example/') AS (url, final_url)")
    out = decisions.script_redirect_target(decisions.redirect_target(df), resolved)
    return out.select("k", "redirect", "redirect_why", "script_redirect")


SHOWN = ("Globex", "globex.example", "via tr.example", "via hooli.example", "acme.example", "Two words.here")
SHOWN_AS = ("Globex", "Globex", "tracker tr.example", "Hooli", "tracker acme.example", "Two words.here")
CODES = ("ok", "nxdomain", "noanswer", "timeout")
CHECKS = (None, "confirmed", "unsure", "fixed")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {sql_flag(0, 2)} AS mentioned, {sql_pick(0, 4, ("negative", "positive", "neutral", None))} AS tone, {sql_flag(0, 7)} AS others, {sql_pick(1, 2, SHOWN_AS)} AS shown, {sql_pick(1, 6, CODES)} AS a4, {sql_pick(1, 9, CODES)} AS a6, {sql_flag(1, 12, 9)} AS bad, {sql_flag(1, 17)} AS ips,
  {sql_pick(2, 2, CHECKS)} AS chk, {sql_flag(2, 5)} AS viol, {sql_number(2, 7, 11)} / 10.0 AS conf, {sql_number(2, 12, 101)} AS vs, {sql_pick(3, 2, ("unrelated", "other_topic", "mono"))} AS cat, {sql_number(3, 5, 3)} AS m, {sql_flag(3, 8)} AS ad, {sql_flag(3, 10)} AS tag, {sql_pick(3, 12, ("correct", "wrong", "unsure"))} AS v, {sql_number(3, 15, 100)} AS w FROM g)
SELECT k, CASE WHEN mentioned THEN CASE tone WHEN 'negative' THEN 'negative' WHEN 'positive' THEN 'ok' ELSE 'neutral' END WHEN others THEN 'absent' ELSE 'n/a' END AS bucket, shown,
  CASE WHEN bad THEN 'error' WHEN a4 = 'nxdomain' THEN 'nxdomain' WHEN (a4 = 'ok' AND ips) OR a6 = 'ok' THEN 'resolves' WHEN a4 = 'noanswer' AND a6 IN ('noanswer', 'nxdomain') THEN 'no_address' ELSE 'error' END AS dns,
  CASE WHEN NOT bad AND a4 <> 'nxdomain' THEN trim(CASE WHEN a4 = 'ok' AND ips THEN '10.0.0.1' ELSE '' END || CASE WHEN a6 = 'ok' THEN ' ::1' ELSE '' END) ELSE '' END AS ips,
  CASE WHEN viol THEN conf >= 0.8 WHEN chk IS NOT NULL THEN false ELSE vs >= 90 END AS sure, CASE WHEN chk IS NOT NULL THEN viol AND conf * 100 >= 90 ELSE vs >= 90 END AS reported,
  cat IN ('unrelated', 'other_topic') AND NOT tag AND m = 0 AND NOT ad AS fp, NOT (v <> 'unsure' AND cat = 'mono') OR conf < 0.7 AS review, w > 50 AND NOT bad AS usable FROM a
""")
def verdict_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC22, DC24, DC25, FLT3 to FLT6, FLT9."""
    conf = number(2, 7, 11) / 10.0
    dns = decisions.dns_status(pick(1, 6, CODES), F.when(flag(1, 17), F.array(F.lit("10.0.0.1"))).otherwise(nothing()), pick(1, 9, CODES), F.array(F.lit("::1")), ~flag(1, 12, 9))
    cat = pick(3, 2, ("unrelated", "other_topic", "mono"))
    return grid(spark, sf_dir).select(
        "k",
        decisions.answer_bucket(flag(0, 2), pick(0, 4, ("negative", "positive", "neutral", None)), F.when(flag(0, 7), F.array(F.lit("Globex"))).otherwise(nothing())).alias("bucket"),
        decisions.display_name(pick(1, 2, SHOWN)).alias("shown"),
        dns["status"].alias("dns"),
        dns["ips"].alias("ips"),
        decisions.sure_violator(pick(2, 2, CHECKS), flag(2, 5), conf, number(2, 12, 101)).alias("sure"),
        decisions.report_violator(pick(2, 2, CHECKS), flag(2, 5), conf, number(2, 12, 101)).alias("reported"),
        decisions.false_positive(cat, F.when(flag(3, 10), F.array(F.lit("brand_in_domain"))).otherwise(nothing()), number(3, 5, 3).cast("string"), F.lit(""), flag(3, 8)).alias("fp"),
        decisions.needs_review(pick(3, 12, ("correct", "wrong", "unsure")), cat, F.lit("mono"), conf).alias("review"),
        decisions.page_usable(F.when(flag(1, 12, 9), "404").otherwise("cached"), number(3, 15, 100)).alias("usable"),
    )


ENDS = {"looped": (0, 1, 9), "checked": (0, 5, 7), "inside": (0, 9, 5)}
ERRORS = (None, None, None, "timeout", "connect_error")
TYPES = ("text/html", "text/html", "application/octet-stream", "image/png")
LAST = ("https://acme.example/f", "https://o.example/f")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, {", ".join(f"{sql_flag(*v)} AS {c}" for c, v in ENDS.items())}, {sql_pick(1, 2, ERRORS)} AS e, {sql_pick(1, 6, (200, 200, 200, 403, 404))} AS s, {sql_pick(1, 10, TYPES)} AS ct, {sql_pick(2, 2, ("fields:x", "topic_words", "assets"))} AS ev, {sql_number(2, 6, 1000)} AS n, {sql_pick(3, 2, LAST)} AS f FROM g)
SELECT k, CASE WHEN looped THEN 'dead' WHEN e = 'timeout' THEN 'needs_browser' WHEN e IS NOT NULL THEN 'dead' WHEN checked OR s = 403 THEN 'needs_browser' WHEN s >= 400 THEN 'dead' WHEN ct LIKE 'app%' THEN CASE WHEN f LIKE '%acme%' THEN 'target' ELSE 'download' END WHEN ct = 'image/png' THEN 'unknown' WHEN inside THEN 'internal' WHEN ev = 'topic_words' AND n < 500 THEN 'needs_browser' ELSE 'other' END AS kind,
  CASE WHEN looped THEN 'too_many_redirects' WHEN e = 'timeout' THEN 'undecided' WHEN e IS NOT NULL THEN e WHEN checked OR s = 403 THEN 'undecided' WHEN s >= 400 THEN 'http_404' WHEN ct LIKE 'app%' THEN 'download:' || ct WHEN ct = 'image/png' THEN 'not_html:image/png' WHEN inside THEN 'stayed_on_site' WHEN ev = 'topic_words' AND n < 500 THEN 'undecided' ELSE ev END AS evidence FROM a
""")
def landing_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT2: what the end of a followed chain is."""
    on = {c: flag(*v) for c, v in ENDS.items()}
    end: Column = chains.landing(pick(1, 6, (200, 200, 200, 403, 404)), pick(1, 2, ERRORS), pick(1, 10, TYPES), on["checked"], on["inside"], F.lit("other"), pick(2, 2, ("fields:x", "topic_words", "assets")), number(2, 6, 1000), pick(3, 2, LAST), on["looped"])
    return grid(spark, sf_dir).select("k", end.alias("e")).select("k", "e.kind", "e.evidence")


@query(f"""
WITH g AS ({GRID}) SELECT k, CASE WHEN {sql_flag(0, 3)} THEN CASE WHEN {sql_flag(1, 3)} THEN 'Globex' ELSE 'Globex Initech' END ELSE 'Globex Hooli Initech' END AS names FROM g
""".replace("CASE WHEN {0} THEN", "CASE WHEN"))
def home_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HP7: stored hits of stale patterns stay only where the title confirms them."""
    names = F.array(F.lit("Globex"), F.lit("Hooli"), F.lit("Initech"))
    title = F.when(~flag(0, 3), "hooli and initech").when(flag(1, 3), "nobody").otherwise("ini-tech")
    return grid(spark, sf_dir).select("k", F.array_join(groups.home_mentions(names, title, STALE), " ").alias("names"))


