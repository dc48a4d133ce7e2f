"""Scans over captured pages: each page as the landing of a link, what it is, whom its site advertises and what protects it.

A page is reached from the page numbered one lower (the first one from itself); an address that goes from http to https
counts as redirected. Statuses, servers and marks of bot checks, which pages do not hold, go by page number. The SQL reads
the same pages by regular expressions and says the rules again.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import AFFILIATE_NAMES, CODE_NAMES, TRACKER_NAMES, under
from tessera.functions import html as H
from tessera.functions import url as U
from tessera.operators import chains, decisions, evidence, groups
from tessera.plans.inputs import read
from tessera.plans.q_site_pages import BRAND, GAMES, RIVALS, S_SEEN
from tessera.plans.q_site_pages import CONFIG as SITES
from tessera.plans.q_urls import s_has, s_host, s_part, s_random, s_same
from tessera.plans.registry import query

TOPIC, STRONG, BLOCKED, GEO = "ention|ción|èè|sch", 'href="/en"', "^the ", "heron|eaual"
STALE = ("Que", "Ou")
REGISTRAR, NOT_TRADE, PARKED = r"m\.[a-z]+\.example\.net", r"blog\.[a-z]+\.example\.org", "cheap-pills"
CONFIG = dataclasses.replace(
    SITES,
    topic=f"(?iU){TOPIC}",
    strong=f"(?i){STRONG}",
    stale=STALE,
    blocked_title=f"(?i){BLOCKED}",
    geo_block=f"(?i){GEO}",
    registrar_hosts=under((REGISTRAR,)),
    not_trade_hosts=under((NOT_TRADE,)),
)


def landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page, parsed, with its markup and the way it was reached: start_url, final_url, redirected, hops."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    before = pages.groupBy((F.col("page_id") + 1).alias("page_id")).agg(F.min("url").alias("before"))
    seen = H.parse_pages(pages.withColumn("markup", F.col("html")), "html", "url", ("title", "text", "names", "operator_names")).withColumnRenamed("markup", "html")
    reached = seen.join(before, "page_id", "left").withColumns({"start_url": F.coalesce("before", "url"), "final_url": F.col("url")})
    moved = F.col("start_url").startswith("http:") & F.col("final_url").startswith("https:")
    return reached.withColumns({"redirected": moved, "hops": F.when(moved, F.array("start_url")), "domain": U.url_host(F.col("start_url"))}).drop("before")


def s_any(text: str, part: str) -> str:
    return f"regexp_matches({text}, '(?i){part}')"


def s_rival(*texts: str) -> str:
    """The first competitor that any of the texts names."""
    return "CASE " + " ".join(f"WHEN {' OR '.join(s_any(t, rx) for t in texts)} THEN '{n}'" for n, rx in RIVALS) + " END"


FIELDS = "array_to_string(list_filter([t, h], lambda x: x <> ''), ' | ')"
_HIT = [(n, f"{s_any('fields', rx)} AND (topic OR {s_any('h', rx)})", f"regexp_extract(fields, '(?i){rx}')") for n, rx in RIVALS]
S_LANDINGS = f"""{S_SEEN},
reached AS (SELECT p.page_id, coalesce(o.url, p.url) AS u, p.url AS f, p.html AS m, p.title AS t, p.text AS x, p.hostname AS h FROM seen p LEFT JOIN seen o ON o.page_id = p.page_id - 1),
way AS (SELECT *, starts_with(u, 'http:') AND starts_with(f, 'https:') AS redirected, {s_host("u")} AS domain, {s_host("f")} AS fh, {s_part("u", 4)} AS uq, {s_part("f", 4)} AS fq, {FIELDS} AS fields, {s_any("t || ' ' || substr(x, 1, 3000)", TOPIC)} AS topic FROM reached),
met AS (SELECT *, CASE {" ".join(f"WHEN {c} THEN '{n}'" for n, c, _ in _HIT)} END AS rival, CASE {" ".join(f"WHEN {c} THEN {p}" for _, c, p in _HIT)} END AS part, substr(trim(regexp_replace(t, '\\s[|\\-–—:]\\s.*$', '')), 1, 60) AS raw FROM way),
told AS (SELECT *, CASE WHEN {s_any("m", STRONG)} THEN 1 WHEN rival IS NOT NULL THEN 2 WHEN {s_any("fields", BRAND)} THEN 3 WHEN topic THEN 4 WHEN length(x) < 100 AND length(m) < 5000 THEN 5 ELSE 0 END AS r FROM met),
kinds AS (SELECT *, ['off_topic', 'target', 'other', 'target', 'other', 'unknown'][r + 1] AS kind, CASE r WHEN 2 THEN 'fields:' || part ELSE ['no_topic_words', 'assets', '', 'name_only', 'topic_words', 'empty_page'][r + 1] END AS evidence,
  CASE r WHEN 1 THEN 'Ther' WHEN 3 THEN 'Ther' WHEN 2 THEN rival WHEN 4 THEN coalesce(nullif(raw, ''), '?') WHEN 0 THEN raw ELSE '' END AS brand FROM told)
"""


@query(f"WITH {S_LANDINGS} SELECT page_id, kind, brand, evidence FROM kinds")
def page_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC1, HT9: whose page each captured page is, and what in its markup, title, host or words says so."""
    return decisions.identify(landings(spark, sf_dir), CONFIG).select("page_id", "kind", "brand", "evidence")


def s_marked(q: str) -> str:
    return f"({s_has(q, AFFILIATE_NAMES)} OR {s_has(q, TRACKER_NAMES)})"


def s_refined(source: str, out: str) -> str:
    """refine in SQL over kind, brand, evidence, t, h, route, tracked, hopped and open."""
    gone = " OR ".join(f"(brand = '{n}' AND NOT {s_any('t', rx)} AND NOT {s_any('h', rx)})" for n, rx in RIVALS if n in STALE)
    return f"""
    {out}1 AS (SELECT *, kind IN ('other', 'topic_site') AND open AS o, regexp_matches(h, '(^|\\.)({REGISTRAR})$') OR {s_any("t", PARKED)} AS parking, {s_any("t", BRAND)} OR {s_any("h", BRAND)} AS own FROM {source}),
    {out}2 AS (SELECT *, o AND NOT parking AND starts_with(evidence, 'fields:') AND ({gone}) AS stale FROM {out}1),
    {out}3 AS (SELECT * EXCLUDE (kind, brand, evidence), o AND NOT parking AND NOT (stale AND own) AS still, CASE WHEN o AND parking THEN 'off_topic' WHEN stale AND own THEN CASE WHEN route THEN 'target' ELSE 'brand_site' END WHEN stale THEN CASE WHEN route THEN 'other' ELSE 'topic_site' END ELSE kind END AS kind,
      CASE WHEN o AND parking THEN '' WHEN stale AND own THEN 'Ther' WHEN stale THEN coalesce(nullif(substr(trim(regexp_replace(t, '\\s[|\\-–—:ᐉᐈ»•·]\\s.*$', '')), 1, 60), ''), '?') ELSE brand END AS brand, CASE WHEN o AND parking THEN 'parked_or_registrar' WHEN stale AND own THEN 'name_only' WHEN stale THEN 'topic_words' ELSE evidence END AS evidence FROM {out}2),
    {out}4 AS (SELECT *, still AND evidence = 'topic_words' AS vague, still AND evidence = 'topic_words' AND kind = 'other' AND hopped AND NOT tracked AS loose FROM {out}3),
    {out}5 AS (SELECT *, CASE WHEN vague AND NOT loose THEN {s_rival("t", "h")} END AS known FROM {out}4),
    {out}6 AS (SELECT *, vague AND NOT loose AND known IS NULL AND {s_any("t", BLOCKED)} AS blocked FROM {out}5),
    {out} AS (SELECT * EXCLUDE (o, parking, own, stale, still, vague, loose, known, blocked, kind, brand, evidence), CASE WHEN loose THEN 'topic_site' WHEN blocked THEN 'unknown' ELSE kind END AS kind, CASE WHEN known IS NOT NULL THEN known WHEN blocked THEN '' ELSE brand END AS brand,
      CASE WHEN loose THEN 'unrecognized_no_tracker' WHEN known IS NOT NULL THEN 'title_or_host:' || known WHEN blocked THEN 'blocked_page' ELSE evidence END AS evidence FROM {out}6)
    """


_DEMOTED = f"CASE WHEN NOT route AND kind = 'target' AND evidence = 'name_only' THEN 'brand_site' WHEN NOT route AND kind = 'other' AND {s_any('fields', BRAND)} THEN 'brand_site' WHEN NOT route AND kind = 'other' AND evidence = 'topic_words' THEN 'topic_site' END"
S_DESTINATIONS = f"""{S_LANDINGS},
routed AS (SELECT *, redirected OR {s_has("uq", AFFILIATE_NAMES)} OR {s_has("fq", AFFILIATE_NAMES)} AS route, redirected AS hopped, {s_marked("uq")} OR {s_marked("fq")} OR (uq <> '' AND domain <> '' AND fh <> '' AND domain <> fh) AS tracked FROM kinds),
plain AS (SELECT * EXCLUDE (kind), coalesce({_DEMOTED}, kind) AS kind, {_DEMOTED} IS NULL AS open FROM routed), {s_refined("plain", "dests")}
"""


def destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.classify_destination(landings(spark, sf_dir), CONFIG)


@query(f"WITH {S_DESTINATIONS} SELECT page_id, domain, kind, brand, evidence, route AS ad_route FROM dests")
def page_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC2, DC3, DC4, DC5: captured pages as destinations of links, by the way they were reached."""
    return destinations(spark, sf_dir).select("page_id", "domain", "kind", "brand", "evidence", "ad_route")


@query(f"""
WITH {S_LANDINGS}, stored AS (SELECT *, false AS route, false AS hopped, false AS tracked, true AS open FROM kinds), {s_refined("stored", "once")}, {s_refined("once", "twice")}
SELECT page_id, kind, brand, evidence FROM twice
""")
def page_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC4: stored kinds of captured pages, of which no way is known, judged again by host and title, and once more."""
    stored = decisions.identify(landings(spark, sf_dir), CONFIG).select("page_id", "title", "final_url", "kind", "brand", "evidence")
    return decisions.refine(decisions.refine(stored, CONFIG), CONFIG).select("page_id", "kind", "brand", "evidence")


MARKS = ("sorry, you have been blocked", "cf-turnstile captcha", "cf-chl", "challenges.cloudflare.com", "DDOS-GUARD", "sucuri", "hcaptcha", "g-recaptcha", "captcha", "plain", "/cdn-cgi/challenge-platform/scripts/jsd/main.js", *["plain"] * 12)
#: The kind by a mark where the page counts as a check, and whether the mark alone makes a short page one.
WALLS = ("cloudflare_block", "cloudflare_turnstile", "cloudflare_challenge", "cloudflare_challenge", "ddos_guard", "sucuri", "hcaptcha", "recaptcha", "captcha", *["bot_check"] * 14)
ALONE = (0, 1, 1, 1, 1, 1, 1, 1, 1, *[0] * 14)
SERVERS = ("cloudflare", "nginx", "nginx", "ddos-guard", *["nginx"] * 9)
STATUSES = (200, 403, 200, 200, 503, 200, 404)
MOMENT = 17


def turn(values: tuple, column: str = "page_id") -> Column:
    """The value whose turn a page number is."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(column) % len(values) + 1).cast("int"))


def s_turn(values: tuple, column: str = "page_id") -> str:
    return f"[{', '.join(repr(v) for v in values)}][{column} % {len(values)} + 1]"


S_WALLS = f"""
given AS (SELECT *, {s_turn(MARKS)} AS mark, {s_turn(WALLS)} AS wall_kind, {s_turn(ALONE)} AS alone, {s_turn(SERVERS)} AS server, {s_turn(STATUSES)} AS status, page_id % {MOMENT} = 0 AS titled FROM seen),
sized AS (SELECT *, length(html) + length(mark) + 7 + CASE WHEN titled THEN 14 ELSE 0 END AS n, CASE WHEN titled THEN 'Just a moment ' ELSE '' END || title AS t FROM given),
walls AS (SELECT page_id, url, hostname, text, t, status, server, CASE WHEN titled OR (alone = 1 AND length(text) < 1000) THEN wall_kind END AS wall,
  CASE WHEN contains(mark, 'challenge-platform') OR mark = 'cf-chl' OR (server = 'cloudflare' AND status IN (403, 503) AND titled) THEN 'cloudflare_challenge' WHEN status < 400 AND n >= 8000 THEN NULL WHEN server = 'ddos-guard' OR mark = 'DDOS-GUARD' THEN 'ddos_guard'
    WHEN contains(mark, 'captcha') THEN 'captcha' WHEN server = 'cloudflare' AND status >= 400 THEN 'cloudflare_' || status END AS protected FROM sized)
"""


def walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed pages with a mark in a comment and, at times, the title of a check; wall and protected."""
    mark = F.concat(F.lit("<!--"), turn(MARKS), F.lit("--></head>"))
    titled = F.when(F.col("page_id") % MOMENT == 0, F.regexp_replace("html", "<title>", "<title>Just a moment ")).otherwise(F.col("html"))
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.replace(titled, F.lit("</head>"), mark).alias("html"))
    seen = H.parse_pages(pages.withColumn("markup", F.col("html")), "html", "url", ("title", "text", "n_links", "scripts"))
    wall = decisions.challenge_kind(F.col("title"), F.col("markup"), F.col("text"))
    protected = decisions.protection(turn(STATUSES), turn(SERVERS), F.lit(None).cast("string"), F.col("markup"))
    return seen.withColumns({"wall": wall, "protected": protected, "status": turn(STATUSES)})


@query(f"WITH {S_SEEN}, {S_WALLS} SELECT page_id, wall, protected FROM walls")
def page_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC6: captured pages as bot checks, by titles, marks and the length of their text, and what protects them."""
    return walls(spark, sf_dir).select("page_id", "wall", "protected")


#: What the page numbered one higher is, to a page that leads there.
S_LED = f"{S_DESTINATIONS}, led AS (SELECT page_id - 1 AS page_id, kind = 'target' AS target, kind = 'other' AS other FROM dests)"


@query(f"""
WITH {S_LED}, {S_WALLS},
linked AS (SELECT page_id, count(DISTINCT path) AS links FROM anchors GROUP BY page_id),
a AS (SELECT w.page_id, w.text AS x, w.t || ' ' || substr(w.text, 1, 3000) AS said, w.status, w.protected, coalesce(l.links, 0) AS links, coalesce(d.target, false) AS target, coalesce(d.other, false) AS other FROM walls w LEFT JOIN linked l USING (page_id) LEFT JOIN led d USING (page_id)),
b AS (SELECT *, CASE WHEN protected IN ('cloudflare_challenge', 'ddos_guard', 'captcha', 'sucuri') THEN 4 WHEN {s_any("said", PARKED)} THEN 5 WHEN status >= 400 AND {s_any("said", GEO)} THEN 6 WHEN status >= 400 THEN 7 WHEN length(x) < 200 AND links < 5 THEN 9 ELSE 0 END AS r,
  CASE WHEN target AND other THEN '4_mixed' WHEN target THEN '1_target_only' WHEN other THEN '3_other_only' ELSE '2_no_ads' END AS own FROM a)
SELECT page_id, CASE r WHEN 0 THEN own WHEN 4 THEN 'needs_browser' WHEN 9 THEN 'needs_browser' WHEN 5 THEN '5_dead' ELSE '5_not_shown' END AS "group",
  CASE r WHEN 0 THEN '' WHEN 4 THEN 'protection:' || protected WHEN 5 THEN 'parked' WHEN 6 THEN 'geo_block' WHEN 7 THEN coalesce(protected, 'http_' || status) ELSE 'js_shell' END AS reason FROM b
""")
def page_home_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC8: what a plain scan of each captured page says: its protection, text and links, and the kind of the page it leads to."""
    led = destinations(spark, sf_dir).groupBy((F.col("page_id") - 1).alias("page_id")).agg(F.bool_or(F.col("kind") == "target").alias("target"), F.bool_or(F.col("kind") == "other").alias("other"))
    none, zero = F.lit(None).cast("string"), F.lit(0)
    own = walls(spark, sf_dir).join(led, "page_id", "left")
    records = own.select(
        "page_id", "title", "text", "status", F.col("protected").alias("protection"), F.col("n_links").alias("links"), F.coalesce("target", F.lit(False)).alias("target"), F.coalesce("other", F.lit(False)).alias("other"),
        (F.col("scripts") != "").alias("has_script"), F.lit("text/html").alias("content_type"), F.lit(False).alias("parked_markup"),
        *[none.alias(c) for c in ("home_ref", "home_ref_kind", "error", "detail", "moved_brand")], *[zero.alias(c) for c in ("pending", "js_cta", "mentions")],
    )
    return groups.home_scan(records, CONFIG).select("page_id", "group", "reason")


@query(f"""
WITH {S_DESTINATIONS}, g AS (SELECT domain, count(*) AS dests, bool_or(kind = 'target') AS target, bool_or(kind = 'other') AS other, count(*) FILTER (WHERE kind = 'unknown')::INT AS unresolved,
  array_to_string(list_sort(list(DISTINCT brand) FILTER (WHERE kind = 'other' AND brand <> '')), ', ') AS brands FROM dests GROUP BY domain)
SELECT domain, dests, CASE WHEN target AND other THEN '4_mixed' WHEN target THEN '1_target_only' WHEN other THEN '3_other_only' ELSE '2_no_ads' END AS "group", coalesce(brands, '') AS brands, unresolved FROM g
""")
def page_site_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG15, HP12: the group of each site by the destinations that its captured pages lead to, and the brands of others."""
    kept = destinations(spark, sf_dir).select("domain", "kind", "brand")
    other = (F.col("kind") == "other") & (F.col("brand") != "")
    found = kept.groupBy("domain").agg(F.count("*").alias("dests"), F.bool_or(F.col("kind") == "target").alias("target"), F.bool_or(F.col("kind") == "other").alias("other"), F.count_if(F.col("kind") == "unknown").cast("int").alias("unresolved"), F.array_join(F.array_sort(F.collect_set(F.when(other, F.col("brand")))), ", ").alias("brands"))
    return found.select("domain", "dests", groups.site_group(F.col("target"), F.col("other")).alias("group"), "brands", "unresolved")


S_LOOKS = f"""(({s_random("h")} AND NOT ({s_part("f", 3)} IN ('', '/') AND fq = '')) OR (regexp_matches({s_part("f", 3)}, '^/[A-Za-z0-9_-]{{4,12}}/?$') AND regexp_matches({s_part("f", 3)}, '[A-Z0-9]')) OR {s_marked("fq")})"""


@query(f"""
WITH {S_DESTINATIONS}, a AS (SELECT *, h <> '' AND NOT {s_same("fh", "domain")} AND {s_marked("fq")} AS moved, CASE WHEN kind = 'other' THEN brand ELSE '' END AS brands FROM dests),
b AS (SELECT *, CASE WHEN NOT moved THEN NULL WHEN NOT (brands <> '' OR {s_any("t", TOPIC)} OR {s_any("t", GAMES)} OR {S_LOOKS}) THEN NULL WHEN {s_any("t || ' ' || f", PARKED)} THEN 'parked' WHEN NOT {s_any("domain", BRAND)} AND NOT {s_any("t", BRAND)} THEN 'other_topic' ELSE 'redirect_other' END AS redirect FROM a)
SELECT page_id, redirect, CASE WHEN redirect = 'parked' THEN 'parking page' WHEN redirect IS NOT NULL THEN 'redirect: ' || h END AS redirect_why FROM b
""")
def page_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC17, UR11: captured pages as what the site of the page before them was moved to."""
    none = F.lit(None).cast("string")
    brands = F.when(F.col("kind") == "other", F.col("brand")).otherwise("")
    sites = destinations(spark, sf_dir).select("page_id", "domain", "final_url", "title", brands.alias("brands"), *[none.alias(c) for c in ("home_group", "scan_method", "ref_method", "pids", "group")])
    return decisions.redirect_target(sites, CONFIG).select("page_id", "redirect", "redirect_why")


TYPES = ("text/html", "text/html", "text/html; charset=utf-8", "application/octet-stream", "image/png")


@query(f"""
WITH {S_DESTINATIONS}, a AS (SELECT *, {s_turn(STATUSES)} AS status, {s_turn(TYPES, "page_id // 5")} AS ct, fh = domain AS inside FROM dests)
SELECT page_id, CASE WHEN status = 403 OR status = 503 THEN 'needs_browser' WHEN status >= 400 THEN 'dead' WHEN ct LIKE 'app%' THEN CASE WHEN {s_any("f", BRAND)} THEN 'target' ELSE 'download' END WHEN ct = 'image/png' THEN 'unknown' WHEN inside THEN 'internal' WHEN evidence <> 'assets' AND NOT starts_with(evidence, 'fields:') AND length(x) < 500 THEN 'needs_browser' ELSE kind END AS kind,
  CASE WHEN status = 403 OR status = 503 THEN 'undecided' WHEN status >= 400 THEN 'http_404' WHEN ct LIKE 'app%' THEN 'download:' || ct WHEN ct = 'image/png' THEN 'not_html:' || ct WHEN inside THEN 'stayed_on_site' WHEN evidence <> 'assets' AND NOT starts_with(evidence, 'fields:') AND length(x) < 500 THEN 'undecided' ELSE evidence END AS evidence FROM a
""")
def page_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT2: captured pages as ends of followed chains: their answers, whether they lie on the site itself, and their text."""
    no = F.lit(False)
    types = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.floor(F.col("page_id") / 5) % len(TYPES) + 1).cast("int"))
    inside = U.url_host(F.col("final_url")) == F.col("domain")
    end = chains.landing(turn(STATUSES), F.lit(None).cast("string"), types, no, inside, F.col("kind"), F.col("evidence"), F.length("text"), F.col("final_url"), no, CONFIG)
    return destinations(spark, sf_dir).select("page_id", end.alias("e")).select("page_id", "e.kind", "e.evidence")


def s_coded(q: str) -> str:
    return f"({s_marked(q)} OR {s_has(q, CODE_NAMES)})"


_SIDES = {8: "target", 10: "target", 12: "other", 13: "other", 15: "plain", 17: "other", 18: "plain", 20: "other", 21: "unverified"}
S_VERDICTS = f"""{S_DESTINATIONS}, trackers AS (SELECT DISTINCT host FROM seen WHERE starts_with(host, 'm.')),
a AS (SELECT *, {s_coded("fq")} OR (redirected AND {s_coded("uq")}) AS coded, redirected AND domain <> '' AND domain <> fh AS passed, kind IN ('other', 'topic_site') AS trade, kind = 'unknown' AS undecided, brand NOT IN ('', '?') AS known,
  coalesce(CASE WHEN {s_any("fh", BRAND)} THEN 'Ther' ELSE {s_rival("fh")} END, '') AS by_host, NOT regexp_matches(fh, '(^|\\.)({NOT_TRADE})$') AS business, fh IN (SELECT host FROM trackers) AS tracker FROM dests),
b AS (SELECT *, by_host NOT IN ('', 'Ther') AS oper FROM a),
verdicts AS (SELECT *, CASE WHEN (undecided OR kind = 'off_topic') AND {s_any("fh", BRAND)} AND fq = '' THEN 4 WHEN tracker AND NOT trade THEN 8 WHEN kind = 'target' AND (coded OR (passed AND evidence <> 'name_only')) THEN 10 WHEN kind = 'target' THEN 11 WHEN trade AND (coded OR passed) THEN 12
  WHEN kind = 'other' AND known AND oper AND business THEN 13 WHEN trade AND {s_any("fh", BRAND)} THEN 14 WHEN kind = 'other' AND business THEN 15 WHEN kind = 'other' THEN 16 WHEN kind = 'topic_site' AND oper AND business THEN 17 WHEN kind = 'topic_site' AND business THEN 18
  WHEN undecided AND coded AND NOT {s_any("fh", BRAND)} THEN 20 WHEN undecided AND (passed OR route) THEN 21 ELSE 0 END AS rule FROM b)
"""


@query(f"""
WITH {S_VERDICTS} SELECT page_id, CASE rule {" ".join(f"WHEN {k} THEN '{v}'" for k, v in _SIDES.items())} ELSE 'none' END AS side,
  CASE WHEN rule IN (8, 10) THEN 'Ther' WHEN rule = 12 THEN CASE WHEN known THEN brand ELSE coalesce(nullif(h, ''), '?') END WHEN rule = 13 THEN brand WHEN rule = 17 THEN by_host WHEN rule = 15 THEN fh WHEN rule = 18 THEN h WHEN rule = 20 THEN fh ELSE '' END AS name FROM verdicts
""")
def page_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC14, JN12, HP1, HP2: what each captured page says of the site that leads to it: whom it advertises. Hosts of mobile
    pages are the known trackers."""
    dests = destinations(spark, sf_dir).withColumns({"ordinal": F.col("page_id"), "url": F.col("final_url"), "via": F.lit(None).cast("string")})
    trackers = read(spark, sf_dir, "pages").select(U.url_host(F.col("url")).alias("host")).filter(F.col("host").startswith("m.")).distinct()
    return evidence.destination_verdicts(dests, trackers, CONFIG).select("page_id", "side", "name")
