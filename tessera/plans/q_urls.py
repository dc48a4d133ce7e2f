"""URL and host functions over URLs that a grid puts together; their SQL says each rule again."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import AFFILIATE_NAMES, BRAND_PARAM_NAMES, CODE_NAMES, DEFAULT, TRACKER_NAMES
from tessera.functions import url as U
from tessera.operators import decisions
from tessera.plans.inputs import GRID, flag, grid, pick, read, sql_flag, sql_pick
from tessera.plans.registry import query

CONFIG = dataclasses.replace(DEFAULT, ref_hosts=("known.example",))
SCHEMES = ("https://", "http://", "HTTPS://", "ftp://", "")
HOSTS = ("www.Example.com", "user:pw@acme-play.example", "x7q.example", "bcdfg.example:8080", "video.example", "known.example", "localhost9", "short.example", "go.acme.com", "banana.example", "site.example", "a.site.example")
PATHS = ("/", "", "/Ab3d", "/News", "/ab3d/0/x", "/Ab3d/0/x", "/FxSqQyw", "/go/play", "/2021/05/story", "/how-to-win-big-now", "/style.css", "/redirect/x/", "/Banana", "/out/")
QUERIES = ("", "?pid=7", "?x=1", "?campaign=z", "?url=https://o.example/", "?promo=A%20B&pid=9%2B1", "?code=k")
FRAGMENTS = ("", "#top")
SITES = ("site.example", "www.example.com", "other.example")

#: The same URLs in SQL, with parts.
SPLIT = "'^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$'"


def s_part(u: str, k: int) -> str:
    return f"regexp_extract({u}, {SPLIT}, {k})"


def s_hostname(u: str) -> str:
    return f"lower(regexp_replace(regexp_replace({s_part(u, 2)}, '^.*@', ''), ':[0-9]*$', ''))"


def s_host(u: str) -> str:
    return f"regexp_replace({s_hostname(u)}, '^www\\.', '')"


def s_has(q: str, names: tuple[str, ...]) -> str:
    return f"regexp_matches({q}, '(?i)(^|&)({'|'.join(names)})=')"


def s_same(a: str, b: str) -> str:
    return f"({a} = {b} OR ends_with({a}, '.' || {b}) OR ends_with({b}, '.' || {a}))"


def s_random(h: str) -> str:
    label = f"(CASE WHEN contains({h}, '.') THEN split_part({h}, '.', -2) ELSE {h} END)"
    letters, vowels = f"len(regexp_extract_all({label}, '\\p{{L}}'))", f"len(regexp_extract_all({label}, '[aeiouy]'))"
    return f"(contains({h}, 'acme') OR regexp_matches({h}, '(acm|acme)\\.[a-z]+$') OR regexp_matches({label}, '[0-9]') OR ({letters} > 0 AND {vowels} < 0.3 * {letters}))"


def s_under(h: str, hosts: str) -> str:
    return f"regexp_matches({h}, '(^|\\.)({hosts})$')"


PLATFORM, SHORT = "video\\.example|social\\.example|store\\.example", "short\\.example|link\\.example"


def s_ref(u: str, h: str, p: str, q: str, site: str) -> str:
    """The kind of a referral link: the guards in order."""
    four = f"substr({p}, 2, 4)"
    return f"""CASE WHEN NOT regexp_matches({u}, '(?i)^https?://') OR {h} = '' OR {s_same(f"regexp_replace({h}, '^www\\.', '')", f"regexp_replace({site}, '^www\\.', '')")} THEN NULL
      WHEN {h} = 'known.example' THEN 'known_ref_host'
      WHEN {s_under(h, PLATFORM)} OR {s_under(h, SHORT)} OR NOT {s_random(h)} THEN NULL
      WHEN regexp_matches({p}, '^/[A-Za-z0-9]{{4}}/?$') AND regexp_matches({four}, '[A-Z]') AND (NOT regexp_matches({four}, '^[A-Z][a-z]{{3}}$') OR regexp_matches({h}, '(acm|acme)\\.[a-z]+$')) THEN 'ref'
      WHEN regexp_matches({p}, '^/[A-Za-z0-9]{{4}}/') AND regexp_matches({four}, '[A-Z]') AND regexp_matches({h}, '(acm|acme)\\.[a-z]+$') THEN 'ref'
      WHEN contains({h}, 'acme') AND {s_has(q, BRAND_PARAM_NAMES)} THEN 'brand_host' END"""


URLS = f"""
g AS ({GRID}), u AS (SELECT k, h1, {sql_pick(0, 0, SCHEMES)} || {sql_pick(0, 4, HOSTS)} || {sql_pick(0, 9, PATHS)} || {sql_pick(0, 15, QUERIES)} || {sql_pick(0, 20, FRAGMENTS)} AS url, {sql_pick(1, 3, SITES)} AS site FROM g),
p AS (SELECT *, {s_hostname("url")} AS h, {s_host("url")} AS b, {s_part("url", 2)} AS n, {s_part("url", 3)} AS p, {s_part("url", 4)} AS q, regexp_replace(url, '#.*$', '') AS bare FROM u)
"""


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, url and site: URLs of all kinds, put together from parts."""
    url = F.concat(pick(0, 0, SCHEMES), pick(0, 4, HOSTS), pick(0, 9, PATHS), pick(0, 15, QUERIES), pick(0, 20, FRAGMENTS))
    return grid(spark, sf_dir).select("k", "h1", url.alias("url"), pick(1, 3, SITES).alias("site"))


@query(f"""
WITH {URLS} SELECT k, b AS host, regexp_replace(lower(n), '^www\\.', '') AS loc, regexp_replace(regexp_replace(lower(site || '.'), '\\.+$', ''), '^www\\.', '') AS base,
  b <> '' AND site <> '' AND {s_same("b", "site")} AS same, {s_same("b", "site")} AS same_or_empty, h || coalesce(nullif(regexp_replace(p, '/+$', ''), ''), '/') AS ref_key,
  CASE WHEN contains(url, 'pid=9%2B1') THEN '9+1' ELSE regexp_extract(q, '(?:^|&)pid=([^&]*)', 1) END AS pid,
  {s_has("q", AFFILIATE_NAMES)} AS affiliate, {s_has("q", TRACKER_NAMES)} AS tracker,
  CASE split_part(h, '.', -1) WHEN 'de' THEN 'DE' WHEN 'fr' THEN 'FR' ELSE NULL END AS country,
  CASE WHEN b = 'redirect.example' THEN 'https://o.example/' ELSE url END AS unwrapped
FROM p
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR1 to UR5, UR7, UR8, UR15, UR20, HP3."""
    u, s = F.col("url"), F.col("site")
    host = U.url_host(u)
    return urls(spark, sf_dir).select(
        "k",
        host.alias("host"),
        U.loc_host(u).alias("loc"),
        U.base_host(F.concat(s, F.lit("."))).alias("base"),
        U.same_site(host, s).alias("same"),
        U.same_site(host, s, True).alias("same_or_empty"),
        U.ref_key(u).alias("ref_key"),
        U.partner_id(u).alias("pid"),
        U.has_affiliate_params(u).alias("affiliate"),
        U.has_tracker_params(u).alias("tracker"),
        U.tld_country(U.hostname(u)).alias("country"),
        U.unwrap(u).alias("unwrapped"),
    )


TOKEN = "regexp_extract(p, '^/([A-Za-z0-9]{5,12})/?$', 1)"
SHAPED = f"(regexp_matches({TOKEN}, '[a-z]') AND regexp_matches({TOKEN}, '[A-Z]') AND NOT regexp_matches({TOKEN}, '^[A-Z][a-z]+$'))"
LOOKS = f"(({s_random('h')} AND NOT (p IN ('', '/') AND q = '')) OR (regexp_matches(p, '^/[A-Za-z0-9_-]{{4,12}}/?$') AND regexp_matches(p, '[A-Z0-9]')) OR {s_has('q', AFFILIATE_NAMES)} OR {s_has('q', TRACKER_NAMES)})"
INSIDE = s_same("regexp_replace(h, '^www\\.', '')", "regexp_replace(site, '^www\\.', '')")


@query(f"""
WITH {URLS}, r AS (SELECT *, {s_ref("url", "h", "p", "q", "site")} AS kind, {SHAPED} AS shaped FROM p)
SELECT k, kind, shaped, {s_random("h")} AS random, {LOOKS} AS looks, CASE WHEN {INSIDE} THEN '' WHEN shaped OR kind IS NOT NULL THEN h || coalesce(nullif(regexp_replace(p, '/+$', ''), ''), '/') ELSE bare END AS cache_key,
  CASE WHEN {INSIDE} THEN bare WHEN shaped OR kind IS NOT NULL THEN h || coalesce(nullif(regexp_replace(p, '/+$', ''), ''), '/') ELSE bare END AS dest_key,
  coalesce(kind IN ('known_ref_host', 'brand_host') OR (kind = 'ref' AND (regexp_matches(b, '(acm|acme)\\.[a-z]+$') OR b = 'known.example')), false) AS brand_ref,
  b <> '' AND (regexp_matches(b, '(acm|acme)\\.[a-z]+$') OR b = 'known.example') AS ref_host,
  regexp_matches(p, '(?i)^/(go|goto|out|visit|click|redirect|redir|recommends|refer|link|reg|register|play|bonus|promo|step-un|get|join|signup)(/[^/]{{0,24}})?/?$') AS gate,
  contains(p, '/2021/05/') AS dated, regexp_matches(p, '(?i)/[a-z0-9%]+(-[a-z0-9%]+){{3,}}/?$') AS slug, ends_with(p, '.css') AS static, regexp_matches(p, '(?i)(^|/)({'|'.join(U.REDIRECT_WORDS)})([/?#._-]|$)') AS redirect, contains(q, 'url=') AS url_param, p = '/out/' AS bare_gate,
  {s_under("h", PLATFORM)} AS platform, {s_under("h", SHORT)} AS not_ref
FROM r
""")
def url_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR6, UR10 to UR14, UR17, UR18."""
    u, s = F.col("url"), F.col("site")
    shapes, lists = U.path_shapes(u), CONFIG.host_lists()
    return urls(spark, sf_dir).select(
        "k",
        U.classify_ref(u, s, CONFIG).alias("kind"),
        U.tracker_shaped(u).alias("shaped"),
        U.random_host(U.hostname(u), CONFIG).alias("random"),
        U.looks_tracker(u, CONFIG).alias("looks"),
        U.cache_key(u, s, CONFIG).alias("cache_key"),
        U.dest_key(u, s, CONFIG).alias("dest_key"),
        U.brand_ref(u, s, CONFIG).alias("brand_ref"),
        U.ref_host(U.url_host(u), CONFIG).alias("ref_host"),
        *[shapes[n].alias(n) for n in ("gate", "dated", "slug", "static", "redirect", "url_param", "bare_gate")],
        U.in_hosts(U.hostname(u), [lists["platform"]]).alias("platform"),
        U.in_hosts(U.hostname(u), [lists["not_ref"]]).alias("not_ref"),
    )


HOPS = ("https://one.example/a", "https://two.example/b?clid=4", "https://www.three.example/c")


@query(f"""
WITH {URLS}, c AS (SELECT k, url, 'https://end.example/' || CASE WHEN {sql_flag(1, 8)} THEN '?invite=1' ELSE '' END AS final, CASE WHEN {sql_flag(1, 9)} THEN ['{HOPS[0]}'] WHEN {sql_flag(1, 10)} THEN ['{HOPS[0]}', '{HOPS[1]}'] WHEN {sql_flag(1, 11)} THEN ['{HOPS[0]}', '{HOPS[2]}'] ELSE [] END AS hops, q, h, b FROM (SELECT p.* FROM p)),
d AS (SELECT *, {s_has("q", AFFILIATE_NAMES)} OR {s_has("q", TRACKER_NAMES)} AS marked, {s_has("q", CODE_NAMES)} AS code, list_contains(hops, '{HOPS[1]}') AS hop_marked, coalesce(hops[1], url) AS first FROM c)
SELECT k, marked OR code OR hop_marked OR contains(final, 'invite=') AS coded, len(hops) > 0 AND (b <> 'one.example' OR len(hops) > 1) AS via, len(hops) > 0 AS changed,
  marked OR hop_marked OR (CASE WHEN len(hops) > 0 THEN false ELSE q <> '' AND b <> '' AND b <> 'end.example' END) OR len(list_distinct(list_filter([b, 'end.example', CASE WHEN len(hops) > 0 THEN 'one.example' END, CASE WHEN len(hops) > 1 AND hop_marked THEN 'two.example' END, CASE WHEN len(hops) > 1 AND NOT hop_marked THEN 'three.example' END], lambda x: x IS NOT NULL AND x <> ''))) > 2 AS tracked,
  len(hops) > 1 OR {s_has("q", AFFILIATE_NAMES)} AS ad_route, replace(url, '/', '\\/') || ' ' AS raw, url AS clean
FROM d
""")
def url_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR19, HP1, HP2, HP9, DC2, DC5."""
    u = F.col("url")
    none = F.array().cast("array<string>")
    hops = F.when(flag(1, 9), F.array(F.lit(HOPS[0]))).when(flag(1, 10), F.array(F.lit(HOPS[0]), F.lit(HOPS[1]))).when(flag(1, 11), F.array(F.lit(HOPS[0]), F.lit(HOPS[2]))).otherwise(none)
    df = urls(spark, sf_dir).withColumn("hops", hops).withColumn("final", F.concat(F.lit("https://end.example/"), F.when(flag(1, 8), "?invite=1").otherwise("")))
    raw = F.concat(F.replace(u, F.lit("/"), F.lit("\\/")), F.lit(" "))
    return df.select(
        "k",
        U.is_coded(F.concat(F.array(u, F.col("final")), F.col("hops"))).alias("coded"),
        U.via_tracker(u, F.col("final"), F.col("hops")).alias("via"),
        U.hosts_changed(F.when(F.size("hops") > 0, F.lit("https://zero.example/")).otherwise(u), F.col("hops")).alias("changed"),
        U.tracked(u, F.col("final"), F.col("hops")).alias("tracked"),
        decisions.ad_route(u, F.col("final"), F.size("hops") > 1).alias("ad_route"),
        raw.alias("raw"),
        U.clean_link(raw).alias("clean"),
    )


#: References and what they are against https://h.example/a/b.
JOINS = (("x", "https://h.example/a/x"), ("/y", "https://h.example/y"), ("../z", "https://h.example/z"), ("//o.example/q", "https://o.example/q"), ("https://t.example/", "https://t.example/"), ("?a=1", "https://h.example/a/b?a=1"), ("#f", "https://h.example/a/b#f"), (None, None))
NAMES = (("bücher.example", "xn--bcher-kva.example", "ok"), ("WWW.Example.COM.", "example.com", "ok"), ("пример.рф", "xn--e1afmkfd.xn--p1ai", "ok"), ("", None, "empty"), ("a..b", None, "error"))


@query(f"""
WITH g AS ({GRID}) SELECT k, {sql_pick(0, 3, [b for _, b in JOINS])} AS joined, {sql_pick(1, 3, [b for _, b, _ in NAMES])} AS ascii, {sql_pick(1, 3, [c for _, _, c in NAMES])} AS status FROM g
""")
def url_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR9, UR16: references resolved and names in ASCII, against values known beforehand."""
    df = grid(spark, sf_dir).select("k", pick(0, 3, [a for a, _ in JOINS]).alias("href"), U.idna_host(pick(1, 3, [a for a, _, _ in NAMES])).alias("i"))
    return df.select("k", U.url_join(F.lit("https://h.example/a/b"), F.col("href")).alias("joined"), F.col("i.host").alias("ascii"), F.col("i.status").alias("status"))


@query(f"""
WITH hosts AS (SELECT DISTINCT {s_host("url")} AS host FROM pages), named AS (SELECT host FROM hosts UNION SELECT DISTINCT regexp_replace(host, '^[^.]*\\.', '') FROM hosts WHERE contains(host, '.'))
SELECT a.host AS host_a, b.host AS host_b FROM named a JOIN named b ON a.host <> b.host AND ends_with(a.host, '.' || b.host) WHERE b.host <> ''
""")
def same_site_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR4: hosts of one site (and the hosts right above them). Each host meets the hosts that its own dotted endings name, so
    a pair is an equal key, and no key holds more pairs than there are."""
    hosts = read(spark, sf_dir, "pages").select(U.url_host(F.col("url")).alias("host")).distinct()
    named = hosts.union(hosts.filter(F.col("host").contains(".")).select(F.regexp_replace("host", r"^[^.]*\.", ""))).distinct()
    labels = F.split("host", r"\.")
    endings = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    above = named.filter(F.size(labels) > 1).select("host", F.explode(endings).alias("host_b"))
    met = above.join(named.withColumnRenamed("host", "host_b"), "host_b")
    return met.filter(U.same_site(F.col("host"), F.col("host_b"))).select(F.col("host").alias("host_a"), "host_b")
