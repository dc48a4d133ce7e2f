"""URL, text and keyword rules over the addresses, texts and labels of the given tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import AFFILIATE_NAMES, BRAND_PARAM_NAMES, DEFAULT, TRACKER_NAMES, parameters
from tessera.functions import text as T
from tessera.functions import url as U
from tessera.operators import corpus, keyed
from tessera.plans.inputs import read
from tessera.plans.registry import query

MARK = "ther"
CONFIG = dataclasses.replace(DEFAULT, ref_marker=MARK, ref_suffix=f"{MARK}\\.example\\.[a-z]+$")

S_URL = rf"""u AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS netloc, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages),
h AS (SELECT *, regexp_replace(netloc, ':[0-9]*$', '') AS hostname, regexp_replace(regexp_replace(netloc, ':[0-9]*$', ''), '^www\.', '') AS host FROM u),
s AS (SELECT *, CASE WHEN page_id % 2 = 0 THEN host ELSE 'x' || host END AS site, split_part(hostname, '.', -2) AS label, hostname || coalesce(nullif(regexp_replace(p, '/+$', ''), ''), '/') AS ref_key, regexp_extract(p, '^/([A-Za-z0-9]{{5,12}})/?$', 1) AS token FROM h),
f AS (SELECT *, contains(hostname, '{MARK}') OR regexp_matches(hostname, '{MARK}\.example\.[a-z]+$') OR regexp_matches(label, '[0-9]') OR (len(regexp_extract_all(label, '\p{{L}}')) > 0 AND len(regexp_extract_all(label, '[aeiouy]')) < 0.3 * len(regexp_extract_all(label, '\p{{L}}'))) AS random,
  regexp_matches(token, '[a-z]') AND regexp_matches(token, '[A-Z]') AND NOT regexp_matches(token, '^[A-Z][a-z]+$') AS shaped FROM s),
c AS (SELECT *, CASE WHEN host = site OR ends_with(host, '.' || site) OR ends_with(site, '.' || host) THEN NULL WHEN contains(hostname, '{MARK}') AND regexp_matches(q, '{parameters(BRAND_PARAM_NAMES)}') THEN 'brand_host' END AS kind FROM f)"""


@query(rf"""
WITH {S_URL} SELECT page_id, regexp_replace(netloc, '^www\.', '') AS loc_host, CASE WHEN host = site OR ends_with(host, '.' || site) OR ends_with(site, '.' || host) THEN '' WHEN shaped OR kind IS NOT NULL THEN ref_key ELSE regexp_replace(url, '#.*$', '') END AS cache_key, coalesce(kind, '') AS kind,
  kind = 'brand_host' IS TRUE AS brand_ref, shaped, (random AND NOT (p IN ('', '/') AND q = '')) OR (regexp_matches(p, '^/[A-Za-z0-9_-]{{4,12}}/?$') AND regexp_matches(p, '[A-Z0-9]')) OR regexp_matches(q, '{parameters(AFFILIATE_NAMES)}') OR regexp_matches(q, '{parameters(TRACKER_NAMES)}') AS tracker,
  host AS ascii, url AS unwrapped FROM c
""")
def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR3, UR6, UR10 to UR16, HP3, HP9: what the addresses of pages are to a site, their own or another: keys, kinds and
    shapes; hosts in ASCII form; wrappers opened."""
    own, u = read(spark, sf_dir, "pages").select("page_id", "url"), F.col("url")
    host = U.base_host(U.hostname(u))
    df = own.withColumn("site", F.when(F.col("page_id") % 2 == 0, host).otherwise(F.concat(F.lit("x"), host)))
    site = F.col("site")
    wrapped = F.concat(F.lit("https://redirect.example/?url="), F.url_encode(U.clean_link(F.concat(F.lit(" "), F.replace(u, F.lit("/"), F.lit("\\/"))))))
    return df.select(
        "page_id", U.loc_host(u).alias("loc_host"), U.cache_key(u, site, CONFIG).alias("cache_key"), F.coalesce(U.classify_ref(u, site, CONFIG), F.lit("")).alias("kind"), U.brand_ref(u, site, CONFIG).alias("brand_ref"),
        U.tracker_shaped(u).alias("shaped"), U.looks_tracker(u, CONFIG).alias("tracker"), U.idna_host(F.upper(U.hostname(u)))["host"].alias("ascii"), U.unwrap(wrapped).alias("unwrapped"),
    )


@query("""
WITH l AS (SELECT page_id, url, regexp_replace(unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)), '&amp;', '&', 'g') AS href FROM pages),
j AS (SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*', 0) || href AS link FROM l) SELECT page_id, link, count(*) AS n FROM j GROUP BY ALL
""")
def page_joined_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR9: the references of pages resolved against their addresses, counted."""
    found = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    links = read(spark, sf_dir, "pages").select("page_id", "url", found.alias("href")).withColumn("href", F.replace("href", F.lit("&amp;"), F.lit("&")))
    return links.select("page_id", U.url_join(F.col("url"), F.col("href")).alias("link")).groupBy("page_id", "link").agg(F.count("*").alias("n"))


S_HOPS = """w AS (SELECT page_id, url, lead(url) OVER (PARTITION BY page_id // 5 ORDER BY page_id) AS a, lead(url, 2) OVER (PARTITION BY page_id // 5 ORDER BY page_id) AS b FROM pages),
x AS (SELECT page_id, url, a, b, [regexp_replace(lower(regexp_extract(v, '^[a-zA-Z]+://([^/?#:]*)', 1)), '^www\\.', '') FOR v IN [url, a, b]] AS h, list_transform([url, a, b], lambda v: regexp_extract(v, '\\?([^#]*)', 1)) AS q FROM w WHERE b IS NOT NULL)"""


@query(f"""
WITH {S_HOPS} SELECT page_id, h[1] <> h[2] OR h[1] <> h[3] AS changed, len(list_filter(q, lambda v: regexp_matches(v, '{parameters(AFFILIATE_NAMES)}') OR regexp_matches(v, '{parameters(TRACKER_NAMES)}'))) > 0 AS coded, h[2] <> h[1] AND h[2] <> h[3] AS via,
  len(list_filter(q, lambda v: regexp_matches(v, '{parameters(AFFILIATE_NAMES)}') OR regexp_matches(v, '{parameters(TRACKER_NAMES)}'))) > 0 OR (q[1] <> '' AND h[1] <> h[3]) OR len(list_distinct(h)) > 2 AS tracked FROM x
""")
def page_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR19, HP1, HP2, DC5: chains of three pages: whether the host changes, a parameter marks a partner, a hop stands apart
    from both ends, and the chain is tracked."""
    from pyspark.sql import Window

    row = Window.partitionBy(F.floor(F.col("page_id") / 5)).orderBy("page_id")
    own = read(spark, sf_dir, "pages").select("page_id", "url", F.lead("url").over(row).alias("a"), F.lead("url", 2).over(row).alias("b")).filter("b IS NOT NULL")
    hops = F.array("a", "b")
    return own.select("page_id", U.hosts_changed(F.col("url"), hops).alias("changed"), U.is_coded(F.array("url", "a", "b")).alias("coded"), U.via_tracker(F.col("url"), F.col("b"), F.array("a")).alias("via"), U.tracked(F.col("url"), F.col("b"), F.array("url", "a")).alias("tracked"))


COUNTRIES = (("EN", "the"), ("DE", "der"), ("FR", "les"), ("ES", "que"))
WORDS = (("en", ("the", "and")), ("fr", ("les", "des")))


@query(f"""
WITH n AS (SELECT doc_id, upper(lang) AS own, list_sort(list_filter([{", ".join(f"CASE WHEN regexp_matches(text, '(?i) {w} ') THEN '{c}' END" for c, w in COUNTRIES)}], lambda x: x IS NOT NULL)) AS named FROM documents),
f AS (SELECT *, array_to_string(list_filter(named, lambda x: x <> own), '+') AS away, list_contains(named, own) AS home FROM n)
SELECT doc_id, CASE WHEN len(named) = 0 THEN 'none' WHEN home AND away = '' THEN 'own' WHEN home THEN 'own+' || away ELSE away END AS geo FROM f
""")
def document_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX9: whose words a document holds: its own language's, others', both or none."""
    return read(spark, sf_dir, "documents").select("doc_id", T.geo_code(F.coalesce("text", F.lit("")), F.upper(F.coalesce("lang", F.lit(""))), [(c, f"(?i) {w} ") for c, w in COUNTRIES]).alias("geo"))


@query(r"""
WITH w AS (SELECT conv_id, turn, role, lower(coalesce(text, '')) AS t, list_filter(regexp_split_to_array(trim(lower(coalesce(text, ''))), '\s+'), lambda x: x <> '' AND x NOT IN ('a', 'de')) AS l FROM conversations)
SELECT conv_id, turn, role, CASE WHEN len(l) = 0 THEN 'none' WHEN regexp_matches(array_to_string(l, ' '), '[äöüß]') THEN 'de' WHEN regexp_matches(array_to_string(l, ' '), '[ñ¿]') THEN 'es' WHEN list_has_any(l, ['the', 'and']) THEN 'en' WHEN list_has_any(l, ['les', 'des']) THEN 'fr' WHEN role = 'user' THEN 'asked' ELSE 'other' END AS language FROM w
""")
def turn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX8: the language of turns by scripts, then words, then who speaks."""
    found = T.query_language(F.coalesce("text", F.lit("")), F.col("role"), noise=("a", "de"), scripts=(("de", "[äöüß]"), ("es", "[ñ¿]")), words=WORDS, ties={"user": "asked"})
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", found.alias("language"))


@query("SELECT doc_id, len(regexp_extract_all(translate(strip_accents(coalesce(text, '')), '%s', '%s'), '(?i)ther'))::INT AS mentions FROM documents" % ("".join(T.LOOKALIKES), "".join(T.LOOKALIKES.values())))
def folded_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX1, TX2: mentions of a name in documents whose accents and look-alike letters are folded."""
    return read(spark, sf_dir, "documents").select("doc_id", T.disguised_count(F.coalesce("text", F.lit("")), "(?i)ther").alias("mentions"))


S_KEYS = r"k AS (SELECT doc_id, lang AS cc, trim(array_to_string(list_slice(regexp_split_to_array(trim(coalesce(text, '')), '\s+'), 1, 2), ' ')) AS keyword, n_chars AS volume, source FROM documents)"


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = F.trim(F.array_join(F.slice(F.split(F.regexp_replace(F.trim(F.coalesce("text", F.lit(""))), r"^\s+|\s+$", ""), r"\s+"), 1, 2), " "))
    return read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("cc"), two.alias("keyword"), F.col("n_chars").alias("volume"), "source")


@query(f"WITH {S_KEYS} SELECT cc, count(*) AS n, count_if(regexp_matches(keyword, '[à-öø-ÿß]')) AS n_script, count_if(volume >= 500) AS n_volume FROM k GROUP BY cc")
def document_keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG5, FLT12: the first words of documents as keywords: how many, with letters of a script, and from a volume on."""
    return corpus.corpus_counts(_keywords(spark, sf_dir), ["cc"], "[à-öø-ÿß]", 500)


@query(f"WITH {S_KEYS} SELECT cc, doc_id, keyword FROM (SELECT *, row_number() OVER (PARTITION BY cc, lower(trim(keyword)), source ORDER BY doc_id) AS r FROM k) WHERE r = 1")
def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8, ST9: requests once per language, first words in normal form, and source."""
    rows = _keywords(spark, sf_dir).select("cc", F.col("keyword").alias("query"), F.col("source").alias("device"), F.col("doc_id").alias("ordinal"))
    return corpus.request_keys(rows).select("cc", F.col("ordinal").alias("doc_id"), F.col("query").alias("keyword"))


@query("""
WITH l AS (SELECT *, event_id % 3 AS s, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY ts DESC, event_id DESC) AS r FROM events), a AS (SELECT * FROM l WHERE r = 1),
b AS (SELECT coalesce(y.user_id, x.user_id) AS user_id, CASE WHEN y.user_id IS NULL THEN x.event_id ELSE y.event_id END AS event_id, CASE WHEN y.user_id IS NULL THEN x.ts ELSE y.ts END AS ts FROM (SELECT * FROM a WHERE s = 0) x FULL JOIN (SELECT * FROM a WHERE s = 1) y ON x.user_id = y.user_id)
SELECT coalesce(z.user_id, b.user_id) AS user_id, CASE WHEN z.user_id IS NOT NULL AND (b.user_id IS NULL OR z.ts >= b.ts) THEN z.event_id ELSE b.event_id END AS event_id FROM b FULL JOIN (SELECT * FROM a WHERE s = 2) z ON z.user_id = b.user_id
""")
def event_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN3: users' latest events out of three sources: the second replaces the first, the third only what is not newer."""
    own = read(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    latest = [keyed.latest(own.filter(F.col("event_id") % 3 == k), ["user_id"], ["ts", "event_id"]) for k in range(3)]
    return keyed.by_precedence(latest, "user_id", "ts", newer_only=(2,)).select("user_id", "event_id")


@query("""
WITH r AS (SELECT doc_id, 1 AS round, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS verdict FROM labels UNION ALL SELECT doc_id, 2, CASE doc_id % 3 WHEN 0 THEN 'unsure' WHEN 1 THEN 'toxic' ELSE CASE WHEN toxic = 1 THEN 'toxic' ELSE 'good' END END FROM labels WHERE doc_id % 2 = 0)
SELECT doc_id, verdict, round FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round DESC) AS n FROM r WHERE verdict <> 'unsure') WHERE n = 1
""")
def label_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN9: labels of two rounds: the later one wins unless it is unsure."""
    own = read(spark, sf_dir, "labels")
    first = own.select("doc_id", F.lit(1).alias("round"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("verdict"))
    again = F.when(F.col("doc_id") % 3 == 0, "unsure").when((F.col("doc_id") % 3 == 1) | (F.col("toxic") == 1), "toxic").otherwise("good")
    second = own.filter("doc_id % 2 = 0").select("doc_id", F.lit(2).alias("round"), again.alias("verdict"))
    return keyed.resolved_labels(first.union(second), "doc_id", "verdict", ["round"]).select("doc_id", "verdict", "round")
