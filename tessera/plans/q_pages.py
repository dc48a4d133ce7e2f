"""Queries over pages: hosts, links, features and head metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.config import AFFILIATE_NAMES, parameters
from tessera.functions import html, url
from tessera.plans.registry import query

#: The host of a URL in DuckDB SQL.
HOST = "regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(url, '^(?:([^:/?#]+):)?(?://([^/?#]*))?', 2), '^.*@', ''), ':[0-9]*$', '')), '^www\\.', '')"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@query(f"SELECT host, count(*) AS n_pages, count(DISTINCT url) AS n_urls FROM (SELECT url, {HOST} AS host FROM pages) GROUP BY host ORDER BY n_pages DESC, host")
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR1, UR2, AG1, TK2: pages per host, busiest first."""
    own = pages(spark, sf_dir).select("url", url.url_host(F.col("url")).alias("host"))
    return own.groupBy("host").agg(F.count("*").alias("n_pages"), F.count_distinct("url").alias("n_urls")).orderBy(F.desc("n_pages"), "host")


@query(f"""
SELECT page_id, regexp_extract(q, '(?:^|&)ref=([^&]*)', 1) AS ref_value, regexp_matches(q, '{parameters(AFFILIATE_NAMES)}') AS affiliate,
  regexp_matches(p, '(?i)^/({"|".join(url.GATE_WORDS)})(/[^/]{{0,24}})?/?$') AS gate, regexp_matches(p, '(?i)\\.({"|".join(url.STATIC_ENDINGS)})(\\?|$)') AS static
FROM (SELECT page_id, regexp_extract(url, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1) AS p, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages)
""")
def url_params_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR7, UR8, UR17."""
    u, shapes = F.col("url"), url.path_shapes(F.col("url"))
    return pages(spark, sf_dir).select("page_id", url.query_value(u, "ref").alias("ref_value"), url.has_affiliate_params(u).alias("affiliate"), shapes["gate"].alias("gate"), shapes["static"].alias("static"))


@query(f"SELECT page_id, lower(regexp_replace(regexp_replace(regexp_extract(url, '^(?:([^:/?#]+):)?(?://([^/?#]*))?', 2), '^.*@', ''), ':[0-9]*$', '')) || coalesce(nullif(regexp_replace(regexp_extract(url, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1), '/+$', ''), ''), '/') AS ref_key FROM pages")
def url_ref_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR5."""
    return pages(spark, sf_dir).select("page_id", url.ref_key(F.col("url")).alias("ref_key"))


@query(f"SELECT split_part(host, '.', -1) AS tld, count(*) AS n FROM (SELECT {HOST} AS host FROM pages) GROUP BY ALL")
def tld_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR20: pages per last label."""
    host = url.url_host(F.col("url"))
    return pages(spark, sf_dir).select(F.try_element_at(F.split(host, r"\."), F.lit(-1)).alias("tld")).groupBy("tld").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT {HOST} AS host, regexp_matches(split_part({HOST}, '.', -2), '[0-9]') OR (len(regexp_extract_all(split_part({HOST}, '.', -2), '[a-z]')) > 0 AND len(regexp_extract_all(split_part({HOST}, '.', -2), '[aeiouy]')) < 0.3 * len(regexp_extract_all(split_part({HOST}, '.', -2), '[a-z]'))) AS random FROM pages")
def random_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR12."""
    hosts = pages(spark, sf_dir).select(url.url_host(F.col("url")).alias("host")).distinct()
    return hosts.select("host", url.random_host(F.col("host")).alias("random"))


@query("""
SELECT page_id, unnest(generate_series(1, len(h)))::INT AS ordinal, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages)
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT3: the quoted links of a page in order."""
    found = F.regexp_extract_all(F.col("html"), F.lit('<a href="([^"]*)"'), F.lit(1))
    return pages(spark, sf_dir).select("page_id", F.posexplode(found).alias("i", "href")).select("page_id", (F.col("i") + 1).alias("ordinal"), "href")


@query("""
SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, regexp_extract(html, '(?i)<html[^>]*\\blang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '(?i)<h2[\\s>]'))::INT AS n_h2, regexp_matches(html, '(?i)<h1[\\s>]') AS has_h1 FROM pages
""")
def head_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HT14."""
    return pages(spark, sf_dir).select("page_id", *html.head_fields(F.col("html"))).select("page_id", "title", "lang", "n_h2", "has_h1")
