"""Queries of large dictionaries and host lists, derived from the tables they are looked up in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dictionary as D
from tessera.functions import url as U
from tessera.operators import hosts
from tessera.plans.inputs import read
from tessera.plans.registry import query

#: The thousand most frequent words of four letters or more, by number and word.
S_WORDS = r"""tokens AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id) - 1 AS place FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents)),
dict AS (SELECT w, count(*) AS n FROM tokens WHERE length(w) >= 4 GROUP BY w ORDER BY n DESC, w LIMIT 1000)"""


def frequent_words(spark: SparkSession, sf_dir: str, n: int = 1000) -> DataFrame:
    """The dictionary: its size is the number of entries asked for."""
    words = read(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(D.WORD), 0)).alias("w"))
    return words.filter(F.length("w") >= 4).groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(n).select("w")


@query(f"""
WITH {S_WORDS} SELECT doc_id, count(dict.w) AS n_hits, count(DISTINCT dict.w) AS n_names, coalesce(min(dict.w), '') AS first_name
FROM (SELECT doc_id FROM documents) LEFT JOIN tokens USING (doc_id) LEFT JOIN dict ON tokens.w = dict.w GROUP BY doc_id
""")
def dictionary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX5, TX6, JN11: all hits of a thousand entries in one pass over each text, by one automaton; the first name in the
    order of entries."""
    entries = D.entries_of(frequent_words(spark, sf_dir), "w", "w")
    found = read(spark, sf_dir, "documents").select("doc_id", D.hits(F.col("text"), entries).alias("found"))
    return found.select("doc_id", F.size("found").cast("long").alias("n_hits"), F.size(D.names_found(F.col("found"))).cast("long").alias("n_names"), D.first_entry(F.col("found")).alias("first_name"))


@query(f"WITH {S_WORDS} SELECT doc_id, w AS name, count(*) AS n FROM tokens JOIN dict USING (w) GROUP BY doc_id, w")
def dictionary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX4, JN11: mentions of every entry in every text."""
    entries = D.entries_of(frequent_words(spark, sf_dir), "w", "w")
    docs = read(spark, sf_dir, "documents")
    return D.count_by_name(docs, ["doc_id"], D.hits(F.col("text"), entries)).select("doc_id", "name", "n")


S_BENCH = r"bench AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')[1:3] AS p FROM benchmark)"


@query(rf"""
WITH {S_BENCH}, t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS a, unnest(range(len(w))) AS place, w FROM t)
SELECT doc_id, item_id AS name, count(*) AS n, min(place)::BIGINT AS first FROM e JOIN bench ON a = p[1] WHERE w[place + 1 : place + len(p)] = p GROUP BY doc_id, item_id
""")
def phrases_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN11: the first three words of every benchmark passage in every text, by a join on their first words."""
    three = F.array_join(F.slice(F.regexp_extract_all(F.lower("text"), F.lit(D.WORD), 0), 1, 3), " ")
    table = read(spark, sf_dir, "benchmark").select("item_id", three.alias("phrase"))
    met = D.phrases_by_join(read(spark, sf_dir, "documents"), ["doc_id"], "text", table, "item_id", "phrase")
    return met.groupBy("doc_id", "name").agg(F.count("*").alias("n"), F.min("place").cast("long").alias("first"))


S_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '^www\.', '')"
#: The list: domains of every seventh page, and whole hosts of every fifth one.
S_LIST = f"""hosted AS (SELECT page_id, url, {S_HOST} AS host FROM pages),
listed AS (SELECT suffix, min(kind) AS kind FROM (SELECT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS suffix, 'domain' AS kind FROM hosted WHERE page_id % 7 = 0 AND host <> ''
  UNION ALL SELECT host, 'host' FROM hosted WHERE page_id % 5 = 0 AND host <> '') GROUP BY suffix)"""


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "pages").select("page_id", U.url_host(F.col("url")).alias("host")).filter("host <> ''")
    last = F.split("host", r"\.")
    domains = own.filter("page_id % 7 = 0").select(F.concat(F.lit("*."), F.array_join(F.slice(last, -F.least(F.lit(3), F.size(last)), F.lit(3)), ".")).alias("name"), F.lit("domain").alias("kind"))
    return hosts.suffix_index(domains.union(own.filter("page_id % 5 = 0").select(F.upper("host"), F.lit("host"))), "name")


@query(f"""
WITH {S_LIST}, s AS (SELECT page_id, unnest([array_to_string(list_slice(string_split(host, '.'), k, -1), '.') FOR k IN range(1, len(string_split(host, '.')) + 1)]) AS suffix FROM hosted)
SELECT page_id, max(suffix) FILTER (WHERE r = 1) AS matched, max(kind) FILTER (WHERE r = 1) AS kind
FROM (SELECT h.page_id, l.suffix, l.kind, row_number() OVER (PARTITION BY h.page_id ORDER BY length(l.suffix) DESC) AS r FROM hosted h LEFT JOIN s USING (page_id) LEFT JOIN listed l USING (suffix)
  ) GROUP BY page_id
""")
def host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UR18: the longest listed name above each page's host, by an equi-join on suffixes."""
    own = read(spark, sf_dir, "pages").select("page_id", U.url_host(F.col("url")).alias("host"))
    return hosts.longest_match(own, "host", _listed(spark, sf_dir)).select("page_id", "matched", "kind")


@query(f"""
WITH {S_LIST} SELECT page_id, host FROM hosted h WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE h.host = l.suffix OR ends_with(h.host, '.' || l.suffix))
""")
def hosts_not_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3, FLT10: pages whose host lies under no listed name."""
    own = read(spark, sf_dir, "pages").select("page_id", U.url_host(F.col("url")).alias("host"))
    return hosts.not_under_list(own, "host", _listed(spark, sf_dir))
