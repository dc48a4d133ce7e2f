"""Corpus, host and queue operators applied to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import url as U
from tessera.operators import corpus, scan, tables
from tessera.plans.q_pages import HOST
from tessera.plans.registry import query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
SELECT l_returnflag AS cc, l_partkey::VARCHAR AS keyword, arg_min(l_quantity::BIGINT, (l_orderkey, l_linenumber)) AS volume, array_to_string(list_sort(list(DISTINCT l_linestatus)), ' ') AS seeds, sum(l_linenumber)::BIGINT AS units
FROM lineitem GROUP BY ALL
""")
def corpus_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG4: first volume by order, union of seeds, sum of units."""
    raw = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("cc"), F.col("l_partkey").cast("string").alias("keyword"), F.col("l_linestatus").alias("seed"), F.col("l_linenumber").cast("long").alias("units"), F.col("l_quantity").cast("long").alias("volume"), F.lit("").alias("topic"), F.struct("l_orderkey", "l_linenumber").alias("ordinal"))
    return corpus.build_corpus(raw).select("cc", "keyword", "volume", F.array_join("seeds", " ").alias("seeds"), "units")


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    place = F.pmod("page_id", F.lit(30)).cast("int") + 1
    return read(spark, sf_dir, "pages").select(F.element_at(F.split(U.path(u), "/"), 2).alias("cc"), F.floor(F.col("page_id") / 30).cast("string").alias("keyword"), place.alias("place"), "url", U.url_host(u).alias("host"), F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("double")).alias("rating"))


CITED = f"SELECT split_part(regexp_extract(url, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1), '/', 2) AS cc, (page_id // 30)::VARCHAR AS keyword, page_id % 30 + 1 AS place, url, {HOST} AS host, CASE WHEN page_id % 2 = 0 THEN page_id::DOUBLE END AS rating FROM pages"


@query(f"""
SELECT host, count(DISTINCT (cc, keyword)) AS queries, count(DISTINCT (cc, keyword)) FILTER (WHERE place <= 10) AS top_queries, array_to_string(list_sort(list(DISTINCT cc)), ' ') AS groups,
  arg_min(rating, (cc, keyword, place)) FILTER (WHERE rating IS NOT NULL) AS rating FROM ({CITED}) GROUP BY host
""")
def host_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG6."""
    return corpus.host_citations(_cited(spark, sf_dir), "cc").withColumn("groups", F.array_join("groups", " "))


@query(f"""
WITH c AS ({CITED}), p AS (SELECT host, url, count(DISTINCT (cc, keyword)) AS n FROM c GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, url) AS r FROM p)
SELECT b.host, a.answers, b.url AS page, b.n AS page_answers FROM b JOIN (SELECT host, count(DISTINCT (cc, keyword)) AS answers FROM c GROUP BY host) a USING (host) WHERE r = 1
""")
def cited_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG11."""
    return corpus.cited_pages(_cited(spark, sf_dir))


@query("""
SELECT cc, asked, shown, named, 100 * shown // greatest(1, asked) AS shown_percent, 100 * named // greatest(1, shown) AS named_percent FROM (
  SELECT l_returnflag AS cc, count(*) AS asked, count(*) FILTER (WHERE l_quantity > 10) AS shown, count(*) FILTER (WHERE l_quantity > 10 AND l_linenumber > 3) AS named FROM lineitem GROUP BY l_returnflag)
""")
def country_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8."""
    own = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("cc"), (F.col("l_quantity") > 10).alias("present"), F.greatest(F.col("l_linenumber") - 3, F.lit(0)).alias("mentions"))
    return corpus.country_summary(own)


@query("""
SELECT cc, brand, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY cc ORDER BY n DESC, brand) AS rank FROM (
  SELECT lang AS cc, w AS brand, count(*) AS n FROM (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(text, '(MIT|GNU|Apache|BY-NC)')) AS w FROM documents) GROUP BY ALL)) WHERE rank <= 12
""")
def brand_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG16, AG20: names once per document."""
    own = read(spark, sf_dir, "documents").select(F.col("lang").alias("cc"), F.regexp_extract_all(F.col("text"), F.lit("(MIT|GNU|Apache|BY-NC)"), F.lit(1)).alias("brands"))
    return corpus.brand_frequency(own).withColumn("rank", F.col("rank").cast("long"))


@query("""
SELECT c_custkey AS domain, c_mktsegment AS category, c_acctbal AS risk FROM customer WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT * FROM (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY' ORDER BY c_acctbal DESC, c_custkey LIMIT 500)
""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK8: the 500 riskiest and all of a forced class."""
    own = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("domain"), F.col("c_mktsegment").alias("category"), F.col("c_acctbal").alias("risk"))
    return scan.review_queue(own, ["MACHINERY"])


@query(f"SELECT page_id, url, host FROM (SELECT page_id, url, {HOST} AS host FROM pages) WHERE host NOT IN ('cheap-pills.example.com', 'spam-farm.example.org')")
def without_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3, SRC10: hosts that a registry of normal forms does not hold."""
    own = spark.sql("SELECT * FROM VALUES ('WWW.cheap-pills.example.com.'), ('spam-farm.example.org') AS (value)")
    sites = read(spark, sf_dir, "pages").select("page_id", "url", U.url_host(F.col("url")).alias("host"))
    return scan.without_own(sites, own, "host")


@query("""
SELECT a.o_custkey, a.n AS n_before, coalesce(b.n, 0) AS n_after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b USING (o_custkey)
""")
def lookup_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN2, AG22: a left lookup and the difference of two counts, in one pass over the table."""
    per = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "O").alias("o"))
    return per.filter("f > 0").select("o_custkey", F.col("f").alias("n_before"), F.col("o").alias("n_after"), (F.col("o") - F.col("f")).alias("delta"))


@query("""
SELECT u.c_custkey, list_count(o) AS n_orders, coalesce(array_to_string(o, ' '), '') AS order_keys FROM customer u LEFT JOIN (SELECT o_custkey, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS o FROM orders GROUP BY 1) x ON u.c_custkey = x.o_custkey
""".replace("list_count(o)", "coalesce(len(o), 0)"))
def grouped_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5: a customer's orders as one ordered array."""
    many = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey")
    j = tables.grouped_lookup(read(spark, sf_dir, "customer").select("c_custkey"), many, "c_custkey", ["o_orderdate", "o_orderkey"], "orders")
    return j.select("c_custkey", F.size("orders").cast("long").alias("n_orders"), F.array_join(F.transform("orders", lambda o: o["o_orderkey"].cast("string")), " ").alias("order_keys"))
