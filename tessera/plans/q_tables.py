"""Queries over events, orders, parts, suppliers and labels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import keyed, tables
from tessera.plans.registry import query


def table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


events, orders, lineitem, customer = table("events"), table("orders"), table("lineitem"), table("customer")
supplier, part, nation, labels, documents = table("supplier"), table("part"), table("nation"), table("labels"), table("documents")


@query("SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN1."""
    return keyed.latest(events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value"), ["user_id"], ["ts", "event_id"])


@query("""
SELECT user_id, min(event_id) FILTER (WHERE a = 1) AS first_event, max(event_id) FILTER (WHERE z = 1) AS last_event FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z FROM events WHERE ts < TIMESTAMP '2024-01-20') GROUP BY user_id
""")
def redo_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN2, FLT1: first and last record of each key before a cutoff."""
    found = keyed.first_and_last(events(spark, sf_dir).select("user_id", "ts", "event_id"), ["user_id"], "ts", "event_id", before=dt.datetime(2024, 1, 20))
    return found.select("user_id", F.col("first.event_id").alias("first_event"), F.col("last.event_id").alias("last_event"))


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ' ') AS ever_types, count(DISTINCT event_type) > 1 AS changed FROM events GROUP BY user_id")
def event_history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG14, DC11: the union of what was ever seen."""
    own = events(spark, sf_dir).select("user_id", F.array("event_type").alias("types"), F.col("event_type").alias("signature"))
    return keyed.history(own, "user_id", ["types"], "signature").withColumn("ever_types", F.array_join("ever_types", " "))


@query("SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type, lag(event_type) OVER w AS b, row_number() OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE r = 1 OR event_type IS DISTINCT FROM b")
def history_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN5."""
    return keyed.collapsed(events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type")


@query("SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX20, TX21: a typed field of a JSON cell; what is no number is 0."""
    return events(spark, sf_dir).select("event_id", F.coalesce(F.from_json("props", "k bigint")["k"], F.lit(0).cast("long")).alias("k"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY event_type")
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1, AG19."""
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS r FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL)) WHERE r = 1")
def majority_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18."""
    return tables.majority(events(spark, sf_dir), "user_id", "event_type", "event_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def wanted_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4."""
    wanted = orders(spark, sf_dir).filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return tables.only(customer(spark, sf_dir).select("c_custkey", "c_name"), wanted, "c_custkey")


@query("""
SELECT o_custkey, max(o_orderkey) FILTER (WHERE r = 1) AS o_orderkey, coalesce(string_agg(o_orderkey::VARCHAR, ' ' ORDER BY r) FILTER (WHERE r > 1), '') AS other_ids FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) GROUP BY o_custkey
""")
def best_of_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN4."""
    own = orders(spark, sf_dir).select("o_custkey", "o_orderdate", "o_orderkey")
    return keyed.best_of_duplicates(own, ["o_custkey"], ["o_orderdate"], "o_orderkey").select("o_custkey", "o_orderkey", "other_ids")


@query("""
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left' ELSE 'right' END AS status
FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01') a FULL OUTER JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') b ON a.k = b.k
""")
def full_outer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1, AG22, MT3: keys of two periods."""
    own = orders(spark, sf_dir).select(F.col("o_custkey").alias("k"), "o_orderdate")
    return tables.three_way(own.filter("o_orderdate < TIMESTAMP '1998-01-01'"), own.filter("o_orderdate >= TIMESTAMP '1998-01-01'"), "k")


@query("""
SELECT l_suppkey, CASE WHEN t AND o THEN '4_mixed' WHEN t THEN '1_target_only' WHEN o THEN '3_other_only' ELSE '2_no_ads' END AS "group", array_to_string(brands, ' ') AS other_brands FROM (
  SELECT l_suppkey, bool_or(l_returnflag = 'A' AND l_quantity > 40) AS t, bool_or(l_returnflag = 'R' AND l_quantity > 40) AS o, coalesce(list_sort(list(DISTINCT l_linestatus) FILTER (WHERE l_returnflag = 'R' AND l_quantity > 40)), []) AS brands FROM lineitem GROUP BY l_suppkey)
""")
def group_from_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG15."""
    kind = F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 40), "target").when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), "other").otherwise("none")
    return tables.site_group(lineitem(spark, sf_dir).withColumn("kind", kind), "l_suppkey", "kind", "l_linestatus").withColumn("other_brands", F.array_join("other_brands", " "))


@query("""
SELECT n_name, count(*) AS n_lines, sum(l_quantity) AS quantity, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_suppkey) AS suppliers FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name ORDER BY n_lines DESC, n_name LIMIT 10
""")
def rollup_by_supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG7, JN7, TK3: lines are summed by supplier before the small tables come in; a report of the ten busiest nations."""
    per = lineitem(spark, sf_dir).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    j = per.join(supplier(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).join(nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    found = j.groupBy("n_name").agg(F.sum("n").alias("n_lines"), F.sum("q").alias("quantity"), F.sum("r").alias("returned"), F.count("*").alias("suppliers"))
    return found.orderBy(F.desc("n_lines"), "n_name").limit(10)


@query("SELECT p_brand, p_partkey, p_retailprice, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 3")
def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK4."""
    own = part(spark, sf_dir).select("p_brand", "p_partkey", "p_retailprice")
    return tables.top_per_group(own, ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 3).withColumn("rank", F.col("rank").cast("long"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK2, TK3: a top-k report."""
    return orders(spark, sf_dir).select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("""
WITH r AS (SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) - 1 AS r, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer),
s AS (SELECT *, CASE WHEN n <= 10 THEN r ELSE ((r + 1) * 10 - 1) // n END::INT AS slice FROM r)
SELECT c_mktsegment, c_custkey, slice FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, slice ORDER BY md5('1:' || c_custkey), c_custkey) AS d FROM s) WHERE d = 1
""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK6: one of each of ten slices by balance."""
    found = tables.stratified_sample(customer(spark, sf_dir).select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"], ["c_acctbal", "c_custkey"], "c_custkey", 10)
    return found.select("c_mktsegment", "c_custkey", "slice")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 50 AS batch_id FROM orders")
def batching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK11, WN7, SNK4: batches of 50 in order, numbered without a single-task window."""
    ranked = keyed.numbered(orders(spark, sf_dir).select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])
    return tables.in_batches(ranked, "n", 50).select("o_orderkey", "batch_id")


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority")
def pivot_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9."""
    return orders(spark, sf_dir).groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT lang, (100 * sum(quality)::BIGINT // greatest(1, count(*)))::BIGINT AS percent FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def floor_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8."""
    j = labels(spark, sf_dir).join(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    return j.groupBy("lang").agg(tables.floor_percent(F.sum("quality"), F.count("*")).alias("percent"))


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rule = F.when(text.contains("!!"), "shout").when(text.contains(" | "), "table").otherwise("plain")
    return documents(spark, sf_dir).select("doc_id", rule.alias("rule"))


RULED = "SELECT doc_id, CASE WHEN contains(text, '!!') THEN 'shout' WHEN contains(text, ' | ') THEN 'table' ELSE 'plain' END AS rule FROM documents"


@query(f"""
SELECT r.doc_id, r.rule, CASE WHEN l.quality = 0 AND r.rule = 'plain' THEN 'reviewed_bad' ELSE r.rule END AS final,
  CASE WHEN l.doc_id IS NULL OR r.rule <> 'plain' THEN NULL WHEN l.quality = 0 THEN 'fixed' ELSE 'confirmed' END AS "check" FROM ({RULED}) r LEFT JOIN labels l USING (doc_id)
""")
def verdict_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN9, DC20: a review replaces the class it was given for."""
    wrong = F.col("quality") == 0
    verdicts = labels(spark, sf_dir).select("doc_id", F.lit("plain").alias("given"), F.when(wrong, "wrong").otherwise("correct").alias("verdict"), F.when(wrong, "reviewed_bad").alias("should_be"))
    return tables.overlay(_ruled(spark, sf_dir), verdicts, "doc_id", "rule", "rule")


@query(f"""
SELECT count(*) FILTER (WHERE f = t) AS agree, count(*) FILTER (WHERE f <> t AND f <> 'unsure') AS disagree, count(*) FILTER (WHERE f = 'unsure') AS unsure, count(*) FILTER (WHERE f IS NULL) AS missing,
  count(*) FILTER (WHERE f = t) / count(*) FILTER (WHERE f <> 'unsure')::DOUBLE AS rate
FROM (SELECT CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS t, CASE WHEN r.rule = 'table' THEN 'unsure' WHEN r.rule = 'shout' THEN 'bad' WHEN r.rule = 'plain' THEN 'good' END AS f FROM labels l LEFT JOIN ({RULED}) r USING (doc_id))
""")
def control_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN10, ML6."""
    truth = labels(spark, sf_dir).select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("value"))
    found = _ruled(spark, sf_dir).select("doc_id", F.when(F.col("rule") == "table", "unsure").when(F.col("rule") == "shout", "bad").otherwise("good").alias("value"))
    return tables.agreement(truth, found, "doc_id")


@query("""
SELECT least(4, floor(p * 5))::INT AS bin, count(*) AS n, sum(quality)::BIGINT AS hits FROM (SELECT quality, (n_chars % 1000) / 1000.0::DOUBLE AS p FROM labels JOIN documents USING (doc_id)) GROUP BY 1
""")
def risk_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG17."""
    j = labels(spark, sf_dir).join(documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id")
    return tables.risk_bins(j.withColumn("p", F.pmod("n_chars", F.lit(1000)) / 1000.0), "p", "quality").select("bin", "n", "hits")


@query("SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, ST7."""
    a = customer(spark, sf_dir).select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = supplier(spark, sf_dir).select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return tables.union_by_name([a, b])


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3."""
    return tables.without(customer(spark, sf_dir).select(F.col("c_custkey").alias("k")).distinct(), supplier(spark, sf_dir).select(F.col("s_suppkey").alias("k")), "k")


@query("SELECT s_suppkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def set_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4."""
    return tables.only(supplier(spark, sf_dir).select(F.col("s_suppkey").alias("k")).distinct(), customer(spark, sf_dir).select(F.col("c_nationkey").alias("k")), "k")


@query("""
SELECT o_orderpriority, count(*) AS n, sum(o_totalprice::DECIMAL(20,2))::DOUBLE AS total, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM orders GROUP BY o_orderpriority
""")
def priority_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG2, AG12, AG21."""
    own = orders(spark, sf_dir).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("total"))
    return tables.share_of_total(own, "n").select("o_orderpriority", "n", "total", "share")


@query("""
SELECT strftime(m, '%Y-%m-%d') AS peak_month, v AS peak, (SELECT v FROM h ORDER BY m DESC LIMIT 1) AS last, (SELECT v FROM h ORDER BY m DESC LIMIT 1) / v::DOUBLE AS ratio FROM h ORDER BY v DESC, m LIMIT 1
""".replace("SELECT strftime", "WITH h AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS v FROM orders GROUP BY 1) SELECT strftime", 1))
def metric_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT1: orders by month, their peak and the last month's ratio to it."""
    monthly = orders(spark, sf_dir).groupBy(F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("month")).agg(F.count("*").alias("v"))
    return tables.peak(monthly, "month", "v")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice - l_discount <> l_tax")
def identity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT2."""
    return tables.column_identity(lineitem(spark, sf_dir), "l_extendedprice", "l_discount", "l_tax").select("l_orderkey", "l_linenumber")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'purchase' THEN 2 ELSE 4 END AS priority, event_id % 8 AS bucket FROM events")
def queue_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN10, TK10."""
    own = events(spark, sf_dir).select("event_id", tables.priority(F.col("event_type"), [("^error$", 1), ("^purchase$", 2)], 4).alias("priority"))
    return tables.round_robin(own, "event_id", 8)


@query("SELECT event_id, coalesce(try_cast(nullif(trim(split_part(props, ':', 2), ' }'), '') AS DOUBLE), 0.0) AS v FROM events")
def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX20."""
    return events(spark, sf_dir).select("event_id", T.number(F.rtrim(F.element_at(F.split("props", ":"), 2), F.lit("}"))).alias("v"))


@query("SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE coalesce(k, 0) = 0) AS n_zero FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) o ON c_custkey = o_custkey GROUP BY c_mktsegment")
def group_zero_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT4: members of each group, and those without traffic."""
    traffic = orders(spark, sf_dir).filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    j = customer(spark, sf_dir).select("c_custkey", "c_mktsegment").join(traffic, "c_custkey", "left")
    return j.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.coalesce("k", F.lit(0)) == 0).alias("n_zero"))


@query("""
SELECT count(*) AS n, sum(p_size)::BIGINT AS volume, avg((p_type = 'PROMO')::INT) AS promo_share FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
""")
def keyword_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT5: what one list has and the other has not, its volume and the share of a kind."""
    have = lineitem(spark, sf_dir).filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    gap = tables.without(part(spark, sf_dir), have, "p_partkey")
    return gap.agg(F.count("*").alias("n"), F.sum(F.col("p_size").cast("long")).alias("volume"), F.avg((F.col("p_type") == "PROMO").cast("int")).alias("promo_share"))


@query("SELECT coalesce(r_name, 'open') AS market, count(*) AS suppliers, sum(s_acctbal::DECIMAL(18, 2))::DOUBLE AS balance FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey GROUP BY 1")
def market_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT6: a metric by country joined to the state of its market, open where none is known."""
    region = table("region")(spark, sf_dir).filter("r_name <> 'ASIA'")
    j = supplier(spark, sf_dir).join(nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.groupBy(F.coalesce("r_name", F.lit("open")).alias("market")).agg(F.count("*").alias("suppliers"), F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))


@query("SELECT event_type, k % 3 AS size_class, count(*) AS n, count(DISTINCT user_id) AS exits, count(*) FILTER (WHERE (k % 2 = 0) <> (user_id % 2 = 0)) AS differ FROM (SELECT *, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY ALL")
def response_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT8: one address seen from many exits: answers by state, and where two sources differ."""
    own = events(spark, sf_dir).withColumn("k", F.from_json("props", "k bigint")["k"])
    differ = F.count_if((F.pmod("k", F.lit(2)) == 0) != (F.pmod("user_id", F.lit(2)) == 0))
    return own.groupBy("event_type", F.pmod("k", F.lit(3)).alias("size_class")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("exits"), differ.alias("differ"))
