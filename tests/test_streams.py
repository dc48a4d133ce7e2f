"""Keyed state and observed counters of streams, over files that come one after another."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.streaming import progress, seen

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "key string, ts timestamp, n int"


def put(spark, path, rows):
    spark.createDataFrame([(k, T0 + dt.timedelta(days=d), n) for k, d, n in rows], SCHEMA).coalesce(1).write.mode("append").json(path)


def test_keys_are_given_out_once_and_forgotten(spark, tmp_path):
    path, out, mark = (f"file://{tmp_path}/{x}" for x in ("in", "out", "mark"))
    got = []
    files = [
        [("a", 0, 2), ("a", 0, 1), ("b", 1, 3), (None, 1, 4), ("a", 2, 5)] + [("hot", 2, k) for k in range(300)],
        [("a", 3, 6), ("c", 40, 7)],  # nothing new of a; c moves the watermark on
        [("d", 41, 8)],
        [("a", 42, 9), ("c", 43, 10), ("late", 0, 11)],  # a was forgotten, c was not, the last row is too late
    ]
    for rows in files:
        put(spark, path, rows)
        seen.first_seen_table(spark, path, SCHEMA, ["key"], "ts", ["ts", "n"], out, mark, forget="30 days", late="1 day").awaitTermination()
        now = sorted((r.key, r.n) for r in spark.read.schema(SCHEMA).parquet(out).collect())
        got.append([x for x in now if x not in (sum(got, []))])
    assert got == [[("a", 1), ("b", 3), ("hot", 0)], [("c", 7)], [("d", 8)], [("a", 9)]]


def test_tables_know_what_the_stream_knows(spark):
    rows = [("a", T0), ("a", T0 + dt.timedelta(days=20)), ("b", T0), ("c", T0 + dt.timedelta(days=45)), (None, T0), ("d", None)]
    log = spark.createDataFrame(rows, "key string, ts timestamp")
    assert {r.key for r in seen.still_known(log, ["key"], "ts", "30 days").collect()} == {"a", "c"}
    queue = spark.createDataFrame([("a",), ("x",), (None,), ("x",)], "key string")
    assert sorted(str(r.key) for r in seen.unseen(queue, log, ["key"]).collect()) == ["None", "x", "x"]
    assert seen.unseen(queue, log.limit(0), ["key"]).count() == 4


def test_counters_without_a_second_scan(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    spark.range(1000).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id"))).write.parquet(path)
    metrics = progress.counters(large=F.col("v") > 500, never=F.lit(None).cast("boolean"))
    passing, observation = progress.counted(spark.read.parquet(path), "rows", metrics)
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert passing.filter("id < 100").count() == 100
    assert observation.get == {"n": 1000, "large": 450, "never": 0}
    empty, observation = progress.counted(spark.read.parquet(path).filter("id < 0"), "empty", metrics)
    empty.collect()
    assert observation.get == {"n": 0, "large": 0, "never": 0}


def test_counters_of_a_stream(spark, tmp_path):
    path, out, mark = (f"file://{tmp_path}/{x}" for x in ("in", "out", "mark"))
    listener = progress.Progress()
    spark.streams.addListener(listener)
    try:
        for rows in ([("a", 0, 1), ("b", 0, 2)], [("a", 1, 30)]):
            put(spark, path, rows)
            stream = spark.readStream.schema(SCHEMA).json(path).observe("log", *[c.alias(k) for k, c in progress.counters(large=F.col("n") > 1).items()])
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals("log") == {"n": 3, "large": 2}
    assert len(listener.batches("log")) == 2 and listener.totals("other") == {}
