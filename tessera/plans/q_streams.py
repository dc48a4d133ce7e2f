"""Queries of streams over events and clicks: keys seen once, counters of running jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.inputs import read
from tessera.plans.registry import query
from tessera.space import scratch
from tessera.streaming import progress, seen

LOG = "event_id long, ts timestamp, user_id long, event_type string"


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL) WHERE r = 1")
def first_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN1: each user's first event, by keyed state of a stream that is stopped after each of three files, in the order of
    time, and goes on from its checkpoint."""
    path, out, mark = (scratch(spark, x) for x in ("events", "first", "state"))
    own = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    third = F.percentile_approx(F.unix_micros("ts"), [1 / 3, 2 / 3], F.lit(1000)).alias("t")
    low, high = own.agg(third).first()["t"]
    part = F.when(F.unix_micros("ts") <= low, 0).when(F.unix_micros("ts") <= high, 1).otherwise(2)
    for k in range(3):
        own.filter(part == k).write.mode("append").json(path)
        seen.first_seen_table(spark, path, LOG, ["user_id"], "ts", ["ts", "event_id"], out, mark, forget="3650 days", late="3650 days").awaitTermination()
    return spark.read.schema(LOG).parquet(out).select("user_id", "event_id", "event_type")


@query("""
SELECT count(*) AS n, count_if(event_type = 'purchase') AS purchases, count_if(value > 50) AS large, count(DISTINCT event_type) AS types, (SELECT count(*) FROM events WHERE user_id % 2 = 0) AS written FROM events
""")
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN4: counters of a job that writes a part of events, taken while its rows pass: one scan."""
    path = scratch(spark, "observed")
    metrics = progress.counters(purchases=F.col("event_type") == "purchase", large=F.col("value") > 50)
    passing, seen_ = progress.counted(read(spark, sf_dir, "events"), "events", {**metrics, "types": F.size(F.collect_set("event_type")).cast("long")})
    kept, after = progress.counted(passing.filter("user_id % 2 = 0"), "kept", {"written": F.count(F.lit(1))})
    kept.write.parquet(path)
    row = {**seen_.get, **after.get}
    return spark.createDataFrame([tuple(row[k] for k in ("n", "purchases", "large", "types", "written"))], "n long, purchases long, large long, types long, written long")


@query("SELECT event_type, count(*) AS n, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END)::BIGINT AS large FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN4: counters by type of a stream over events, as its listener has summed them over all batches."""
    path, out, mark = (scratch(spark, x) for x in ("log", "copy", "offsets"))
    own = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    own.write.json(path)
    types = [r[0] for r in own.select("event_type").filter("event_type IS NOT NULL").distinct().collect()]  # a fixed list of kinds
    conditions = {f"{what}_{k}": (F.col("event_type") == t) & more for k, t in enumerate(types) for what, more in (("n", F.lit(True)), ("large", F.col("value") > 50))}
    rows = spark.readStream.schema("event_id long, event_type string, value double").option("maxFilesPerTrigger", 2).json(path)
    listener = progress.Progress()
    spark.streams.addListener(listener)
    try:
        stream = rows.observe("events", *[c.alias(k) for k, c in progress.counters(**conditions).items()])
        running = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        running.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        totals = listener.totals("events")
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([(t, int(totals[f"n_{k}"]), int(totals[f"large_{k}"])) for k, t in enumerate(types)], "event_type string, n long, large long")
