"""Streams over append-only logs: the latest record per key, kept as a table. Keys already seen: seen.py.

The batch functions over all files and the stream after all files give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.keyed import latest
from tessera.space import cut, drop, file_system


BUCKETS = 64


def latest_stream(spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: Sequence[str], out: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """IN2, WN1: every micro-batch is reduced to its latest records and merged into the table under out.

    The table is dealt into buckets by key; a batch writes only the buckets that it touches, as v=<batch>/bucket=<k>, so its
    cost follows the batch and not the table. A batch that is run again writes the same folders again; versions that two
    later ones of a bucket replace are removed. Use read_latest to read the table. Runs over what is there and stops
    (availableNow).
    """

    def merge(batch: DataFrame, number: int) -> None:
        dealt = latest(batch, keys, order).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        now = cut(dealt)
        touched = {r["bucket"] for r in now.select("bucket").distinct().collect()}  # at most buckets rows
        held = {k: v for k, v in parts(spark, out, number).items() if k in touched}
        if held:
            before = spark.read.schema(dealt.schema).option("basePath", out).parquet(*[f"{out}/v={v[-1]}/bucket={k}" for k, v in held.items()])
            now = latest(before.select(*dealt.columns).unionByName(now), keys, order)
        now.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/v={number}")
        for k, versions in held.items():
            for v in versions[:-1]:
                drop(spark, f"{out}/v={v}/bucket={k}")

    stream = spark.readStream.schema(schema).json(path)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parts(spark: SparkSession, out: str, below: int | None = None) -> dict[int, list[int]]:
    """The whole versions of each bucket under a path, oldest first."""
    fs, path = file_system(spark, out)
    found: dict[int, list[int]] = {}
    if not fs.exists(path):
        return found
    versions = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
    for p in sorted(versions, key=lambda p: int(p.getName()[2:])):
        v = int(p.getName()[2:])
        if (below is None or v < below) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
            for s in fs.listStatus(p):
                if s.getPath().getName().startswith("bucket="):
                    found.setdefault(int(s.getPath().getName()[7:]), []).append(v)
    return found


def read_latest(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The table: the newest version of each bucket."""
    paths = [f"{out}/v={v[-1]}/bucket={k}" for k, v in sorted(parts(spark, out).items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def windowed_counts(events: DataFrame, ts: str, by: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """IN4: progress counters by window, for streams (late rows beyond the watermark are left out) and tables alike."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
