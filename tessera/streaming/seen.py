"""Keys already seen, as state of a stream: every key is given out once, and forgotten after a while without rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Typed state with timers is kept by this provider alone.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """Gives out the first row of a key and keeps when the key was last met; a timer forgets it."""

    def __init__(self, ts: str, order: Sequence[str], forget_ms: int):
        self.ts, self.order, self.forget_ms = ts, list(order), forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.met = handle.getValueState("met", "until long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        best, until = None, 0
        for part in rows:
            until = max(until, int(part[self.ts].max().timestamp() * 1000) + self.forget_ms)
            part = part if best is None else pd.concat([best, part])
            best = part.sort_values(self.order, kind="stable").head(1)
        known = self.met.get()[0] if self.met.exists() else None
        if known is None or until > known:  # the timer moves on with the key's latest row
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(until)
            self.met.update((until,))
        if known is None and best is not None:
            yield best

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.met.clear()
        yield from ()

    def close(self) -> None:
        pass


def _combined(keys: Sequence[str], ts: str, order: Sequence[str]):
    """Of each key the first row of a batch, with the rows that hold its latest time: what a task sends on for a frequent
    key does not grow with its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ordered = b.sort_values(list(order), kind="stable")
            first = ordered.drop_duplicates(list(keys), keep="first")
            last = ordered.sort_values(ts, kind="stable").drop_duplicates(list(keys), keep="last")
            yield pd.concat([first, last.loc[~last.index.isin(first.index)]])

    return run


def first_seen(rows: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], forget: str = "30 days", late: str = "1 hour") -> DataFrame:
    """IN1: the rows of a stream whose key was not met before; in one micro-batch the first one by order.

    Keys live in keyed state, which a restart from the checkpoint finds again; a key without rows for the time forget, by
    the watermark (late), is forgotten and would be given out anew, which bounds the state. Rows later than the watermark
    are left out, and so are rows without a time or with a null key. The session's state store must be PROVIDER.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    forget_ms = int(spark.sql(f"SELECT CAST(INTERVAL {forget} AS INTERVAL DAY TO SECOND) AS i").first()[0].total_seconds() * 1000)
    whole = rows.dropna(subset=[*keys, ts]).mapInPandas(_combined(keys, ts, order), rows.schema).withWatermark(ts, late)
    return whole.groupBy(*keys).transformWithStateInPandas(FirstOfKey(ts, order, forget_ms), rows.schema, "Append", "EventTime")


def first_seen_table(spark: SparkSession, path: str, schema: str, keys: Sequence[str], ts: str, order: Sequence[str], out: str, checkpoint: str, forget: str = "30 days", late: str = "1 hour") -> StreamingQuery:
    """IN1: first_seen over JSON files under path, appended to the table under out, up to what is there now (availableNow).
    Run it again with the same checkpoint to take new files alone."""
    found = first_seen(spark.readStream.schema(schema).json(path), keys, ts, order, forget, late)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def unseen(queue: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """IN1, IN3 for tables: the rows of a queue whose key a log does not hold; null keys are never held."""
    return queue.join(log.select(*keys).dropna().dropDuplicates(list(keys)), list(keys), "left_anti")


def still_known(log: DataFrame, keys: Sequence[str], ts: str, forget: str = "30 days") -> DataFrame:
    """IN3: keys and their last time, those whose last time lies within forget of the log's latest: what the stream holds
    after the log, so that a table made before can be taken over."""
    last = log.dropna(subset=[*keys, ts]).groupBy(*keys).agg(F.max(ts).alias(ts))
    newest = log.agg(F.max(ts).alias("_newest"))
    return last.crossJoin(F.broadcast(newest)).filter(F.col(ts) > F.col("_newest") - F.expr(f"INTERVAL {forget}")).drop("_newest")
