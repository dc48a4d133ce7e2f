"""Folders that driver and executors share, and reliable checkpoints in them."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where a session names none (tests, notebooks) a folder under the warehouse is set instead.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files that one query writes and reads. drop removes it; what is left when the
    program ends goes then."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds; a missing one is no error."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)
    _made[:] = [x for x in _made if x[1] != path]


@atexit.register
def drop_all() -> None:
    """Remove all scratch folders that are left. Frames that read them cannot be run after that."""
    for spark, path in list(_made):
        with contextlib.suppress(Exception):  # the session may be gone; its folders stay then
            drop(spark, path)
    _made.clear()


#: Estimated sizes of more bits than this say nothing any more.
SIZE_BITS = 80


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    A checkpointed plan keeps the estimated size of what it was made of, and a join's estimate is a product: in loops these
    numbers double their digits each round until planning takes longer than the work. Such an estimate is dropped.
    """
    spark = df.sparkSession
    shared_dir(spark)
    out = df.checkpoint(eager=True)
    plan = out._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())).bit_length() <= SIZE_BITS:
        return out
    return type(out)(spark._jsparkSession.internalCreateDataFrame(plan.toRdd(), out._jdf.schema(), False), spark)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for a broadcast if it has at most so many rows, which are counted; else Spark joins by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of one Arrow batch: rows of long texts go to Python in batches of about this size, or one row that is longer.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes, so that what a Python worker holds does not follow the length of rows. A smaller bound
    that the user has set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.isdigit() or int(now) <= 0 or int(now) > most:
        spark.conf.set(key, str(most))
