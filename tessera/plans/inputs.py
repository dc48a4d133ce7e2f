"""Inputs of queries: tables of the driver, and grids of flags that expressions of both engines make alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A number of 32 bits that looks random, of a key k, and others of it.
MIXERS = (2654435761, 2246822519, 3266489917, 668265263)
SPAN = 4294967296

#: Keys of grids in SQL: k and the numbers h0 to h3.
GRID = "SELECT k, " + ", ".join(f"(k * {m} + {i * 40503}) % {SPAN} AS h{i}" for i, m in enumerate(MIXERS)) + " FROM (SELECT o_orderkey AS k FROM orders)"


def grid(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """k (the key of an order) and h0 to h3; wide: over all cores, for queries with much work for each key."""
    k = F.col("k")
    keys = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    if wide:
        keys = spread(keys, "k")
    return keys.select("k", *[F.pmod(k * F.lit(m) + F.lit(i * 40503), F.lit(SPAN)).alias(f"h{i}") for i, m in enumerate(MIXERS)])


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a few small files over all cores, by columns: keys are small, what is made of them is not. A table in enough
    splits stays as it is."""
    wanted = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, *by)


def pick(h: int, shift: int, values: Sequence) -> Column:
    """One of some values by digits of a number: the Column form."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.shiftright(F.col(f"h{h}"), shift), F.lit(len(values))) + 1).cast("int"))


def flag(h: int, shift: int, of: int = 2) -> Column:
    """True for one key in so many."""
    return F.pmod(F.shiftright(F.col(f"h{h}"), shift), F.lit(of)) == 0


def number(h: int, shift: int, below: int) -> Column:
    return F.pmod(F.shiftright(F.col(f"h{h}"), shift), F.lit(below)).cast("int")


def nothing() -> Column:
    """An empty array of texts."""
    return F.array().cast("array<string>")


def sql_text(v: object) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def sql_pick(h: int, shift: int, values: Sequence) -> str:
    """The same in SQL."""
    return f"([{', '.join(sql_text(v) for v in values)}])[(h{h} >> {shift}) % {len(values)} + 1]"


def sql_flag(h: int, shift: int, of: int = 2) -> str:
    return f"((h{h} >> {shift}) % {of} = 0)"


def sql_number(h: int, shift: int, below: int) -> str:
    return f"((h{h} >> {shift}) % {below})::INT"
