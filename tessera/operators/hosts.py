"""Lists of hosts as an index of suffixes: a host meets every listed name above it by an equi-join, whatever the list's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.url import base_host


def suffixes(host: Column) -> Column:
    """A host and the names above it, the longest first; a host has at most 127 labels, so the array is bounded."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")))


def suffix_index(listed: DataFrame, name: str) -> DataFrame:
    """A list as an index: suffix (lower case, no www., no leading dot or *.) and the list's other columns. Of rows with one
    suffix the smallest stays, so that a host has one longest match."""
    others = [c for c in listed.columns if c != name]
    clean = base_host(F.regexp_replace(F.trim(F.col(name)), r"^(\*?\.)+", ""))
    rows = listed.select(clean.alias("suffix"), F.struct(*others).alias("_row") if others else F.lit(1).alias("_row")).filter("suffix <> ''")
    one = rows.groupBy("suffix").agg(F.min("_row").alias("_row"))
    return one.select("suffix", "_row.*") if others else one.select("suffix")


def longest_match(df: DataFrame, host: str, index: DataFrame) -> DataFrame:
    """UR18, JN3: df with matched (the longest suffix of its host in the index, null without one) and the index's columns.

    Different hosts are looked up once each, by one equi-join on their suffixes, and joined back: a frequent host is one
    row in the lookup. Null and empty hosts match nothing.
    """
    columns = [c for c in index.columns if c != "suffix"]
    hosts = df.select(base_host(F.col(host)).alias("_host")).filter("_host <> ''").distinct()
    each = hosts.withColumn("suffix", F.explode(suffixes(F.col("_host"))))
    met = each.join(index, "suffix").groupBy("_host").agg(F.max_by(F.struct("suffix", *columns), F.length("suffix")).alias("_m"))
    found = met.select("_host", F.col("_m.suffix").alias("matched"), *[F.col(f"_m.{c}").alias(c) for c in columns])
    rows = df.withColumn("_key", base_host(F.col(host)))
    return rows.join(found, F.col("_key") == F.col("_host"), "left").drop("_key", "_host")


def under_list(df: DataFrame, host: str, index: DataFrame) -> DataFrame:
    """FLT10: the rows whose host is listed or lies under a listed name."""
    return longest_match(df, host, index.select("suffix")).filter("matched IS NOT NULL").drop("matched")


def not_under_list(df: DataFrame, host: str, index: DataFrame) -> DataFrame:
    """JN3: the rows whose host lies under no listed name; rows without host stay."""
    return longest_match(df, host, index.select("suffix")).filter("matched IS NULL").drop("matched")


def matches_by_list(df: DataFrame, host: str, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows and different hosts each listed name holds: matched, keys, rows, hosts."""
    met = longest_match(df, host, index).filter("matched IS NOT NULL")
    return met.groupBy("matched", *keys).agg(F.count("*").alias("rows"), F.count_distinct(host).alias("hosts"))
