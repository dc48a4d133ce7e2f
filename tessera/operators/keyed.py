"""Per-key ordered folds: latest and first records, histories, precedence, duplicates. Every order has a full tie rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.space import cut


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _picked(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    """One whole row per key by an aggregate, which combines before the shuffle as a window cannot."""
    out = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(pick.alias("_row"))
    return out.select(*[F.col("_row").getField(c).alias(c) for c in df.columns])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WN1: the row of each key with the largest order columns (nulls smallest); name an ordinal last to break ties."""
    return _picked(df, keys, F.max_by(_row(df), F.struct(*order)))


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """ST2, ST6: the first row of each key wins."""
    return _picked(df, keys, F.min_by(_row(df), F.struct(*order)))


def first_and_last(df: DataFrame, keys: Sequence[str], ts: str, ordinal: str, before: object = None) -> DataFrame:
    """WN2: keys, first and last rows as structs; among equal times the first wins for first and the last for last.

    before: rows at or after this time are left out.
    """
    rows = df if before is None else df.filter(F.col(ts) < F.lit(before))
    order = F.struct(ts, ordinal)
    return rows.groupBy(*keys).agg(F.min_by(_row(df), order).alias("first"), F.max_by(_row(df), order).alias("last"))


def by_precedence(sources: Sequence[DataFrame], key: str, ts: str, newer_only: Sequence[int] = ()) -> DataFrame:
    """WN3: a later source wins; those listed in newer_only win only if they are not older than what they replace."""
    out = sources[0]
    for k, more in enumerate(sources[1:], 1):
        a, b = out.select(F.col(key).alias("_a"), _row(out).alias("_x")), more.select(F.col(key).alias("_b"), _row(more).alias("_y"))
        wins = F.col("_y").isNotNull()
        if k in newer_only:
            wins &= F.col("_x").isNull() | (F.col(f"_y.{ts}") >= F.col(f"_x.{ts}"))
        both = a.join(b, F.col("_a") == F.col("_b"), "full_outer").select(F.when(wins, F.col("_y")).otherwise(F.coalesce("_x", "_y")).alias("_row"))
        out = both.select("_row.*")
    return out


def best_of_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str) -> DataFrame:
    """WN4: the row with the largest order columns, and the ids of the others, in that order, as other_ids."""
    ranked = F.reverse(F.array_sort(F.collect_list(F.struct(*order, id_col))))
    ids = F.transform(F.slice(ranked, 2, F.size(ranked)), lambda r: r[id_col].cast("string"))
    own = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(_row(df), F.struct(*order, id_col)).alias("_row"), F.array_join(ids, " ").alias("other_ids"))
    return own.select("_row.*", "other_ids")


def collapsed(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """WN5: rows whose value differs from the one before within a key."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order)) == 1
    return df.withColumn("_new", first | ~F.col(value).eqNullSafe(before)).filter("_new").drop("_new")


def collapse_array(values: Column) -> Column:
    """WN5 for an array."""
    return F.filter(values, lambda v, i: (i == 0) | ~v.eqNullSafe(F.get(values, i - 1)))


def history(df: DataFrame, key: str, arrays: Sequence[str], signature: str) -> DataFrame:
    """AG14: the union of arrays over all records of a key (sorted), and whether their signatures changed."""
    unions = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(c))))).alias(f"ever_{c}") for c in arrays]
    return df.groupBy(key).agg(*unions, (F.count_distinct(signature) > 1).alias("changed"))


def resolved_labels(df: DataFrame, key: str, verdict: str, rounds: Sequence[str], unsure: str = "unsure") -> DataFrame:
    """WN9: later rounds win; an unsure verdict never replaces another one."""
    sure = df.filter(F.coalesce(F.col(verdict), F.lit(unsure)) != unsure)
    return latest(sure, [key], rounds)


def first_mention_ranks(text: Column, entries: Sequence[tuple[str, str]]) -> Column:
    """WN6: names in the order of their first mention (plain lower-case needles)."""
    at = F.array(*[F.struct(F.nullif(F.instr(F.lower(text), needle), F.lit(0)).alias("at"), F.lit(name).alias("name")) for name, needle in entries])
    return F.transform(F.array_sort(F.filter(at, lambda x: x["at"].isNotNull())), lambda x: x["name"])


def best_variant(df: DataFrame, key: str, rank: Sequence[str]) -> DataFrame:
    """WN11: the variant of each key with the largest rank tuple."""
    return latest(df, [key], rank)


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "n") -> DataFrame:
    """WN7: numbers from 1 over the whole table in order, without bringing all rows into one task.

    Rows are dealt into ranges and sorted, numbered within a range and shifted by the sizes of the ranges before. The
    checkpoint fixes the ranges, so that a task that is run again gives the same numbers.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    parted = cut(dealt.withColumn("_part", F.shiftright("_at", 33)).withColumn("_in", F.col("_at").bitwiseAND((1 << 33) - 1)))
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    #: A row for each range.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("_part").alias("_p"), before.alias("_start"))
    joined = parted.join(F.broadcast(starts), F.col("_part") == F.col("_p"))
    return joined.withColumn(name, F.col("_start") + F.col("_in") + 1).select(*df.columns, name)
