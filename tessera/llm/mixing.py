"""Mixing sources to target weights: tokens per source give repetition rates, and rates give whole copies of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, broadcast_if_small, cut

#: Hash seeds that are tried for each source; the draw whose words come nearest the target is taken.
SEEDS = 32
#: Targets of so many sources are broadcast, so that a source with a third of all rows stays spread over all tasks.
BROADCAST_SOURCES = 100_000
#: A fair hash of 32 bits that SQL engines agree on: the first eight hex digits of an MD5.
SCALE = 4294967296.0


def n_words(text: Column) -> Column:
    """Words without x20 and x09-x0D in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(seed: Column) -> Column:
    name = F.concat_ws(":", seed.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / SCALE


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """One row per source: source, source_size, weight, target, rate.

    Sources by code point, null last, take the weights in turn. All sizes are shared out by weight; a target stops at cap
    times its source's size and the excess is shared again among the others. That is one level: target = min(cap * size,
    level * weight), found from running sums in order of cap * size / weight. The windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    which = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", which).withColumn("most", F.col("source_size") * F.lit(cap))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    #: The level if this source is the first one that is not stopped.
    level = left / F.sum("weight").over(onward)
    free = F.when(level * F.col("weight") <= F.col("most"), level)
    #: Later sources give lower levels, so the highest is that of the first free source.
    per = per.withColumn("level", free).withColumn("level", F.max("level").over(whole))
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return per.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "weight", "target", "rate")


def choose(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """The targets with a seed each. sized: doc_id, source, size of all documents.

    Of SEEDS seeds a source takes the one whose words come nearest its target (the smallest among equals).
    """
    per = source_targets(sized, weights, cap).select(F.col("source").alias("src"), "source_size", "target", "rate")
    per = broadcast_if_small(cut(per), BROADCAST_SOURCES)
    drawn = sized.join(per, sized.source.eqNullSafe(per.src))
    fraction = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(_draw(F.lit(k)) < fraction, F.col("size")).otherwise(F.lit(0))).alias(f"s{k}") for k in range(SEEDS)]
    totals = drawn.groupBy("src", "source_size", "target", "rate").agg(F.sum(F.col("size") * F.floor("rate")).alias("base"), *sums)
    off = [F.struct(F.abs(F.col("base") + F.col(f"s{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(SEEDS)]
    return totals.select("src", "source_size", "target", "rate", F.array_min(F.array(*off))["seed"].alias("seed"))


def with_copies(sized: DataFrame, chosen: DataFrame) -> DataFrame:
    """sized with source_size, target and copies: floor(rate), and one more where the seeded hash of doc_id and size
    draws below the fraction. Reruns agree; repeated rows are drawn alike."""
    joined = sized.join(chosen, sized.source.eqNullSafe(chosen.src))
    more = F.when(_draw(F.col("seed")) < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return joined.withColumn("copies", (F.floor("rate") + more).cast("int")).drop("src", "rate", "seed")


def _sizes(docs: DataFrame) -> DataFrame:
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """The mixed rows: every row of docs as often as its copies say, with the columns of docs.

    A null text has size 0; null sources are one source, the last; a source without words has target 0 and takes
    nothing. An empty table gives no rows. Texts are read twice: for the sizes, and to be copied.
    """
    chosen = broadcast_if_small(cut(choose(_sizes(docs), weights, cap)), BROADCAST_SOURCES)
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(F.col("text")).alias("size"))
    planned = with_copies(plain, chosen).filter("copies > 0")
    again = planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return again.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """doc_id, size, source_size, target and taken: the words of a row that the mix takes, repeats counted."""
    sized = _sizes(docs)
    chosen = broadcast_if_small(cut(choose(sized, weights, cap)), BROADCAST_SOURCES)
    planned = with_copies(sized, chosen)
    return planned.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def _sql() -> str:
    draws = ", ".join(f"sum(CASE WHEN ('0x' || substr(md5('{k}:' || d), 1, 8))::BIGINT / {SCALE} < rate - floor(rate) THEN size ELSE 0 END) AS s{k}" for k in range(SEEDS))
    off = ", ".join(f"{{'off': abs(base + s{k} - target), 'seed': {k}}}" for k in range(SEEDS))
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR, '-') || ':' || size AS d FROM sized
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, source_size * 3.0::DOUBLE AS most, ([1, 2, 3])[((row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), targets AS (
  SELECT source, source_size, least(most, coalesce(max(CASE WHEN level * weight <= most THEN level END) OVER () * weight, most)) AS target FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets
), totals AS (
  SELECT r.source, source_size, target, rate, sum(size * floor(rate)) AS base, {draws}
  FROM keyed k JOIN rates r ON k.source IS NOT DISTINCT FROM r.source GROUP BY ALL
), best AS (
  SELECT source, source_size, target, rate, (list_min([{off}])).seed AS seed FROM totals
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(md5(seed || ':' || d), 1, 8))::BIGINT / {SCALE} < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM keyed k JOIN best b ON k.source IS NOT DISTINCT FROM b.source
"""


SQL = _sql()
