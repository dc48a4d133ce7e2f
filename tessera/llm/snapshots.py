"""Difference of two snapshots of a table whose keys may change.

Rows count +1 in the earlier and -1 in the later snapshot. Equal rows (key and columns) cancel by their sum; what is left is
paired by key, as updates, and what that leaves by content, as rekeys. Rows travel as digests of their columns, so texts
are read and hashed where they lie. Pairs are found by ranks, which are counted in buckets of a group, so neither a key nor
a content that very many rows share goes through one task, and repeated rows are counted until they are given out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import cut

#: Copies of one row that are given out together.
CHUNK = 1000
#: Rows of a range partition, up to the session's number of shuffle partitions.
BUCKET_ROWS = 50_000


def _digest(df: DataFrame, name: str) -> Column:
    """SHA-256 of a value; null for null. Values of nested types go by their JSON text."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        value = F.to_json(F.struct(value))
    elif not isinstance(kind, T.StringType | T.BinaryType):
        value = value.cast("string")
    return F.unhex(F.sha2(value.cast("binary"), 256))


def _signed(snapshot: DataFrame, sign: int, key: str, columns: Sequence[str], carry: Mapping[str, Column]) -> DataFrame:
    """k (the key in a struct, as null keys are equal), h (digests of the columns), what is carried, and sign."""
    return snapshot.select(
        F.struct(F.col(key).alias("key")).alias("k"),
        F.array(*[_digest(snapshot, c) for c in columns]).alias("h"),
        *[value.alias(f"carry_{i}") for i, value in enumerate(carry.values())],
        F.lit(sign).alias("sign"),
    )


def _copies(rows: DataFrame, times: Column) -> DataFrame:
    """Every row so many times, with chunk; rows with very many copies are dealt to all tasks in chunks."""
    counted = rows.withColumn("times", times).filter("times > 0")
    few = counted.filter(F.col("times") <= CHUNK).withColumn("chunk", F.lit(0).cast("long"))
    many = counted.filter(F.col("times") > CHUNK).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {CHUNK}"))))
    size = F.least(F.lit(CHUNK), F.col("times") - F.col("chunk") * CHUNK).cast("int")
    out = few.unionByName(many.repartition("k", "h", "chunk"))
    return out.withColumn("copy", F.explode(F.array_repeat(F.lit(0), size))).drop("times", "copy")


def _ranked(rows: DataFrame, group: str, order: str) -> DataFrame:
    """rows and their rank, from 0, among the rows of their group and sign, by bucket and order. A large group lies in
    several buckets; its rows are ranked inside each and moved on by the counts of those before."""
    counts = rows.groupBy(group, "sign", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group, "sign").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(group, "sign", "bucket").orderBy(order)
    return rows.join(base, [group, "sign", "bucket"]).withColumn("rank", F.row_number().over(inside) - 1 + F.col("base")).drop("bucket", "base")


def _hash_buckets(rows: DataFrame) -> DataFrame:
    """Buckets by the upper bits of a hash of the contents, which part a key's contents evenly, and by chunks of copies."""
    return rows.withColumn("bucket", F.shiftright(F.xxhash64("h"), 52) * F.lit(1 << 40) + F.col("chunk")).drop("chunk")


def _key_buckets(rows: DataFrame) -> DataFrame:
    """Buckets in the order of keys: range partitions, of which there are as many as rows need. What Spark samples to part
    them is a hundred keys a partition; rows of one key are parted by their contents."""
    spark = rows.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_ROWS)))
    #: The checkpoint fixes which partition a row belongs to.
    return cut(rows.repartitionByRange(parts, F.col("k.key"), F.xxhash64("h", "salt")).withColumn("bucket", F.spark_partition_id()).drop("salt"))


def _paired(ranked: DataFrame, group: str, kept: Sequence[str]) -> DataFrame:
    """One row per group and rank: old_x of the earlier and new_x of the later row for every kept x; old and new say
    which there are."""
    side = {"old": F.col("sign") > 0, "new": F.col("sign") < 0}
    found = [F.max(is_side).alias(name) for name, is_side in side.items()]
    found += [F.first(F.when(is_side, F.col(x)), ignorenulls=True).alias(f"{name}_{x}") for name, is_side in side.items() for x in kept]
    return ranked.groupBy(group, "rank").agg(*found)


def difference(earlier: DataFrame, later: DataFrame, key: str, columns: Sequence[str], carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per pair or unpaired row: key (the later one, else the earlier), old_key (earlier, else null), op, changed
    (the differing columns of a pair, comma-joined) and what is carried.

    op is same or update for rows with equal keys, rekey for rows with equal columns and other keys, else insert or delete.
    carry names expressions over key and columns that are evaluated on every row and given out for the later one (a column
    itself, or a digest of it); they are null for delete. They must depend on key and columns alone and be of a type that
    can be grouped.

    Null keys are one key, and nulls equal only nulls. Where a key repeats, equal rows cancel first, as often as both
    snapshots hold them; the rest of both sides pair as updates in one order of contents, that of a hash and then of the
    digests, and i-th smallest keys pair as rekeys. Empty tables give inserts or deletes alone. Columns that are not named are not looked at.
    Keys have one type in both snapshots.
    """
    carry = carry or {}
    carried = [f"carry_{i}" for i in range(len(carry))]
    rows = _signed(earlier, 1, key, columns, carry).unionByName(_signed(later, -1, key, columns, carry))
    summed = cut(rows.groupBy("k", "h", *carried).agg(F.sum("sign").alias("net"), F.count("*").alias("n")))
    own = {"key": F.col("k.key"), "old_key": F.col("k.key"), "changed": F.lit("")}

    def given(df: DataFrame, op: Column, new: str = "", **values: Column) -> DataFrame:
        out = {**own, **values}
        extra = [F.col(f"{new}{c}").alias(name) for c, name in zip(carried, carry, strict=True)]
        return df.select(out["key"].alias("key"), out["old_key"].alias("old_key"), op.alias("op"), out["changed"].alias("changed"), *extra)

    same = given(_copies(summed, F.expr("(n - abs(net)) div 2")), F.lit("same"))
    residue = _copies(summed.withColumn("sign", F.signum("net").cast("int")), F.abs("net")).select("k", "h", "sign", "chunk", *carried)
    by_key = cut(_paired(_ranked(_hash_buckets(residue), "k", "h"), "k", ["h", *carried]))
    both = F.col("old") & F.col("new")
    names = [F.when(~F.col("old_h")[i].eqNullSafe(F.col("new_h")[i]), F.lit(c)) for i, c in enumerate(columns)]
    updates = given(by_key.filter(both), F.lit("update"), "new_", changed=F.concat_ws(",", *names))
    sign = F.when(F.col("old"), 1).otherwise(-1).alias("sign")
    left = by_key.filter(~both).select("k", F.coalesce("old_h", "new_h").alias("h"), sign, F.col("rank").alias("salt"), *[F.col(f"new_{c}").alias(c) for c in carried])
    by_content = _paired(_ranked(_key_buckets(left), "h", "k"), "h", ["k", *carried])
    op = F.when(both, "rekey").when(F.col("new"), "insert").otherwise("delete")
    old, new = F.col("old_k.key"), F.col("new_k.key")
    moved = given(by_content, op, "new_", key=F.when(F.col("new"), new).otherwise(old), old_key=old)
    return same.unionByName(updates).unionByName(moved)


def later_snapshot(docs: DataFrame) -> DataFrame:
    """A later snapshot of documents that the query compares: by crc32 of the decimal doc_id modulo 10, rows are dropped
    (0), changed in text (1) or by swapping lang and source (2), given another key (3, 4), or copied under one (5)."""
    m, other = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)), -1 - F.col("doc_id")
    rows = docs.select("doc_id", "text", "lang", "source", F.coalesce(m, F.lit(9)).alias("m")).filter("m <> 0")
    copies = F.when(F.col("m") == 5, F.array(F.col("doc_id"), other)).when(F.col("m").isin(3, 4), F.array(other)).otherwise(F.array("doc_id"))
    return rows.select(
        F.explode(copies).alias("doc_id"),
        F.when(F.col("m") == 1, F.concat(F.coalesce("text", F.lit("")), F.lit("+"))).otherwise(F.col("text")).alias("text"),
        F.when(F.col("m") == 2, F.col("source")).otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("m") == 2, F.col("lang")).when(F.col("m") != 4, F.col("source")).alias("source"),
    )


def report(docs: DataFrame) -> DataFrame:
    """documents against the later snapshot: key, old_key, op, changed and row_sha256 of the later row."""
    earlier = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    line = F.concat_ws("\n", *[F.coalesce(c, F.lit("~")) for c in ("text", "lang", "source")])
    return difference(earlier, later_snapshot(earlier), "doc_id", ["text", "lang", "source"], {"row_sha256": F.sha2(line.cast("binary"), 256)})


_CRC = """xor(list_reduce(flatten([[ascii(d), -1, -1, -1, -1, -1, -1, -1, -1] FOR d IN string_split(doc_id::VARCHAR, '')]),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295)"""
#: The same rows, for documents whose ids are unique.
SQL = f"""
WITH e AS (SELECT doc_id::BIGINT AS key, text, lang, source, {_CRC} % 10 AS m FROM documents),
l AS (
  SELECT CASE WHEN m IN (3, 4) THEN -1 - key ELSE key END AS key, CASE WHEN m = 1 THEN coalesce(text, '') || '+' ELSE text END AS text,
    CASE WHEN m = 2 THEN source ELSE lang END AS lang, CASE WHEN m = 2 THEN lang WHEN m <> 4 THEN source END AS source
  FROM e WHERE m <> 0
  UNION ALL SELECT -1 - key, text, lang, source FROM e WHERE m = 5),
p AS (
  SELECT l.key, e.key AS old_key, concat_ws(',', CASE WHEN e.text IS DISTINCT FROM l.text THEN 'text' END,
    CASE WHEN e.lang IS DISTINCT FROM l.lang THEN 'lang' END, CASE WHEN e.source IS DISTINCT FROM l.source THEN 'source' END) AS changed, l.text, l.lang, l.source
  FROM e JOIN l ON e.key = l.key),
a AS (SELECT *, row_number() OVER (PARTITION BY text, lang, source ORDER BY key) AS r FROM e WHERE key NOT IN (SELECT key FROM l)),
b AS (SELECT *, row_number() OVER (PARTITION BY text, lang, source ORDER BY key) AS r FROM l WHERE key NOT IN (SELECT key FROM e)),
c AS (
  SELECT coalesce(b.key, a.key) AS key, a.key AS old_key, CASE WHEN a.key IS NULL THEN 'insert' WHEN b.key IS NULL THEN 'delete' ELSE 'rekey' END AS op,
    b.text, b.lang, b.source
  FROM a FULL JOIN b ON a.r = b.r AND a.text IS NOT DISTINCT FROM b.text AND a.lang IS NOT DISTINCT FROM b.lang AND a.source IS NOT DISTINCT FROM b.source),
o AS (SELECT key, old_key, CASE WHEN changed = '' THEN 'same' ELSE 'update' END AS op, changed, text, lang, source FROM p
  UNION ALL SELECT key, old_key, op, '', text, lang, source FROM c)
SELECT key, old_key, op, changed,
  CASE WHEN op <> 'delete' THEN sha256(coalesce(text, '~') || chr(10) || coalesce(lang, '~') || chr(10) || coalesce(source, '~')) END AS row_sha256
FROM o
"""
