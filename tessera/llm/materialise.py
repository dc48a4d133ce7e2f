"""Training-order materialisation of token ids into fixed-stride binary shards.

Texts become sequences of seq_len ids; a keyed Feistel permutation with cycle-walking gives every sequence a global slot,
so the order of training is a shuffle of the whole corpus that needs no sort key and no state. Equal ranges of slots are
shards; a shard's records have one size, so slot s is at byte (s - first slot) * stride of its shard.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import U64, constants, cut, mix, scratch, small_batches
from tessera.llm.tokens import in_groups, shared_tokenizer


class Permutation:
    """A keyed permutation of 0 .. size - 1: four Feistel rounds over the next even power of two, walked into range."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = U64(max(1, ((max(size - 1, 1)).bit_length() + 1) // 2))
        self.mask = U64((1 << int(self.half)) - 1)
        self.keys = constants(4, key)

    def _rounds(self, x: np.ndarray, keys: list, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (mix(left * U64(0x9E3779B97F4A7C15) + k) & self.mask), left
            else:
                left, right = right, left ^ (mix(right * U64(0x9E3779B97F4A7C15) + k) & self.mask)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        keys = list(self.keys[::-1] if back else self.keys)
        x = self._rounds(x.astype(U64), keys, back)
        while (out := x >= U64(self.size)).any():
            x[out] = self._rounds(x[out], keys, back)
        return x.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(sequences, False) if len(sequences) else sequences

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True) if len(slots) else slots


def stride(seq_len: int) -> int:
    """A record: its number of ids (unsigned 32 bits), seq_len unsigned 16-bit ids, all little-endian, and a line feed."""
    return 4 + 2 * seq_len + 1


def _sequencer(path: str | None, seq_len: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = shared_tokenizer(path), zstandard.ZstdCompressor(level=3)
        held, n, place = [], 0, 0
        if tokenizer.ends.size > 1 << 16:
            raise ValueError("the tokenizer's ids do not fit 16 bits")

        def record(ids: np.ndarray) -> bytes:
            full = np.zeros(seq_len, "<u2")
            full[: ids.size] = ids
            return packer.compress(np.uint32(ids.size).astype("<u4").tobytes() + full.tobytes())

        for b in batches:
            texts = [t.as_py() for t in b.column(0)]
            for _, part in in_groups(texts, texts):
                for ids in tokenizer.encode(part):
                    held += [ids, np.array([end_id], np.uint32)]
                    n += ids.size + 1
                if n >= seq_len:
                    flat = np.concatenate(held)
                    full = flat.size // seq_len
                    rows = [record(flat[k * seq_len : (k + 1) * seq_len]) for k in range(full)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(place, place + full)), pa.array(rows, pa.binary())], ["place", "record"])
                    held, n, place = [flat[full * seq_len :]], flat.size - full * seq_len, place + full
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([record(np.concatenate(held))], pa.binary())], ["place", "record"])

    return run


def _slotter(size: int, key: int, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Permutation(size, key)
        for b in batches:
            slot = order.slots(b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((slot // per_shard).astype(np.int32)), b.column(1)], ["slot", "shard", "record"])

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([unpacker.decompress(r.as_py()) for r in b.column(0)], pa.binary())], ["value"])


def write_shards(docs: DataFrame, path: str, key: int = 1, seq_len: int = 2048, per_shard: int = 4096, end_id: int = 2, tokenizer_path: str | None = None, text_col: str = "text") -> int:
    """Write all texts as shards into the folder path and return the number of sequences.

    Texts are laid one after another within an input partition, each closed by end_id; a null or empty text is end_id
    alone. Only the last sequence of a partition is short; it is padded with 0 and carries its number of ids. Shard k is
    the file part-0000k and holds the slots from k * per_shard in order. An empty table writes no record. Repeated rows
    are written as often as they occur; other columns are not looked at.
    """
    small_batches(docs.sparkSession, 1000)
    made = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(_sequencer(tokenizer_path, seq_len, end_id), "place long, record binary")
    #: The checkpoint fixes which partition a sequence belongs to.
    sequences = cut(made.withColumn("part", F.spark_partition_id()))
    counts = sequences.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per partition
    base, total = {}, 0
    for r in counts:
        base[r["part"]], total = total, total + r["n"]
    if not total:
        return 0
    starts = docs.sparkSession.createDataFrame(list(base.items()), "part int, base long")
    numbered = sequences.join(F.broadcast(starts), "part").select((F.col("base") + F.col("place")).alias("sequence_id"), "record")
    placed = numbered.mapInArrow(_slotter(total, key, per_shard), "slot long, shard int, record binary")
    shards = -(-total // per_shard)
    ordered = placed.repartitionById(shards, "shard").sortWithinPartitions("slot").select("record").mapInArrow(_unpack, "value binary")
    ordered.select(F.col("value").cast("string").alias("value")).write.text(path)
    return total


def shard_number(path: str) -> int:
    """The number in a shard's name, which has five digits up to 99999 and as many as it needs beyond."""
    found = re.search(r"part-(\d+)[^/]*$", path)
    if not found:
        raise ValueError(f"{path} is no shard")
    return int(found[1])


def _records(seq_len: int, per_shard: int, low: int, high: int | None, order: tuple[int, int] | None = None):
    """path, content -> slot, n_tokens and ids; with order (size, key) the sequence's number before slot and a CRC-32 in
    place of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = stride(seq_len)
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = np.frombuffer(data.as_buffer(), np.uint8)
                if raw.size % step:
                    raise ValueError(f"{name} is not a whole number of records")
                first = shard_number(name) * per_shard
                records = raw.reshape(-1, step)
                keep = range(max(0, low - first), len(records) if high is None else max(0, min(len(records), high - first)))
                for at in range(keep.start, keep.stop, 512):
                    part = records[at : min(at + 512, keep.stop)]
                    n = part[:, :4].copy().view("<u4").ravel().astype(np.int64)
                    ids = part[:, 4:-1].copy().view("<u2")
                    slot, texts = first + at + np.arange(len(part)), [ids[k, : n[k]].tobytes() for k in range(len(part))]
                    if order is None:
                        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n), pa.array(texts, pa.binary())], ["slot", "n_tokens", "ids"])
                    else:
                        yield pa.RecordBatch.from_arrays([pa.array(Permutation(*order).sequences(slot)), pa.array(slot), pa.array(n), pa.array([zlib.crc32(t) for t in texts], pa.int64())], ["sequence_id", "slot", "n_tokens", "ids_crc32"])

    return run


def read_shards(spark: SparkSession, path: str, seq_len: int = 2048, per_shard: int = 4096, start: int = 0, stop: int | None = None) -> DataFrame:
    """slot, n_tokens, ids (little-endian unsigned 16-bit) of the slots from start up to stop: a job resumes at any slot,
    and only the shards that hold such slots are opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    inside = (number + 1) * per_shard > start
    if stop is not None:
        inside &= number * per_shard < stop
    wanted = files.select("path").filter(inside)
    if start or stop is not None:
        found = sorted(r["path"] for r in wanted.collect())  # a row per shard file
        if not found:
            return spark.createDataFrame([], "slot long, n_tokens long, ids binary")
        files = spark.read.format("binaryFile").load(found)
    return files.select("path", "content").mapInArrow(_records(seq_len, per_shard, start, stop), "slot long, n_tokens long, ids binary")


def materialise(docs: DataFrame, key: int = 1, seq_len: int = 2048, per_shard: int = 4096) -> DataFrame:
    """Write docs as shards in the shared folder and read them back: sequence_id, slot, n_tokens, ids_crc32, shard.

    Sequences follow the input's partitions: the same files read with other split sizes give other sequences, the same
    permutation of them. The folder stays until the program ends (the frame reads it)."""
    path = scratch(docs.sparkSession, "shards")
    total = write_shards(docs, path, key, seq_len, per_shard)
    if not total:
        return docs.sparkSession.createDataFrame([], "sequence_id long, slot long, n_tokens long, ids_crc32 long, shard long")
    files = docs.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    found = files.mapInArrow(_records(seq_len, per_shard, 0, None, (total, key)), "sequence_id long, slot long, n_tokens long, ids_crc32 long")
    return found.withColumn("shard", F.floor(F.col("slot") / per_shard))
