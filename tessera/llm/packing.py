"""Packing documents into sequences by minimum bin slack.

Documents are cut at whole windows; what is left of each is one shorter piece. Only the number of pieces of each length
goes to the driver (at most ``capacity`` numbers). There every window takes the largest length left, and a bitset
subset-sum program picks the multiset of the remaining lengths that fills it closest to capacity; the backtracked counts
make a pattern, which is used as often as the lengths allow. Pieces find their pattern by their rank among equal lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, small_batches
from tessera.llm.tokens import in_groups, shared_tokenizer

Pattern = list[tuple[int, int]]


def fill(gap: int, counts: dict[int, int]) -> Pattern:
    """(length, times) whose sum is the largest up to gap; lengths are tried from the largest down."""
    lengths = sorted((x for x, n in counts.items() if n > 0 and x <= gap), reverse=True)
    limit, reach, levels = (1 << (gap + 1)) - 1, 1, []
    for x in lengths:
        before, left, step = reach, min(counts[x], gap // x), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (take * x)) & limit
            left, step = left - take, step * 2
        levels.append((x, before))
        if reach >> gap & 1:
            break
    total, out = reach.bit_length() - 1, []
    for x, before in reversed(levels):
        times = 0
        while not before >> total & 1:
            total -= x
            times += 1
        if times:
            out.append((x, times))
    return out[::-1]


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used, until no length is left."""
    left, out = {x: n for x, n in counts.items() if n > 0}, []
    while left:
        largest = max(left)
        left[largest] -= 1
        more = fill(capacity - largest, left)
        left[largest] += 1
        use = dict(more)
        use[largest] = use.get(largest, 0) + 1
        times = min(left[x] // k for x, k in use.items())
        out.append((sorted(use.items(), reverse=True), times))
        for x, k in use.items():
            left[x] -= k * times
            if not left[x]:
                del left[x]
    return out


class Places:
    """Where the piece of a length and rank goes: sequence_id and offset."""

    def __init__(self, found: list[tuple[Pattern, int]], capacity: int):
        rows, used, sequence = [], np.zeros(capacity + 1, np.int64), 0
        for pattern, times in found:
            offset = 0
            for x, k in pattern:
                rows.append((x, used[x], k, sequence, offset))
                used[x] += k * times
                offset += x * k
            sequence += times
        rows.sort()
        self.sequences = sequence
        self.length, self.rank, self.use, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T.copy()
        self.first = np.searchsorted(self.length, np.arange(capacity + 2))

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(length.size, np.int64)
        for x in np.unique(length):
            own = length == x
            low, high = self.first[x], self.first[x + 1]
            at[own] = low + np.searchsorted(self.rank[low:high], rank[own], side="right") - 1
        k = rank - self.rank[at]
        return self.sequence[at] + k // self.use[at], self.offset[at] + k % self.use[at] * length


def _cutter(path: str | None, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared_tokenizer(path)
        for b in batches:
            for ids, texts in in_groups(b.column(0).to_pylist(), [t.as_py() for t in b.column(1)]):
                rows: list[tuple] = []
                for doc, tokens in zip(ids, tokenizer.encode(texts), strict=True):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    for low in range(0, tokens.size, capacity):
                        part = tokens[low : low + capacity]
                        rows.append((doc, low, part.size, zlib.crc32(part.tobytes()), tokens.size))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def _placer(found: list[tuple[Pattern, int]], capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(found, capacity)
        for b in batches:
            if b.num_rows:
                sequence, offset = places.of(b.column("length").to_numpy(), b.column("rank").to_numpy())
                kept = [b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, capacity: int = 4096, end_id: int = 2, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and then end_id; a null or empty text is end_id alone. Every id lies in one piece, and every
    sequence holds its pieces without gaps from offset 0. Repeated rows, rows that share an id and rows with a null id
    are packed as separate documents. An empty table gives no rows. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    made = texts.mapInArrow(_cutter(tokenizer_path, capacity, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = cut(made.withColumn("part", F.spark_partition_id()))
    #: At most capacity rows for each partition; a frequent length is ranked inside partitions, then shifted.
    counts = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part", "length").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.row_number().over(inside) - 1 + F.col("base"))
    kept = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("rank").cast("long").alias("rank"))
    return kept.mapInArrow(_placer(patterns(totals, capacity), capacity), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
