"""Cross-entropy difference: two n-gram models over one vocabulary, and the difference of their losses per document.

The target model is counted over the documents chosen by labels, the background model over all documents. Both are
interpolated bigram models with the same vocabulary and the same smoothing. differences() counts every word and every
pair of words of the corpus, in parts that grow in number with the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import U64, WordHashes, broadcast_if_small, mix, small_batches, words_of

UNIGRAM_SHARE = 0.4
SMOOTHING = 0.5


def _marked(docs: DataFrame, targets: DataFrame, broadcast_rows: int) -> DataFrame:
    """doc_id, text (binary), target (true for the target documents, else null) of every row of docs."""
    chosen = targets.select(F.col("doc_id").cast("long").alias("_id")).filter("_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    chosen = broadcast_if_small(chosen, broadcast_rows)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(chosen, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "target")


def _packed(x: np.ndarray) -> bytes:
    """An array byte plane by byte plane, compressed."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(x.size, x.itemsize).T).tobytes(), 1)


def _unpacked(b: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, raw.size // size).T).reshape(-1).view(kind)


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=U64(0)))


def _unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(b, U64), dtype=U64)


def _inner(sizes: np.ndarray) -> np.ndarray:
    """For all words of texts of these sizes, one after another: whether a word of the same text stands before."""
    inner = np.ones(sizes.sum(), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    return inner


def _pairs_of(vocabulary: np.ndarray, at: np.ndarray, inner: np.ndarray):
    """Distinct pairs of neighbours in order of their keys: first, second (places in the vocabulary), keys, and the place
    of the pair that ends at each word that has one before it."""
    code, place = np.unique(at[:-1][inner[1:]].astype(np.int64) * vocabulary.size + at[1:][inner[1:]], return_inverse=True)
    first, second = np.divmod(code, max(1, vocabulary.size))
    keys = mix(mix(vocabulary[first]) + vocabulary[second])
    order = np.argsort(keys, kind="stable")
    rank = np.empty(order.size, np.int64)
    rank[order] = np.arange(order.size)
    return first[order], second[order], keys[order], rank[place]


#: A block is a number of texts of one task. Its texts go on in one row, and its counts in one row for each part.
_BLOCK = "part int, block long, ids array<long>, sizes binary, at binary, vocabulary binary, words binary, word_counts binary, pairs binary, pair_counts binary"
_TOTALS = "block long, ids array<long>, sizes binary, at binary, vocabulary binary, part int, word_totals binary, pair_totals binary, stats array<long>"
_SCORES = "doc_id long, n_words long, target_loss double, background_loss double, score double"


def _bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in sorted keys, and their number."""
    edges = np.array([(p << 64) // parts for p in range(parts)], U64)
    return np.append(np.searchsorted(keys, edges), keys.size)


def _blocks(parts: int, block_words: int):
    """doc_id, text, target -> rows of _BLOCK."""
    types = {"part": pa.int32(), "block": pa.int64(), "ids": pa.list_(pa.int64())}
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    schema = pa.schema([(x, types.get(x, pa.binary())) for x in names])

    def made(ids: list, texts: list, marks: list, seed: int) -> Iterator[pa.RecordBatch]:
        sizes, h = np.array([x.size for x in texts], np.int64), np.concatenate(texts)
        #: Texts and counts of a block meet again by this number. It depends on the texts, so that a task that is run
        #: again over other texts makes other blocks.
        block = int(np.array(xxhash.xxh64_intdigest(h.tobytes() + sizes.tobytes(), seed), U64).view(np.int64))
        vocabulary, at = np.unique(h, return_inverse=True)
        target = np.repeat(np.array(marks, bool), sizes)
        inner = _inner(sizes)
        _, _, keys, place = _pairs_of(vocabulary, at, inner)
        words = np.bincount(at, minlength=vocabulary.size), np.bincount(at[target], minlength=vocabulary.size)
        pairs = np.bincount(place, minlength=keys.size), np.bincount(place[target[inner]], minlength=keys.size)
        row = dict.fromkeys(names) | {"block": block}
        rows = [row | {"part": block % parts, "ids": ids, "sizes": _packed(sizes), "at": _packed(at.astype(np.uint32)), "vocabulary": _packed_keys(vocabulary)}]
        w, p = _bounds(vocabulary, parts), _bounds(keys, parts)
        for k in range(parts if h.size else 0):
            a, b = slice(w[k], w[k + 1]), slice(p[k], p[k + 1])
            counts = [_packed(np.concatenate([n[s], t[s]]).astype(np.uint32)) for (n, t), s in ((words, a), (pairs, b))]
            rows.append(row | {"part": k, "words": _packed_keys(vocabulary[a]), "word_counts": counts[0], "pairs": _packed_keys(keys[b]), "pair_counts": counts[1]})
        for k in range(0, len(rows), 500):
            yield pa.RecordBatch.from_pylist(rows[k : k + 500], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes, seed = WordHashes(), TaskContext.get().partitionId() << 32
        ids, texts, marks, room = [], [], [], block_words
        for b in batches:
            for i, text, mark in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                h = hashes.of(words_of(text.as_py()))
                ids.append(i)
                texts.append(h)
                marks.append(bool(mark))
                room -= h.size + 1
                if room <= 0:
                    yield from made(ids, texts, marks, seed)
                    ids, texts, marks, room, seed = [], [], [], block_words, seed + 1
        if ids:
            yield from made(ids, texts, marks, seed)

    return run


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[int, np.ndarray, list[np.ndarray]]:
    """Distinct keys, the sum of all counts, and for the keys of each block their counts summed over all blocks."""
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    both = np.concatenate([x.reshape(2, -1) for x in counts], axis=1)
    sums = np.stack([np.bincount(at, weights=x, minlength=known.size) for x in both]).astype(np.int64)
    ends = np.cumsum([x.size for x in keys])
    return known.size, sums.sum(axis=1), np.split(sums[:, at], ends[:-1], axis=1)


def _totals(rows: pa.Table) -> pa.Table:
    """Rows of one part -> rows of _TOTALS: what each block counted, summed over all blocks."""
    whole = rows.filter(pa.compute.is_valid(rows["ids"]))
    counted = rows.filter(pa.compute.is_null(rows["ids"]))
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), *[(x, pa.binary()) for x in ("sizes", "at", "vocabulary")], ("part", pa.int32()), ("word_totals", pa.binary()), ("pair_totals", pa.binary()), ("stats", pa.list_(pa.int64()))])
    out = [dict.fromkeys(schema.names) | x for x in whole.select(["block", "ids", "sizes", "at", "vocabulary"]).to_pylist()]
    if counted.num_rows:
        read = lambda c, f: [f(x.as_py()) for x in counted[c]]
        count = lambda b: _unpacked(b, np.uint32)
        size, both, words = _summed(read("words", _unpacked_keys), read("word_counts", count))
        _, _, pairs = _summed(read("pairs", _unpacked_keys), read("pair_counts", count))
        for block, part, w, p in zip(counted["block"].to_pylist(), counted["part"].to_pylist(), words, pairs, strict=True):
            out.append(dict.fromkeys(schema.names) | {"block": block, "part": part, "word_totals": _packed(w.reshape(-1)), "pair_totals": _packed(p.reshape(-1)), "stats": [size, *both.tolist()]})
    return pa.Table.from_pylist(out, schema)


def _losses(parts: int):
    """Rows of one block -> rows of _SCORES."""

    def run(rows: pa.Table) -> pa.Table:
        whole = rows.filter(pa.compute.is_valid(rows["ids"])).to_pylist()
        counted = rows.filter(pa.compute.is_null(rows["ids"])).sort_by("part")
        sizes = _unpacked(whole[0]["sizes"], np.int64) if len(whole) == 1 else np.zeros(0, np.int64)
        if len(whole) != 1 or counted["part"].to_pylist() != list(range(parts if sizes.sum() else 0)):
            raise RuntimeError("a block has lost rows: its input was not the same when it was read again")
        losses = np.full((2, sizes.size), np.nan)
        if sizes.sum():
            at, vocabulary, inner = _unpacked(whole[0]["at"], np.uint32), _unpacked_keys(whole[0]["vocabulary"]), _inner(sizes)
            first, second, _, place = _pairs_of(vocabulary, at, inner)
            words, pairs = (np.concatenate([_unpacked(x.as_py(), np.int64).reshape(2, -1) for x in counted[c]], axis=1) for c in ("word_totals", "pair_totals"))
            size, *totals = np.array(counted["stats"].to_pylist()).sum(axis=0)
            starts = (np.cumsum(sizes) - sizes)[sizes > 0]
            #: The counts hold all documents, then the target ones; the target loss comes first.
            for m, k in ((0, 1), (1, 0)):
                one = (words[k] + SMOOTHING) / (totals[k] + SMOOTHING * (size + 1))
                context = words[k][first]
                two = np.divide(pairs[k], context, out=np.zeros(context.size), where=context > 0)
                share = np.where(context > 0, UNIGRAM_SHARE, 1.0)
                each = np.empty(at.size)
                each[~inner] = -np.log(one[at[~inner]])
                each[inner] = -np.log(share * one[second] + (1 - share) * two)[place]
                losses[m, sizes > 0] = np.add.reduceat(each, starts) / sizes[sizes > 0]
        t, g = losses
        none = sizes == 0
        return pa.table([pa.array(whole[0]["ids"], pa.int64()), pa.array(sizes), pa.array(t, mask=none), pa.array(g, mask=none), pa.array(t - g, mask=none)], names=[x.split()[0] for x in _SCORES.split(", ")])

    return run


def differences(docs: DataFrame, targets: DataFrame, block_words: int = 1 << 20, part_bytes: int = 8_000_000, broadcast_rows: int = 200_000) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score (target loss less background loss per word; lower is nearer
    the target) by models that count every word and every pair of words of docs. targets: doc_id of the target documents.

    A text without words (null, empty or blank) has n_words 0 and nulls, a null doc_id is no target. Repeated rows count
    and are scored each; an empty table gives no rows; other columns are not looked at, whatever their names.

    Words and pairs are known by 64-bit hashes. A task counts blocks of about block_words words; the counts of a block are
    dealt by hash to parts (one for each part_bytes of text), where they are summed over all blocks, and come back to the
    block's texts. No key has more than one row of a block in a part, and nothing but the bytes of text comes to the driver.
    Every block has a row in every part, which tells it the numbers of the whole corpus: rows grow with blocks times parts,
    so block_words and part_bytes are to be raised with the corpus, as far as a task's memory allows.
    """
    small_batches(docs.sparkSession)
    marked = _marked(docs, targets, broadcast_rows)
    parts = 1 + (docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0) // part_bytes
    blocks = marked.mapInArrow(_blocks(parts, block_words), _BLOCK)
    return blocks.groupBy("part").applyInArrow(_totals, _TOTALS).groupBy("block").applyInArrow(_losses(parts), _SCORES)
