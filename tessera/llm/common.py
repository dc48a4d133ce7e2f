"""Helpers shared by the corpus operators: word hashing, batches; folders and checkpoints are those of the library."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import SparkSession

from tessera.space import broadcast_if_small, cut, drop, scratch, shared_dir

__all__ = ["broadcast_if_small", "cut", "drop", "scratch", "shared_dir"]

#: Word classes of the operator contracts, as Java and RE2 patterns.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the rows of one Arrow batch, so that a batch of long texts fits a Python worker.

    A smaller value already set by the user stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x = x ^ (x >> U64(27))
    x = x * _M2
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


class WordHashes(dict):
    """64-bit hashes of words, kept for the words seen lately; the size is bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text after lower-casing A-Z: bytes.split() splits at x20 and x09-x0D."""
    return text.lower().split() if text else []
