"""Byte-level BPE ids of whole texts by a local rank file, and the bytes of ids.

The tiktoken library encodes; it is handed texts of bounded length, as its pattern's look-ahead fails on very long runs of
white space. A long text is parted at boundaries that no match of the pattern crosses, so the ids stay those of the whole.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches
from tessera.llm.tokens import in_groups

RANKS = "byte_bpe_multi_50k.tiktoken"

#: Places that no match of the pattern crosses, wherever the text around is cut: before white space after other characters,
#: before the last white space of a run that ends in other characters, and where letters, digits and signs meet (an
#: apostrophe may begin a match that goes on with a letter).
SAFE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\s)(?=\s\S)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])|(?<=')(?=\p{N})"
)
BLANK = regex.compile(r"\s+")


def pieces(text: str, limit: int) -> Iterator[tuple[str, bool]]:
    """Parts of a text, cut at the first safe place after limit characters; true marks white space of more than limit
    characters that is one match. A run of one class longer than limit stays whole: it is one match."""
    start = 0
    while len(text) - start > limit:
        found = SAFE.search(text, start + limit)
        stop = found.start() if found else len(text)
        #: White space before start + limit may reach far back or on: its run is given out by itself.
        for run in BLANK.finditer(text, start, stop) if stop - start > 2 * limit else ():
            if run.end() - run.start() > limit:
                last = run.end() if run.end() == stop else run.end() - 1
                if start < run.start():
                    yield text[start : run.start()], False
                yield text[run.start() : last], True
                start = last
        if start < stop:
            yield text[start:stop], False
        start = stop
    if start < len(text):
        yield text[start:], False


class ByteBpe:
    """Ids of texts and bytes of ids by the ranks of one file."""

    def __init__(self, path: str | None = None, pattern: str | None = None, limit: int = 100_000):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(RANKS), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.limit = limit
        self.encoding = tiktoken.Encoding("local", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        #: For a long run of white space, which is one match whatever its length.
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes | None) -> np.ndarray:
        """Ids of a UTF-8 text, unsigned 32-bit; bytes that are no UTF-8 count as the replacement character."""
        chars = (text or b"").decode("utf-8", "replace")
        if len(chars) <= self.limit:
            return self.encoding.encode_to_numpy(chars).astype("<u4")
        parts = [(self.whole if blank else self.encoding).encode_to_numpy(p) for p, blank in pieces(chars, self.limit)]
        return np.concatenate(parts).astype("<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def shared_bpe(path: str | None = None, pattern: str | None = None) -> ByteBpe:
    """The encoder of this Python process, which a worker that is used again keeps from task to task."""
    kept = sys.modules.setdefault("_tessera_kept", types.ModuleType("_tessera_kept"))
    found = kept.__dict__.setdefault("byte_bpe", {})
    if (path, pattern) not in found:
        found[path, pattern] = ByteBpe(path, pattern)
    return found[path, pattern]


def _encoder(path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_bpe(path, pattern)
        for b in batches:
            for ids, texts in in_groups(b.column(0).to_pylist(), [t.as_py() for t in b.column(1)]):
                found = [bpe.encode(t) for t in texts]
                columns = [pa.array(ids, pa.int64()), pa.array([x.size for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    return run


def _decoder(path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_bpe(path, pattern)
        for b in batches:
            texts = [bpe.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in b.column("ids")]
            yield b.append_column("decoded", pa.array(texts, pa.binary()))

    return run


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens and ids (little-endian unsigned 32-bit), without special tokens: strings
    that other files reserve are ordinary text here.

    A null or empty text has no ids. Repeated rows and rows with a null id are encoded as they are. An empty table gives no
    rows; other columns are not looked at. One text at a time is encoded, whatever its length. The rank file is read on
    the executors: ranks_path is a path there, by default that of the installed public file.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(_encoder(ranks_path, pattern), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The rows of encode and decoded, the bytes that the ids stand for, which need not be UTF-8 for ids cut anywhere. Null
    ids give no bytes; an id that the file does not hold raises KeyError."""
    small_batches(encoded.sparkSession)
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(_decoder(ranks_path, pattern), "doc_id long, n_tokens long, ids binary, decoded binary")


def report(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Encode and decode: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    there_and_back = decode(encode(docs, ranks_path), ranks_path)
    return there_and_back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
