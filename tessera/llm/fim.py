"""Fill-in-middle: a text is cut at two token boundaries and its pieces change places behind markers.

A text is decoded to an array of code points. Where two neighbours are not both ASCII letters a token begins, so the
boundaries are the places at which a comparison of neighbouring classes is true; two of them, chosen by a hash of the
document's id, part prefix, middle and suffix, which are slices of the array and are encoded again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches
from tessera.llm.tokens import in_groups

#: Markers of prefix, suffix and middle; a text that holds one is left as it is, so that every output can be undone.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

FIELDS = "doc_id long, n long, form string, start long, stop long, prefix_chars long, middle_chars long, output binary"


def code_points(text: bytes) -> np.ndarray:
    """The code points of a UTF-8 text; bytes that are no UTF-8 stand as lone surrogates, so that nothing is lost."""
    return np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")


def encoded(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def boundaries(points: np.ndarray) -> np.ndarray:
    """Where tokens begin, and the end of the text: runs of ASCII letters are tokens, any other code point is one."""
    letter = ((points | 32) - np.uint32(97)) < 26
    inside = letter[1:] & letter[:-1]
    begins = np.flatnonzero(~inside) + 1
    return np.concatenate([np.zeros(min(points.size, 1), np.int64), begins, [points.size]])


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document: the first digits of the SHA-256 of seed and id; a null id stands as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return np.frombuffer(digest[:16], ">u4").tolist()


def rearranged(doc_id: int | None, text: bytes, seed: int, percent: int, spm_percent: int) -> tuple:
    """n, form, start and stop (units before the middle and up to its end), their code points and the output."""
    points = code_points(text)
    at = boundaries(points)
    n = at.size - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= percent:
        return n, "plain", None, None, None, None, text
    start, stop = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = int(at[start]), int(at[stop])
    prefix, middle, suffix = (encoded(p) for p in (points[:low], points[low:high], points[high:]))
    form = "spm" if h4 % 100 < spm_percent else "psm"
    pieces = [SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle] if form == "spm" else [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]
    return n, form, start, stop, low, high - low, b"".join(pieces)


def _rearranger(seed: int, percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for b in batches:
            for ids, texts in in_groups(b.column(0).to_pylist(), [t.as_py() for t in b.column(1)]):
                rows = [(i, *rearranged(i, t or b"", seed, percent, spm_percent)) for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n (tokens), form, start and stop (tokens before the middle and up to its end),
    prefix_chars, middle_chars (code points) and output (UTF-8).

    form is plain for an empty text, one that holds a marker, and 100 - percent of the rest: output is the text, and start,
    stop and both lengths are null. spm_percent of the others put the suffix first. A null text counts as empty. Rows with
    one id, repeats included, draw alike; a null id draws as an id of its own. Bytes that are no UTF-8 come through
    unchanged. An empty table gives no rows; other columns are not looked at. One text is in memory at once, four bytes a
    code point, with its output.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(_rearranger(seed, percent, spm_percent), FIELDS)


def rebuilt(output: bytes, form: str) -> bytes:
    """The text that an output was made of. No piece holds a marker and no marker can begin inside another, so the first
    ones found part the pieces. Raises ValueError where a marker is missing."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at, end = output.index(second, len(first)), output.index(MIDDLE)
    one, other, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + other if form == "psm" else other + middle + one


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [rebuilt(o.as_py(), f.as_py()) for o, f in zip(b.column("output"), b.column("form"), strict=True)]
        yield b.append_column("restored", pa.array(texts, pa.binary()))


def restore(made: DataFrame) -> DataFrame:
    """The rows of fill_in_middle and restored, the bytes of the text, from output and form alone."""
    return made.mapInArrow(_rebuild, f"{FIELDS}, restored binary")


def report(docs: DataFrame, seed: int = 1) -> DataFrame:
    """fill_in_middle with SHA-256 of the output and of the text restored from it: doc_id, n, form, prefix_chars,
    middle_chars, output_sha256, restored_sha256."""
    return restore(fill_in_middle(docs, seed)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


_TEXT = "coalesce(text, '')"
_JOIN = "array_to_string(list_slice(t, {}, {}), '')"
#: The same rows; tokens are matched by a regular expression and pieces joined from them.
SQL = rf"""
WITH a AS (SELECT doc_id, {_TEXT} AS text, sha256('1:' || doc_id::VARCHAR) AS h, regexp_extract_all({_TEXT}, '[A-Za-z]+|[^A-Za-z]') AS t FROM documents),
b AS (SELECT doc_id, text, t, len(t) AS n, [('0x' || h[8 * k + 1 : 8 * k + 8])::BIGINT FOR k IN range(4)] AS h FROM a),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS lo, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS hi,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM b),
d AS (SELECT *, {_JOIN.format("1", "lo")} AS prefix, {_JOIN.format("lo + 1", "hi")} AS middle, {_JOIN.format("hi + 1", "n")} AS suffix FROM c)
SELECT doc_id::BIGINT AS doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM d
"""
