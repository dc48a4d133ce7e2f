"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of passage_words words. Every passage is encoded, gated attention weights the passages,
and a logistic layer scores the weighted representation. Encoder, gate and layer are learnt together from the labels of
documents alone, on a bounded sample of labelled documents; scoring reads every passage of every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_batches

#: What a word shows; each passage has their means, followed by FROM_ORDER.
WORD_TRAITS = 14
#: Shares of words equal to the word 1, 2, 3, 4, 8 places before; of distinct words; filling; whether it is empty.
FROM_ORDER = 8
LAGS = (1, 2, 3, 4, 8)
TRAITS = WORD_TRAITS + FROM_ORDER
_SYMBOLS = re.compile(rb"[#*$%&|<>@~^=_{}\[\]\\/]")
_PUNCT = re.compile(rb"[.,;:!?]")


def word_traits(word: bytes) -> tuple[float, ...]:
    text = word.decode("utf-8", "replace")
    n = max(1, len(text))
    letters = sum(map(str.isalpha, text))
    symbols = len(_SYMBOLS.findall(word))
    return (
        min(n, 24) / 8,
        letters / n,
        float(text.isupper() and letters > 1),
        float(text[:1].isupper()),
        float(any(map(str.isdigit, text))),
        min(symbols, 4) / 2,
        float(letters == 0),
        float(symbols > 1),
        float(text.endswith(("!", "?"))),
        float(text.endswith("!!")),
        float(text.endswith((".", "!", "?"))),
        float(text.endswith((",", ";", ":"))),
        float(n > 16),
        float(n <= 3 and letters == n),
    )


class Passages:
    """Trait vectors of the passages of texts; traits of words seen lately are kept, in bounded memory."""

    def __init__(self, passage_words: int, limit: int = 200_000):
        self.passage_words, self.limit = passage_words, limit
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.table = np.zeros((self.limit + 1, WORD_TRAITS), np.float32)

    def _coded(self, words: list[bytes]) -> np.ndarray:
        codes = self.codes
        new = {w for w in words if w not in codes}
        if new:
            for w in sorted(new):
                codes[w] = k = len(codes)
                if k >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[k] = word_traits(w)
        return np.fromiter(map(codes.__getitem__, words), np.int64, len(words))

    def of(self, text: bytes | None) -> np.ndarray:
        """(passages, TRAITS); a text without words is one empty passage."""
        words = text.split() if text else []
        if not words:
            out = np.zeros((1, TRAITS), np.float32)
            out[0, -1] = 1
            return out
        if len(self.codes) > self.limit:
            self._clear()
        code = self._coded(words)
        at = np.arange(0, len(words), self.passage_words)
        size = np.diff(np.append(at, len(words))).astype(np.float32)
        out = np.zeros((at.size, TRAITS), np.float32)
        out[:, :WORD_TRAITS] = np.add.reduceat(self.table[code], at, axis=0) / size[:, None]
        for k, lag in enumerate(LAGS):
            same = np.zeros(len(words), np.float32)
            same[lag:] = code[lag:] == code[:-lag]
            out[:, WORD_TRAITS + k] = np.add.reduceat(same, at) / size
        row = np.arange(len(words)) // self.passage_words
        order = np.lexsort((code, row))
        fresh = np.ones(len(words), np.float32)
        fresh[1:] = (code[order][1:] != code[order][:-1]) | (row[order][1:] != row[order][:-1])
        out[:, WORD_TRAITS + 5] = np.add.reduceat(fresh, at) / size
        out[:, WORD_TRAITS + 6] = size / self.passage_words
        return out


@dataclass
class Model:
    """Weights of the encoder (e), the gated attention (v, u, w) and the logistic layer (o); mean and scale of traits."""

    passage_words: int
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None
    prior: float

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bags), self.prior)
        x = (np.concatenate(bags) - self.mean) / self.scale
        return _forward(self.weights, x, np.array([len(b) for b in bags]))[0]


def _forward(p: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray) -> tuple:
    at = np.cumsum(size) - size
    h = np.tanh(x @ p["e"] + p["eb"])
    t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
    a = (t * g) @ p["w"]
    a = np.exp(a - np.repeat(np.maximum.reduceat(a, at), size))
    a = a / np.repeat(np.add.reduceat(a, at), size)
    z = np.add.reduceat(h * a[:, None], at)
    score = 1 / (1 + np.exp(-(z @ p["o"] + p["ob"][0])))
    return score, h, t, g, a, z, at


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    score, h, t, g, a, z, at = _forward(p, x, size)
    d = (score - y) * weight / weight.sum()
    grad = {"o": z.T @ d, "ob": np.array([d.sum()])}
    dz = np.repeat(d, size)[:, None] * p["o"][None, :]
    da = (dz * h).sum(axis=1)
    da = a * (da - np.repeat(np.add.reduceat(a * da, at), size))
    grad["w"] = (t * g).T @ da
    dg = da[:, None] * p["w"][None, :]
    dt, dg = dg * g * (1 - t * t), dg * t * g * (1 - g)
    grad["v"], grad["u"] = h.T @ dt, h.T @ dg
    dh = (dz * a[:, None] + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
    grad["e"], grad["eb"] = x.T @ dh, dh.sum(axis=0)
    return grad


def fit(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, passage_words: int, hidden: int = 16, gate: int = 8, steps: int = 600, batch: int = 256, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    """Adam over mini-batches of documents. Without both labels the score is the share of label 1 (0.5 without labels)."""
    prior = float((y * weight).sum() / weight.sum()) if len(y) else 0.5
    if len(set(y.tolist())) < 2:
        return Model(passage_words, np.zeros(TRAITS), np.ones(TRAITS), None, prior)
    flat = np.concatenate(bags).astype(np.float64)
    mean, scale = flat.mean(axis=0), np.maximum(flat.std(axis=0), 0.05)
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, TRAITS**-0.5, (TRAITS, hidden)), "eb": np.zeros(hidden), "v": rng.normal(0, hidden**-0.5, (hidden, gate)), "u": rng.normal(0, hidden**-0.5, (hidden, gate)), "w": rng.normal(0, gate**-0.5, gate), "o": rng.normal(0, hidden**-0.5, hidden), "ob": np.zeros(1)}
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    for step in range(1, steps + 1):
        pick = rng.choice(len(bags), min(batch, len(bags)), replace=False)
        x = (np.concatenate([bags[i] for i in pick]) - mean) / scale
        grad = _gradients(p, x, np.array([len(bags[i]) for i in pick]), y[pick], weight[pick])
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            g = grad[k] + (decay * p[k] if p[k].ndim else 0)
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - speed * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(passage_words, mean, scale, p, prior)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text has the remainder 1 by 3; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 2500, passage_words: int = 64, fit_passages: int = 256) -> Model:
    """Fit on at most per_class documents of each label, the first by a hash of their id, held-out ones left out, and on at
    most fit_passages passages of each, evenly spread over its text; scoring reads all of them.

    The classes are weighted by their share of all labels. Rows with a null id or label, and labels without a document,
    take no part; a document with both labels counts for each, and one that is labelled alike twice counts once. Of rows
    that share an id the text with the smallest hash counts.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(~held_out())
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    first = None
    for value in (0, 1):
        part = known.filter(F.col("y") == value).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(per_class)
        first = part if first is None else first.union(part)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(F.broadcast(first.distinct()), "doc_id")
    #: Traits of passages, not texts, are shuffled; one row is left for each id and label, so at most 2 * per_class rows of at
    #: most fit_passages passages reach the driver, whatever the input.
    made = own.select("doc_id", "y", "text").mapInArrow(_encode(passage_words, fit_passages), "doc_id long, y int, text binary")
    rows = made.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], r["text"]))
    bags = [np.frombuffer(r["text"], np.float32).reshape(-1, TRAITS) for r in rows]
    y = np.array([r["y"] for r in rows], np.float64)
    per = {value: share[value] / max(1, int((y == value).sum())) for value in share}
    return fit(bags, y, np.array([per[int(v)] for v in y]), passage_words)


def _spread(bag: np.ndarray, most: int) -> np.ndarray:
    """At most so many rows, evenly spread."""
    return bag if len(bag) <= most else bag[np.linspace(0, len(bag) - 1, most).astype(np.int64)]


def _encode(passage_words: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(passage_words)
        for b in batches:
            bags = pa.array([_spread(passages.of(t.as_py()), most).tobytes() for t in b.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), bags], ["doc_id", "y", "text"])

    return run


def _scorer(model: Model, at: int):
    """Replaces the column at by the score of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(model.passage_words)
        for b in batches:
            scores, bags, n = [], [], 0
            for text in b.column(at):
                bags.append(passages.of(text.as_py()))
                n += len(bags[-1])
                if n >= 4096:
                    scores.append(model.scores(bags))
                    bags, n = [], 0
            if bags:
                scores.append(model.scores(bags))
            score = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            names = [*b.schema.names[:at], "score", *b.schema.names[at + 1 :]]
            yield pa.RecordBatch.from_arrays([score if k == at else c for k, c in enumerate(b.columns)], names)

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5) of every row.

    The text alone is looked at. A null, empty or blank text is one empty passage. Repeated rows are scored alike.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = rows.mapInArrow(_scorer(model, 1), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose score is at least the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)], F.col("text").cast("binary").alias("_text"))
    schema = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True)) + ", score double"
    kept = plain.mapInArrow(_scorer(model, len(names)), schema).filter(F.col("score") >= threshold)
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
