"""Connected components of an edge table: every task contracts its own edges, and alternating large-star and small-star rounds
join what tasks hold apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut


def _stars(edges: DataFrame) -> DataFrame:
    """Each row (u, v) with m, the smallest of u and all its v.

    The join's key is not the aggregate's, so both sides are dealt anew and Spark can split the rows of a node with very
    many edges.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.bitwise_not("u").alias("k"), F.least("u", "m").alias("m"))
    return edges.withColumn("k", F.bitwise_not("u")).join(least, "k").select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _stars(down)
    return (
        stars.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(stars.select("u", F.col("m").alias("v")))
        .filter("u != v")
        .distinct()
    )


def labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node that each can reach over them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: u.size], at[u.size :]
    label = np.arange(nodes.size)
    while a.size:
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[label]


def _contracted(most: int):
    """u, v -> a star for each component of a task's edges, in pieces of at most so many edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def stars() -> tuple[np.ndarray, np.ndarray]:
            nodes, label = labels(*(np.concatenate(x) for x in zip(*held, strict=True)))
            far = nodes != label
            return nodes[far], label[far]

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            n += batch.num_rows
            if n >= 2 * most:  # what is contracted is small again, unless the edges are a forest already
                held = [stars()]
                n = held[0][0].size
                if n >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["u", "v"])
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars()], ["u", "v"])

    return run


def connected_components(edges: DataFrame, rounds: int = 60, task_edges: int = 1_000_000) -> DataFrame:
    """Label every node of an edge table with the smallest node it can reach.

    edges: columns u and v (long). Loops and repeated edges are harmless; rows with a null take no part.
    Returns node, component for nodes that have an edge to another node; an empty table gives an empty result.
    Tasks contract the edges that they hold, and as many partitions as task_edges allows are put together without a
    shuffle; where one task holds all, that is the answer. Else every round is a fixed number of shuffles of the edges and
    ends in a reliable checkpoint; the number of rounds grows with the logarithm of the number of nodes. Raises
    RuntimeError if the rounds do not suffice.
    """
    plain = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    contract = lambda df: cut(df.mapInArrow(_contracted(task_edges), "u long, v long"))
    now, before, parts = contract(plain), None, 0
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        fewer = -(-mark[0] // task_edges)
        if fewer and (not parts or fewer < parts):
            parts = fewer
            now = contract(now.coalesce(parts))
            if parts > 1:
                mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0] or parts == 1:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = mark
        now, parts = cut(_small(_large(now))), 0
    raise RuntimeError("the components did not settle; raise rounds")
