"""Approximate nearest neighbours by inner product over robust-pruned directed graphs, one graph per shard.

Every shard of at most shard_rows vectors gets a directed graph: greedy searches from an entry point propose neighbours,
and relaxed distance pruning keeps diverse edges. A query walks every shard's graph with a beam, and the shards' best are
merged. Inner product becomes Euclidean distance by one added coordinate per shard, sqrt(M^2 - |x|^2).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut


def _far(x: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances from rows at (b, d) to x[ids] (b, r); ids below 0 are infinitely far."""
    d = x[ids] - at[:, None, :]
    out = np.einsum("brd,brd->br", d, d)
    out[ids < 0] = np.inf
    return out


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, at: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The beam (ids, squared distances, nearest first, -1 where there are fewer) of every row of at, from all entries."""
    b, n = len(at), len(x)
    rows = np.arange(b)[:, None]
    seen = np.zeros((b, n + 1), bool)
    ids = np.full((b, beam), -1)
    entries = entries[:beam]
    ids[:, : entries.size] = entries
    seen[:, entries] = seen[:, n] = True
    dist = _far(x, at, ids)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = ids[rows, order], dist[rows, order]
    done = ids < 0
    while True:
        open_ = np.where(done, np.inf, dist)
        pick = np.argpartition(open_, min(width, beam - 1), axis=1)[:, :width] if beam > width else np.broadcast_to(np.arange(beam), (b, beam))
        go = ~done[rows, pick]
        if not go.any():
            return ids, dist
        np.put_along_axis(done, pick, True, 1)
        new = graph[np.where(go, ids[rows, pick], -1)].reshape(b, -1)
        new[np.repeat(~go, graph.shape[1], axis=1)] = -1
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[rows, new]] = -1
        seen[rows, new] = True
        all_ids = np.concatenate([ids, new], axis=1)
        all_dist = np.concatenate([dist, _far(x, at, new)], axis=1)
        all_done = np.concatenate([done, new < 0], axis=1)
        keep = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids, dist, done = all_ids[rows, keep], all_dist[rows, keep], all_done[rows, keep]


def robust_prune(x: np.ndarray, at: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Of candidates cand (b, c; -1: none) keep at most degree for each point at: the nearest left is kept, and all that
    lie alpha times nearer to it than to the point go."""
    cand = np.sort(cand, axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == at[:, None]] = -1
    dist = _far(x, x[at], cand)
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    alive = cand >= 0
    out = np.full((len(at), degree), -1)
    one = np.arange(len(at))
    vectors = x[cand]
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[one, first]
        if not some.any():
            break
        out[some, k] = cand[one, first][some]
        d = vectors - vectors[one, first][:, None, :]
        alive &= ~((alpha * alpha) * np.einsum("bcd,bcd->bc", d, d) <= dist)
        alive[one, first] = False
        alive[~some] = False
    return out


def build_graph(x: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, step: int = 512, seed: int = 7, starts: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """The out-edges (n, degree + 1; -1: none) of a robust-pruned graph and its entry points: the vector nearest the mean
    and random ones, so that a search is not caught outside a far group. The last edge is for nodes that no path reached."""
    n = len(x)
    rng = np.random.default_rng(seed)
    entry = int(_far(x, x.mean(axis=0, keepdims=True), np.arange(n)[None, :])[0].argmin())
    graph = np.full((n, degree), -1)
    order = rng.permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    entries = order[: min(starts, beam)].copy()
    for relax in (1.0, alpha):
        size, low = (1, 1) if relax == 1.0 else (step, 0)
        while low < n:
            part = order[low : low + size]
            cand, _ = beam_search(x, graph, entries, x[part], beam)
            graph[part] = robust_prune(x, part, np.concatenate([cand, graph[part]], axis=1), degree, relax)
            _add_back(x, graph, part, degree, relax)
            low += size
            size = min(step, 2 * size)
    return _connected(x, graph, entries, beam), entries


def _connected(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, beam: int) -> np.ndarray:
    """The graph with one more edge a node; it leads to nodes that no path from the entries reaches, from near ones."""
    graph = np.concatenate([graph, np.full((len(x), 1), -1)], axis=1)
    reached = np.zeros(len(x) + 1, bool)
    reached[-1] = True

    def walk(front: np.ndarray) -> None:
        while front.size:
            reached[front] = True
            front = np.unique(graph[front])
            front = front[~reached[front]]

    walk(entries)
    while not reached.all():
        lost = int(np.flatnonzero(~reached)[0])
        near, _ = beam_search(x, graph, entries, x[[lost]], beam)
        free = [k for k in near[0] if k >= 0 and graph[k, -1] < 0] or np.flatnonzero(reached[:-1] & (graph[:, -1] < 0)).tolist()
        graph[free[0], -1] = lost
        walk(np.array([lost]))
    return graph


def _add_back(x: np.ndarray, graph: np.ndarray, part: np.ndarray, degree: int, relax: float) -> None:
    to, back = graph[part].ravel(), np.repeat(part, degree)
    back, to = back[to >= 0], to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    node, start, count = np.unique(to, return_index=True, return_counts=True)
    #: The entry of a small graph can get many back edges at once; they are taken in rounds of degree.
    for low in range(0, int(count.max(initial=0)), degree):
        more = np.full((node.size, degree), -1)
        k = np.arange(to.size) - np.repeat(start, count)
        use = (k >= low) & (k < low + degree)
        more[np.repeat(np.arange(node.size), count)[use], k[use] - low] = back[use]
        both = np.concatenate([graph[node], more], axis=1)
        both_sorted = np.sort(both, axis=1)[:, ::-1]
        both_sorted[:, 1:][both_sorted[:, 1:] == both_sorted[:, :-1]] = -1
        fits = (both_sorted >= 0).sum(axis=1) <= degree
        packed = np.sort(both_sorted, axis=1)[:, ::-1][:, :degree]
        graph[node[fits]] = packed[fits]
        if not fits.all():
            graph[node[~fits]] = robust_prune(x, node[~fits], both_sorted[~fits], degree, relax)


def _augmented(x: np.ndarray) -> np.ndarray:
    """The vectors in single precision, scaled so that the longest has the length 1, with the added coordinate."""
    x = x.astype(np.float64)
    x = x / max(np.abs(x).max(initial=0), np.finfo(np.float64).tiny)
    norm = (x**2).sum(axis=1)
    longest = np.sqrt(norm.max(initial=0)) or 1.0
    x, norm = x / longest, norm / longest**2
    return np.concatenate([x, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)


def _index_shard(degree: int, beam: int, alpha: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        ids = rows["vec_id"].to_numpy()
        #: Equal vectors are one node, with all their ids.
        unique, inverse = np.unique(x, axis=0, return_inverse=True)
        inverse = inverse.ravel()
        graph, entries = build_graph(_augmented(unique), degree, beam, alpha)
        order = np.argsort(inverse, kind="stable")
        return pd.DataFrame({"dim": [x.shape[1]], "shard": [rows["shard"].iloc[0]], "entries": [entries.astype(np.int64).tobytes()], "vectors": [unique.astype(np.float64).tobytes()], "graph": [graph.astype(np.int32).tobytes()], "ids": [ids[order].astype(np.int64).tobytes()], "copies": [np.bincount(inverse).astype(np.int64).tobytes()]})

    return run


def _search_shard(k: int, beam: int, step: int = 256):
    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "query_hash": [], "vec_id": [], "score": []}
        if queries.empty or index.empty:
            return pd.DataFrame(out).astype({"query_id": "int64", "query_hash": "int64", "vec_id": "int64", "score": "float64"})
        row, dim = index.iloc[0], int(index["dim"].iloc[0])
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
        ids, copies = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["copies"], np.int64)
        graph, entries = np.frombuffer(row["graph"], np.int32).reshape(len(vectors), -1), np.frombuffer(row["entries"], np.int64)
        start, x = np.cumsum(copies) - copies, _augmented(vectors)
        least = ids[start]
        for low in range(0, len(queries), step):
            part = queries.iloc[low : low + step]
            q = np.stack(part["embedding"].to_numpy()).astype(np.float64)
            #: The direction alone decides which vectors are near.
            way = (q / np.maximum(np.abs(q).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)).astype(np.float32)
            way /= np.sqrt((way**2).sum(axis=1, keepdims=True))
            if len(x) <= beam:
                found = np.broadcast_to(np.arange(len(x)), (len(q), len(x)))
            else:
                found, _ = beam_search(x, graph, entries, np.concatenate([way, np.zeros((len(q), 1), np.float32)], axis=1), beam)
            score = (vectors[found] * q[:, None, :]).sum(axis=-1)
            score[found < 0] = -np.inf
            for r, (query, tag) in enumerate(zip(part["vec_id"], part["query_hash"], strict=True)):
                #: The best nodes and, of those with the score of the last one, all: whose ids are smallest is seen below.
                order = np.lexsort((least[found[r]], -score[r]))
                order = order[score[r][order] != -np.inf]
                last = score[r][order[min(k, order.size - 1)]] if order.size else 0
                mine, scores = [], []
                for node in order[score[r][order] >= last]:
                    at = found[r, node]
                    same = ids[start[at] : start[at] + min(copies[at], k + 1)]
                    if (vectors[at] == q[r]).all():
                        same = same[same != query]
                    mine.append(same)
                    scores.append(np.full(len(same), score[r, node]))
                if mine:
                    flat, value = np.concatenate(mine), np.concatenate(scores)
                    first = np.lexsort((flat, -value))[:k]
                    out["query_id"] += [query] * len(first)
                    out["query_hash"] += [tag] * len(first)
                    out["vec_id"] += flat[first].tolist()
                    out["score"] += value[first].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "query_hash": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest(vectors: DataFrame, queries: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", degree: int = 32, build_beam: int = 64, beam: int = 192, alpha: float = 1.2, shard_rows: int = 8192, query_block: int = 4096) -> DataFrame:
    """The k nearest found for each query, by largest inner product; ties go to the smaller id.

    queries: an SQL condition on the id that picks the query rows; candidates are all rows but the query's own.
    Vectors of single and of double precision are held as they are. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, take no part;
    whole repeated rows count once, and vectors of another length are never compared. An empty table gives no rows.
    Returns query_id, rank (from 1), vec_id, score (the inner product of the original vectors in double precision).
    All vectors are indexed. A task holds one shard's graph and one block of queries.
    """
    v = F.col("embedding")
    sound = (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))) & F.exists(v, lambda c: c != 0)
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = cut(own.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(sound).distinct().withColumn("dim", F.size("embedding")))
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))
    index = cut(sharded.groupBy("dim", "shard").applyInPandas(_index_shard(degree, build_beam, alpha), "dim int, shard int, entries binary, vectors binary, graph binary, ids binary, copies binary"))
    asked = rows.filter(queries)
    blocks = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("query_hash", F.xxhash64("embedding")).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    left = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).groupBy("dim", "shard", "block")
    right = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("dim", "shard", "block")
    found = left.cogroup(right).applyInPandas(_search_shard(k, beam), "query_id long, query_hash long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
