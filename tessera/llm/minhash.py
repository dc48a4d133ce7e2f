"""Near-duplicate groups by MinHash with tensored banding.

A document is the set of its word shingles. ``collections`` small hash collections of ``width`` MinHashes each are
computed once; every pair of collections is the key of one table, so m collections serve m(m-1)/2 tables and the number
of MinHashes grows with the square root of the number of tables. Two documents are linked if they meet in a table and
their full shingle sets are similar enough; whether they do depends on the two documents alone.

Candidates are compared block against block: inside coarse clusters (documents that tables connect), or, where a cluster
is large, inside single buckets. Blocks are compared with themselves first, then one document of each class found with the
others, and then only what is not in a group's largest class, so that a group of copies of any size costs a number of
comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import U64, WordHashes, broadcast_if_small, constants, cut, mix, small_batches, words_of
from tessera.llm.components import connected_components

#: Shingles hashed in one go; the arrays stay in the CPU's cache.
STEP = 60_000


def miss_rate(similarity: float, width: int, collections: int) -> float:
    """The probability that a pair of this similarity meets in no table: fewer than two collections agree."""
    p = similarity**width
    return (1 - p) ** collections + collections * p * (1 - p) ** (collections - 1)


def choose_width(similarity: float, collections: int, miss: float = 0.0012) -> int:
    """The most MinHashes a collection may have while pairs at the threshold are missed at most so often."""
    fit = [w for w in range(1, 17) if miss_rate(similarity, w, collections) <= miss]
    return max(fit, default=1)


class Shingles:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, words: int):
        self.words, self.odd, self.hashes = words, constants(words, 11), WordHashes()

    def of(self, text: bytes | None) -> np.ndarray:
        h = self.hashes.of(words_of(text))
        if not h.size:
            return h
        n = h.size - self.words + 1
        if n < 1:  # the whole sequence as one shingle; its length keeps it apart from longer ones
            return mix(np.array([(h * self.odd[: h.size]).sum() + U64(h.size)], U64))
        s = h[:n] * self.odd[0]
        for k in range(1, self.words):
            s += h[k : n + k] * self.odd[k]
        return np.unique(mix(s))


def signatures(collections: int, width: int, words: int):
    """A mapInArrow function: doc_id, text_hash, text (binary) -> doc_id, text_hash, n_shingles, two longs that name the set, the
    collections' hashes."""

    def emit(ids: list, tags: list, sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        sizes = np.array([x.size for x in sets], np.int64)
        full = np.flatnonzero(sizes)
        names, out = np.zeros((2, len(sets)), U64), np.zeros((len(sets), collections), U64)
        if full.size:
            flat = np.concatenate([sets[i] for i in full])
            at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            names[0, full], names[1, full] = np.add.reduceat(mix(flat), at), np.add.reduceat(mix(flat ^ c[0]), at)
            for k in range(collections):
                total = np.full(full.size, U64(k))
                for j in range(k * width, (k + 1) * width):
                    total = mix(total + np.minimum.reduceat(flat * a[j] + b[j], at) * c[j - k * width])
                out[full, k] = total
        hashes = pa.ListArray.from_arrays(np.arange(0, out.size + 1, collections, dtype=np.int32), pa.array(out.view(np.int64).ravel()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, pa.int64()), pa.array(sizes), pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)), hashes], ["doc_id", "text_hash", "n_shingles", "k1", "k2", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        a, b, c = constants(collections * width, 21), constants(collections * width, 22), constants(max(width, 1), 23)
        for batch in batches:
            ids, tags, sets, n = [], [], [], 0
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids.append(doc)
                tags.append(tag)
                sets.append(shingles.of(text.as_py()))
                n += sets[-1].size
                if n >= STEP:
                    yield emit(ids, tags, sets, a, b, c)
                    ids, tags, sets, n = [], [], [], 0
            if ids:
                yield emit(ids, tags, sets, a, b, c)

    return run


def _first_of_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, id): an edge from each row to the first row of its key. Keeps one row in memory."""
    key = first = None
    for batch in batches:
        k, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not k.size:
            continue
        new = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(k.size), -1))
        head = np.where(at >= 0, v[at], first if first is not None else 0)
        key, first = k[-1], head[-1]
        u = head != v
        yield pa.RecordBatch.from_arrays([pa.array(v[u]), pa.array(head[u])], ["u", "v"])


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections of sorted distinct sets."""
    n = len(sets)
    row = np.repeat(np.arange(n), [x.size for x in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    col = np.cumsum(new) - 1
    often = np.bincount(col)
    inter = np.zeros((n, n), np.float64)
    hot = often > 64
    if hot.any():
        name, keep = np.cumsum(hot) - 1, hot[col]
        c, r = name[col[keep]], row[keep]
        for low in range(0, int(hot.sum()), 4096):
            part = (c >= low) & (c < low + 4096)
            dense = np.zeros((n, min(4096, int(hot.sum()) - low)), np.float32)
            dense[r[part], c[part] - low] = 1
            inter += dense @ dense.T
    keep = (often[col] > 1) & ~hot[col]
    c, r = col[keep], row[keep]
    left = np.arange(c.size)
    for d in range(1, int(often[~hot].max(initial=1))):
        left = left[left + d < c.size]
        left = left[c[left + d] == c[left]]
        if not left.size:
            break
        np.add.at(inter, (r[left], r[left + d]), 1) if left.size < 256 else np.add(inter, np.bincount(r[left] * n + r[left + d], minlength=n * n).reshape(n, n), out=inter)
    #: Rows of a column are in order, so the rarer columns filled the upper half alone; of the products it is taken.
    upper = np.triu(inter, 1)
    return upper + upper.T


def meets(hashes: np.ndarray) -> np.ndarray:
    """Whether each pair of rows of collections' hashes meets in a table: two collections agree at least."""
    agree = np.zeros((len(hashes), len(hashes)), np.int8)
    for column in hashes.T:
        agree += column[:, None] == column[None, :]
    return agree >= 2


def verifier(percent: int):
    """An applyInPandas function: the documents of two blocks -> an edge to the smallest node of each local component."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        sets, ids = [np.frombuffer(x, U64) for x in rows["shingles"]], rows["node"].to_numpy()
        size = np.array([x.size for x in sets])
        inter = shared(sets)
        linked = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
        linked &= meets(np.stack([np.asarray(x, np.int64) for x in rows["hashes"]]))
        linked |= np.eye(len(sets), dtype=bool)
        label = ids.copy()
        while True:
            least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
            if (least == label).all():
                break
            label = least
        far = label != ids
        return pd.DataFrame({"u": ids[far], "v": label[far]})

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds before: the sum of weight over the rows before in the partition."""
    total = 0
    for batch in batches:
        weight = batch.column("weight").to_numpy()
        before = total + np.cumsum(weight) - weight
        total += int(weight.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "before"])


def blocked(members: DataFrame, block: int, block_shingles: int) -> DataFrame:
    """Adds block to kind, group, node, n_shingles, hashes: numbers of runs of about block_shingles shingles, and block rows at
    most, in order of group and size. Sums run inside range partitions and are shifted by those before, so that no task
    holds a whole group."""
    weight = F.greatest(F.col("n_shingles"), F.lit(max(1, block_shingles // block))).cast("long")
    order = ["kind", "group", "n_shingles", "node"]
    dealt = members.select("kind", "group", "node", "n_shingles", "hashes", weight.alias("weight")).repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = "kind int, group long, node long, n_shingles long, hashes array<long>, weight long, before long"
    run = cut(dealt.mapInArrow(_running, kinds).withColumn("part", F.spark_partition_id()))
    #: A row for each partition.
    sums = run.groupBy("part").agg(F.sum("weight").alias("w"))
    base = sums.select(F.col("part").alias("_p"), F.coalesce(F.sum("w").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    number = F.floor((F.col("before") + F.col("base")) / block_shingles)
    return run.join(F.broadcast(base), F.col("part") == F.col("_p")).select("kind", "group", number.alias("block"), "node", "n_shingles", "hashes")


def shingle_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            text = batch.schema.get_field_index("text")
            sets = pa.array([shingles.of(x.as_py()).tobytes() for x in batch.column(text)], pa.binary())
            columns = [sets if k == text else x for k, x in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:text], "shingles", *batch.schema.names[text + 1 :]])

    return run


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("kind", "group", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"), F.count("*").alias("n"))


def _close(percent: int) -> str:
    """Blocks whose sizes lie too far apart hold no link."""
    return f"100 * high >= to_low * {percent} AND 100 * to_high >= low * {percent}"


def _pairs(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Pairs of a left and a right block of a group that may hold a link: kind, group, block, to."""
    other = _sizes(right).select("kind", "group", F.col("block").alias("to"), F.col("low").alias("to_low"), F.col("high").alias("to_high"))
    return _sizes(left).join(other, ["kind", "group"]).filter(_close(percent)).select("kind", "group", "block", "to")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, collections: int = 18, block: int = 512, block_shingles: int = 200_000, cluster_limit: int = 16_384, broadcast_rows: int = 200_000) -> DataFrame:
    """Groups of documents linked by 100 * |A & B| >= percent * |A | B| on distinct word shingles.

    A-Z are lower-cased; words are runs without x20 and x09-x0D. A text of fewer words than a shingle is one shingle;
    a null, empty or blank text has none and is linked with nothing. Returns one row per input row: doc_id, n_shingles,
    component_id (the smallest doc_id reachable over links, itself included), kept (doc_id = component_id), class_id (a
    number of the class, null without shingles) and text_hash. Rows with a null id are returned with component_id null and
    kept true. Repeated rows share a class; rows that repeat an id with other texts are judged each by its text. Other
    columns, whatever their names, are not looked at.

    Two documents are linked if they meet in a table and were confirmed on full sets; choose_width bounds how often a pair
    at the threshold meets in none. block, block_shingles and cluster_limit (the size above which a coarse cluster is
    compared bucket by bucket) change the cost alone, never a link.
    """
    spark = docs.sparkSession
    small_batches(spark)
    width = choose_width(percent / 100, collections)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    signed = cut(texts.select("doc_id", "text_hash", "text").mapInArrow(signatures(collections, width, words), "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, hashes array<long>"))

    #: Equal sets fall together first: one representative each goes on, under a number of its own.
    first = F.min(F.struct("doc_id", "text_hash")).alias("f")
    sets_ = signed.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(first, F.any_value("hashes").alias("hashes"))
    reps = cut(sets_.select("k1", "k2", "n_shingles", F.col("f.doc_id").alias("doc_id"), F.col("f.text_hash").alias("text_hash"), "hashes", F.monotonically_increasing_id().alias("node")))
    key = [F.xxhash64(F.lit(i), F.lit(j), F.col("hashes")[i], F.col("hashes")[j]) for i, j in combinations(range(collections), 2)]
    tables = reps.select(F.explode(F.array(*key)).alias("key"), F.col("node").alias("id"))
    met = tables.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_first_of_run, "u long, v long").distinct()
    coarse = connected_components(met)

    sized = coarse.join(reps.select("node", "n_shingles", "hashes"), "node")
    large = cut(sized.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") > cluster_limit).select("component"))
    members = sized.select(F.lit(0).alias("kind"), F.col("component").alias("group"), "node", "n_shingles", "hashes")
    if large.head(1):
        inside = sized.join(large, "component", "left_semi").select("node", "n_shingles", "hashes")
        buckets = tables.join(inside, tables.id == inside.node).select(F.lit(1).alias("kind"), F.col("key").alias("group"), "node", "n_shingles", "hashes")
        members = members.join(large.withColumnRenamed("component", "group"), "group", "left_anti").select("kind", "group", "node", "n_shingles", "hashes").union(buckets)
    members = cut(blocked(members, block, block_shingles))

    repeated = signed.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).filter("n > 1")
    once = texts.dropDuplicates(["doc_id", "text_hash"]) if repeated.head(1) else texts

    def verified(members: DataFrame, pairs: DataFrame) -> DataFrame:
        """Links inside pairs of blocks, as a forest of edges; checkpointed."""
        ends = pairs.select("kind", "group", F.explode(F.array_distinct(F.array("block", "to"))).alias("block"), F.struct(F.col("block").alias("a"), F.col("to").alias("b")).alias("pair"))
        placed = members.join(ends, ["kind", "group", "block"]).select("kind", "group", "pair", "node", "hashes")
        wanted = reps.join(placed.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"))
        wanted = broadcast_if_small(wanted, broadcast_rows)
        own = once.join(wanted, (F.col("doc_id") == F.col("_d")) & (F.col("text_hash") == F.col("_h"))).select("node", "text")
        sets = own.mapInArrow(shingle_sets(words), "node long, shingles binary")
        return cut(placed.join(sets, "node").groupBy("kind", "group", "pair").applyInPandas(verifier(percent), "u long, v long"))

    def classed(part: DataFrame, links: DataFrame) -> DataFrame:
        found = connected_components(links).withColumnRenamed("node", "_node")
        return cut(part.join(found, F.col("node") == F.col("_node"), "left").withColumn("class", F.coalesce("component", "node")).drop("_node", "component"))

    own_pairs = _sizes(members).filter("n > 1").select("kind", "group", "block", F.col("block").alias("to"))
    links = verified(members, own_pairs)
    several = members.groupBy("kind", "group").agg(F.count_distinct("block").alias("n")).filter("n > 1").select("kind", "group")
    part = cut(members.join(several, ["kind", "group"], "left_semi"))
    if part.head(1):
        #: One document of each class of a group with those of the others.
        now = classed(part, links)
        one = now.groupBy("kind", "group", "class").agg(F.min(F.struct("node", "n_shingles", "hashes")).alias("o")).select("kind", "group", "o.*")
        one = cut(blocked(one, block, block_shingles))
        links = cut(links.union(verified(one, _pairs(one, one, percent).filter("block <= to"))))
        #: What is not in a group's largest class, with all of the group.
        now = classed(part, links)
        counts = now.groupBy("kind", "group", "class").agg(F.count("*").alias("n"))
        largest = counts.groupBy("kind", "group").agg(F.max(F.struct("n", "class"))["class"].alias("largest"))
        rest = now.join(largest, ["kind", "group"]).filter("class <> largest").select("kind", "group", "node", "n_shingles", "hashes")
        if rest.head(1):
            rest = cut(blocked(rest, block, block_shingles).withColumn("block", -1 - F.col("block")))
            links = links.union(verified(rest.union(part.select(*rest.columns)), _pairs(rest, part, percent)))
    found = connected_components(links)

    named = reps.select("k1", "k2", "n_shingles", "doc_id", "node").join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("class_id", F.coalesce("component", "node"))
    least = named.groupBy(F.col("class_id").alias("_c")).agg(F.min("doc_id").alias("least"))
    named = named.join(least, F.col("class_id") == F.col("_c")).select("k1", "k2", "n_shingles", "class_id", "least")
    known = signed.select("doc_id", "text_hash", "n_shingles", "k1", "k2").join(named, ["k1", "k2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return known.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"), "text_hash")


def keep_one(docs: DataFrame, classes: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """One row of docs of each class: that of the smallest id, then of the smallest text hash.

    Rows without id stay, and so do rows without shingles. Two texts under one id stay both unless they are of one class. Of
    rows that repeat an id and its text one stays (the smallest hash of all columns).
    """
    known = classes.filter("kept AND doc_id IS NOT NULL")
    first = known.filter("class_id IS NOT NULL").groupBy("class_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("f")).select("f.doc_id", "f.text_hash")
    wanted = known.filter("class_id IS NULL").select("doc_id", "text_hash").union(first).distinct()
    counts = known.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.count("*").alias("_n"))
    wanted = cut(wanted.join(counts, (F.col("doc_id") == F.col("_d")) & (F.col("text_hash") == F.col("_h"))).select("_d", "_h", "_n"))
    marked = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("binary")))
    same = (F.col("doc_id").cast("long") == F.col("_d")) & (F.col("_hash") == F.col("_h"))
    single = marked.join(broadcast_if_small(wanted.filter("_n = 1"), broadcast_rows), same, "left_semi").select(*docs.columns)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = marked.join(broadcast_if_small(wanted.filter("_n > 1"), broadcast_rows), same).groupBy("_d", "_h").agg(F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
    return docs.filter("doc_id IS NULL").unionByName(single).unionByName(again.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns]))
