"""The corpus operators against brute force, round trips and held-out accuracy, with nulls, ties, repeats and long texts."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("tessera.llm")

from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import ann, components, licenses, lm_score, materialise, minhash, mixing, packing, quality, queries, rules, tokens, warc  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "Ünï cødé \x00 ﷽ 𝔘"), (7, "long word " * 3000), (8, "one"), (8, "one"), (None, "no id")]


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def rng_docs(n=160, seed=3):
    r = random.Random(seed)
    vocab = ["w%d" % k for k in range(400)]
    docs = []
    for k in range(n):
        if k % 3 == 1:  # a near copy of an earlier text
            base = docs[r.randrange(len(docs))][1].split(" ")
            for _ in range(r.randrange(0, 6)):
                base[r.randrange(len(base))] = r.choice(vocab)
            docs.append((k, " ".join(base)))
        else:
            docs.append((k, " ".join(r.choice(vocab) for _ in range(r.randrange(4, 160)))))
    return docs


def brute_classes(docs, w, percent):
    def shingles(t):
        x = (t or "").encode().lower().split()
        return {tuple(x[i : i + w]) for i in range(len(x) - w + 1)} if len(x) >= w else ({tuple(x)} if x else set())

    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize(("w", "percent"), [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(spark, w, percent):
    docs = rng_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("component", F.lit("clash"))
    got = minhash.near_duplicates(df, words=w, percent=percent, block=16, block_shingles=800).collect()
    classes, sizes = brute_classes(docs, w, percent)
    assert {r.doc_id: r.component_id for r in got} == classes
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_large_group_of_near_copies(spark):
    r, vocab = random.Random(5), ["w%d" % k for k in range(300)]
    base = [r.choice(vocab) for _ in range(80)]
    docs = []
    for k in range(400):
        own = list(base)
        for _ in range(r.randrange(0, 5)):
            own[r.randrange(80)] = r.choice(vocab)
        docs.append((k, " ".join(own)))
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=3, percent=85).collect()
    assert {x.doc_id: x.component_id for x in got} == brute_classes(docs, 3, 85)[0]


@pytest.mark.parametrize(("limit", "block"), [(2, 512), (10, 4), (16_384, 3)])
def test_minhash_classes_do_not_depend_on_sizes(spark, limit, block):
    docs = rng_docs(120, 9)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = minhash.near_duplicates(df, words=3, percent=85, cluster_limit=limit, block=block, block_shingles=300).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_classes(docs, 3, 85)[0]


def test_minhash_classes_inside_one_large_cluster(spark):
    """Chains of near copies over many blocks, which one cluster holds together with classes that are not linked."""
    r, vocab = random.Random(15), ["w%d" % k for k in range(600)]
    docs, base = [], [r.choice(vocab) for _ in range(120)]
    for k in range(150):  # a chain: each text is near the one before
        base = list(base)
        base[(7 * k) % 120] = r.choice(vocab)
        docs.append((k, " ".join(base)))
    docs += [(1000 + k, t + " and more words of its own " + " ".join(r.choice(vocab) for _ in range(30))) for k, t in docs[::5]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = brute_classes(docs, 3, 85)[0]
    assert len(set(expected.values())) > 3
    for block in (4, 40):
        got = minhash.near_duplicates(df, words=3, percent=85, block=block, block_shingles=120 * block).collect()
        assert {x.doc_id: x.component_id for x in got} == expected


def test_minhash_two_texts_under_one_id(spark):
    one, other = " ".join("a%d" % k for k in range(60)), " ".join("b%d" % k for k in range(60))
    rows = [(5, one, 1), (5, other, 2), (5, one, 1), (7, other + " b99", 3), (2, one + " a99", 4), (9, one.upper(), 5), (None, one, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id int")
    classes = minhash.near_duplicates(df, words=3, percent=85)
    got = sorted((str(r.doc_id), r.component_id or 0, r.kept) for r in classes.collect())
    assert got == sorted([("5", 2, False), ("5", 5, True), ("5", 2, False), ("7", 5, False), ("2", 2, True), ("9", 2, False), ("None", 0, True)])
    kept = minhash.keep_one(df, classes)
    assert kept.columns == df.columns and sorted((str(r.doc_id), r.class_id) for r in kept.collect()) == [("2", 4), ("5", 2), ("None", 6)]


def test_minhash_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, words=3, percent=85).collect())
    assert [(g[1], g[3]) for g in got if not g[0]] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 4), (8, 4)]
    assert [g[2] for g in got[:4]] == [0, 0, 0, 1]
    assert got[-1][3:] == (None, True)
    kept = minhash.keep_one(df.filter("doc_id IS NULL OR doc_id <> 4"), minhash.near_duplicates(df.filter("doc_id IS NULL OR doc_id <> 4"), words=3, percent=85))
    assert Counter(r.doc_id for r in kept.collect())[8] == 1
    assert minhash.near_duplicates(df.limit(0), words=3, percent=85).count() == 0


def test_miss_rate_bounds():
    for p in (0.8, 0.85, 0.9):
        assert minhash.miss_rate(p, minhash.choose_width(p, 18), 18) <= 0.0012


@pytest.mark.parametrize("spread", [90, 5000])
def test_shared_counts(spread):
    r = np.random.default_rng(1)
    #: Values below 20 are in most of the sets, others in few.
    sets = [np.unique(np.concatenate([r.integers(0, 20, 40), r.integers(0, spread, r.integers(1, 80))])).astype(np.uint64) for _ in range(150)]
    expected = np.array([[0 if i == j else len(np.intersect1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (minhash.shared(sets) == expected).all()


@pytest.mark.parametrize("task_edges", [3, 20, 1_000_000])
def test_components_of_a_path_and_a_star(spark, task_edges):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(1, 7)] + [(9, 9)] + [(1, None)] + [(500, 600)] * 30
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r.node: r.component for r in components.connected_components(df, task_edges=task_edges).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 1 for k in range(1, 8)} | {500: 500, 600: 500}
    assert components.connected_components(df.limit(0)).count() == 0


def test_labels_equal_a_plain_search():
    r = np.random.default_rng(3)
    for n in (1, 5, 60, 400):
        u, v = r.integers(0, 300, n), r.integers(0, 300, n)
        nodes, found = components.labels(u, v)
        root = {k: k for k in nodes.tolist()}
        for _ in range(len(root)):
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                root[a] = root[b] = min(root[a], root[b])
        assert found.tolist() == [root[k] for k in nodes.tolist()]


def test_nearest_recall_and_rules(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(1500, 12)).astype(np.float32) * r.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[40:60] = x[40]
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    odd = [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (2060, [float("inf")] + [1.0] * 11), (2080, [None] + [1.0] * 11), (None, [1.0] * 12), (2100, []), (5, rows[5][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = ann.nearest(df, "vec_id % 20 = 0", k=20, shard_rows=600, beam=96, build_beam=48, degree=24).collect()
    exact, hits = x.astype(np.float64), 0
    found = defaultdict(dict)
    for row in got:
        found[row.query_id][row.rank] = row
    assert sorted(found) == list(range(0, 1500, 20))
    for q, ranks in found.items():
        assert sorted(ranks) == list(range(1, 21))
        score = exact @ exact[q]
        score[q] = -np.inf
        best = sorted(range(1500), key=lambda k: (-score[k], k))[:20]
        mine = [ranks[k].vec_id for k in range(1, 21)]
        hits += len(set(best) & set(mine))
        assert q not in mine
        for k in range(1, 21):
            assert ranks[k].score == pytest.approx(score[ranks[k].vec_id], rel=1e-12)
        assert mine == sorted(mine, key=lambda v, ranks=ranks, mine=mine: (-ranks[mine.index(v) + 1].score, v))
    assert hits / (20 * len(found)) >= 0.95
    few = ann.nearest(df.filter("vec_id < 4"), "vec_id % 20 = 0").collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert ann.nearest(df.limit(0), "vec_id % 20 = 0").count() == 0


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_ties_go_to_the_smaller_id(spark, kind):
    """Many different vectors of one score, more than fit, on either side of the beam; large and very close values."""
    rows = [(0, [1.0, 0.0, 0.0])] + [(k, [0.5, float(k), 0.0]) for k in range(1, 100)]
    got = ann.nearest(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("rank", F.lit(0)), "vec_id = 0").collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(k, k, 0.5) for k in range(1, 21)]
    if kind == "double":
        near = [(0, [1.0, 1e200])] + [(k, [1.0 + k * 1e-12, 1e60]) for k in range(1, 30)] + [(99, [1e300, 1.0])]
        got = ann.nearest(spark.createDataFrame(near, "vec_id long, embedding array<double>"), "vec_id = 0", k=3).collect()
        exact = sorted(((v[0] + v[1] * 1e200, -i) for i, v in near[1:]), reverse=True)
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(-i, s) for s, i in exact[:3]]


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").toPandas()
    assert {bool(zlib.crc32(str(i).encode()) % 3 == 1) == bool(h) for i, h in zip(got.doc_id, got.held_out, strict=True)} == {True}
    test = got[got.held_out]
    assert len(test) > 50 and (test.predicted == test.quality).mean() >= 0.97
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.5)).all()


def test_quality_gradients_and_odd_rows(spark):
    r = np.random.default_rng(0)
    p = {"e": r.normal(size=(quality.TRAITS, 4)), "eb": r.normal(size=4), "v": r.normal(size=(4, 3)), "u": r.normal(size=(4, 3)), "w": r.normal(size=3), "o": r.normal(size=4), "ob": r.normal(size=1)}
    size, y, weight = np.array([3, 1, 2]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    x = r.normal(size=(6, quality.TRAITS)) / 4
    loss = lambda q: -(weight * (y * np.log(quality._forward(q, x, size)[0]) + (1 - y) * np.log(1 - quality._forward(q, x, size)[0]))).sum() / weight.sum()
    grad = quality._gradients(p, x, size, y, weight)
    for name in p:
        at = (0,) * p[name].ndim
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert grad[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-6, rel=1e-4, abs=1e-8)
    docs = spark.createDataFrame([(i, t, "a") for i, t in ODD], "doc_id long, text string, score string")
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.accepted(docs, none).columns == docs.columns and quality.accepted(docs, none).count() == len(ODD)
    one = quality.train(docs, spark.createDataFrame([(k, 1) for k in range(9)] + [(None, 0), (3, None)], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, one).collect()} == {1.0}


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing_targets_and_draws(spark):
    r = random.Random(4)
    names = ["a", "b", "ä", "Z", None, "empty", "big"]
    rows = [(k, "x " * r.randrange(1, 60), r.choices(names, [1, 3, 1, 2, 2, 0, 9])[0]) for k in range(800)] + [(900, None, "empty"), (901, " ", "empty"), (None, "y y", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.report(df).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(words(t))
    target = brute_targets(size)
    by = {r.doc_id: s for r, s in ((r, rows[r.doc_id][2] if r.doc_id is not None and r.doc_id < 900 else ("a" if r.doc_id is None else "empty")) for r in got)}
    taken = defaultdict(int)
    for r in got:
        s = by[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    for s in names:
        assert taken[s] == pytest.approx(target[s], rel=0.03, abs=60)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.report(df.repartition(7)).collect()), key=str)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(taken.values())
    assert mixing.report(df.limit(0)).count() == 0


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    r, letters = random.Random(1), "aAbz éÉÀ́ñ'.,!?#*@<|>一Kİ ß  \x1c\n\t012½'s't…—“"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(50))) for _ in range(3000)] + ["<|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", "don't I'm IT'S a's' @ a@b", ""]
    plain, mine = Tokenizer.from_file(tokens.default_path()), tokens.WordTokenizer(limit=500)
    for low in range(0, len(texts), 100):
        part = texts[low : low + 100]
        for ids, t in zip(mine.encode([t.encode() for t in part]), part, strict=True):
            assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids


def test_fill_is_the_best_sum():
    r = random.Random(7)
    for _ in range(200):
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        gap = r.randrange(1, 60)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        got = packing.fill(gap, counts)
        assert sum(x * n for x, n in got) == max(s for s in sums if s <= gap)
        assert all(n <= counts[x] for x, n in got)


def test_packing_whole_ids(spark):
    from tokenizers import Tokenizer

    r, tk = random.Random(5), Tokenizer.from_file(tokens.default_path())
    rows = [(k, " ".join(r.choice(["the", "quick", "zyx,", "Übung", "42"]) for _ in range(r.randrange(0, 300)))) for k in range(150)] + [(500, None), (501, "word " * 700)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), capacity=128).toPandas()
    for i, t in rows:
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        own = got[got.doc_id == i].sort_values("start")
        assert own.length.sum() == ids.size and (own.start.to_numpy() == np.cumsum(own.length) - own.length).all() and set(own.doc_tokens) == {ids.size}
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length, strict=True)] == own.ids_crc32.tolist()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert (own.offset.to_numpy() == np.cumsum(own.length) - own.length).all() and own.length.sum() <= 128
    full = got.groupby("sequence_id").length.sum()
    assert sorted(full.index) == list(range(len(full))) and 1 - full.sum() / (128 * len(full)) < 0.02
    odd = packing.pack(spark.createDataFrame(ODD, "doc_id long, text string")).toPandas()
    assert odd.length.sum() == sum(len(tk.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lm_query_counts_every_word_and_pair(spark, tmp_path):
    r = random.Random(7)
    docs = [(k, " ".join(r.choice("abcd") if r.random() < 0.3 else "w%d" % r.randrange(90_000) for _ in range(600))) for k in range(300)] + [(None, "a b"), (400, None), (5, "a b a"), (401, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    brute_uni, brute_bi = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in docs:
        s = (t or "").split()
        for m in (0, 1) if i is not None and i < 300 and i % 3 == 0 else (1,):
            brute_uni[m].update(s)
            brute_bi[m].update(zip(s, s[1:], strict=False))
    size = len(brute_uni[1])
    assert size > 60_000
    expected = {}
    for i, t in docs:
        s, loss = (t or "").split(), []
        for uni, bi in zip(brute_uni, brute_bi, strict=True):
            one = {w: (uni[w] + 0.5) / (uni.total() + 0.5 * (size + 1)) for w in s}
            p = [one[w] for w in s[:1]] + [0.4 * one[b] + 0.6 * bi[a, b] / uni[a] if uni[a] else one[b] for a, b in zip(s, s[1:], strict=False)]
            loss.append(-np.log(p).mean() if s else None)
        expected[i, len(s)] = loss
    many = lm_score.differences(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet").filter("quality = 1"), block_words=5000, part_bytes=100_000)
    for found in (queries.op6_lm_score(spark, str(tmp_path)).collect(), many.collect()):
        assert sorted((str(x.doc_id), x.n_words) for x in found) == sorted((str(i), len((t or "").split())) for i, t in docs)
        for x in found:
            target, background = expected[x.doc_id, x.n_words]
            if not x.n_words:
                assert x.target_loss is x.background_loss is x.score is None
                continue
            assert x.target_loss == pytest.approx(target, rel=1e-9) and x.background_loss == pytest.approx(background, rel=1e-9)
            assert x.score == pytest.approx(target - background, rel=1e-9, abs=1e-12)


def test_lm_score_of_odd_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(1, "a b a b"), (1, "a b a b"), (2, "c d"), (3, ""), (4, None), (None, "a b"), (5, " \n")], schema)
    target = spark.createDataFrame([(1,), (None,)], "doc_id long")
    plain = sorted(map(str, lm_score.differences(docs, target).collect()))
    assert len(plain) == 7
    clash = docs.selectExpr("*", "1 AS target", "2 AS _id", "'x' AS block", "3 AS part", "'y' AS ids", "0 AS n_words", "null AS score")
    assert sorted(map(str, lm_score.differences(clash, target.selectExpr("*", "'t' AS text", "1 AS target")).collect())) == plain
    score = {r.doc_id: r.score for r in lm_score.differences(docs, target).collect()}
    assert score[1] < 0 < score[2] and score[3] is score[4] is score[5] is None
    assert lm_score.differences(docs.limit(0), target).count() == 0
    none = lm_score.differences(docs, target.limit(0)).collect()  # without targets every word is equally likely there
    assert len(none) == 7 and all((r.score is None) == (r.n_words == 0) for r in none)


def test_licenses_equal_brute_force(spark):
    texts = ["Released under the MIT License. under THE mit-license", "Licensed under the Apache License, Version 2.0.\ncc by-nc cc BY nc", "This work is licensed under the GNU General Public License, version 3.", "gnu license mit", "under the mit license" * 2, "under the mit Kicense", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", "x " * 5000 + "cc by nc"]
    rows = ODD + [(100 + k, t) for k, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().lower().decode())
        at = [(k, label) for p, label in licenses.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = by[i]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert by[102].labels == "gpl-3" and by[106].labels == "mit" and by[103].labels == "" and by[106].score > 0.9
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licenses_of_two_notices_and_in_prose(spark):
    known = [(label, t) for label, t, _ in licenses.TEMPLATES]
    pairs = [(a, b) for k, a in enumerate(known) for b in known[k + 1 :] if a[0] != b[0]]
    prose = " ".join(f"prose {w} prose" for w in licenses.template_words())
    rows = [({a[0], b[0]}, f"{a[1]} some words between {b[1]}") for a, b in pairs] + [({label}, f"{prose} {t} {prose * 20}") for label, t in known]
    rows += [(set(), prose), (set(), "version 3 of the gnu general public license")]
    rows += [(None, "plain words of the text without any notice to be found in it")] * 300
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string").withColumn("label", F.lit(0))).collect()}
    texts = [t.split() for _, t in rows]
    sets = [set(t) for t in texts]
    idf = {w: np.log(1 + len(rows) / max(1, sum(w in t for t in sets))) for w in licenses.template_words()}
    rare = [set(sorted(set(t.split()), key=lambda w: (-idf[w], w))[:8]) for _, t, _ in licenses.TEMPLATES]
    for k, (labels, text) in enumerate(rows[: len(pairs) + len(known) + 3]):
        at, flat = defaultdict(list), f" {text} "
        for i, w in enumerate(texts[k]):
            at[w].append(i)
        expected = {label for p, label in licenses.BASE if f" {p} " in flat}
        for (label, template, keys), words_ in zip(licenses.TEMPLATES, rare, strict=True):
            own = [(w, i) for i, w in enumerate(template.split()) if w in words_]
            weight = Counter()
            if all(f" {p} " in flat for p in keys):
                for w, i in own:
                    for j in at[w]:
                        weight[j - i] += idf[w]
            if max(weight.values(), default=0) >= 0.5 * sum(idf[w] for w, _ in own):
                expected.add(label)
        assert set(filter(None, got[k].labels.split(","))) == expected, text[:200]
        assert (labels or set()) <= expected
    assert got[len(rows) - 1].labels == ""


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_permutation(size):
    order = materialise.Permutation(size, 9)
    slots = order.slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size)) and (order.sequences(slots) == np.arange(size)).all()
    assert size < 100 or (slots != materialise.Permutation(size, 10).slots(np.arange(size))).mean() > 0.9


def test_shards_round_trip_and_resume(spark, tmp_path):
    rows = [(k, f"text number {k} " * (k % 7)) for k in range(90)] + [(500, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    path = f"file://{tmp_path}/shards"
    total = materialise.write_shards(df, path, key=3, seq_len=64, per_shard=8)
    got = materialise.read_shards(spark, path, 64, 8).toPandas().sort_values("slot")
    assert got.slot.tolist() == list(range(total))
    tk = tokens.WordTokenizer()
    expected = Counter(x for ids in tk.encode([(t or "").encode() for _, t in rows]) for x in [*ids.tolist(), 2])
    assert Counter(x for b in got.ids for x in np.frombuffer(b, "<u2").tolist()) == expected
    for name in os.listdir(f"{tmp_path}/shards"):
        if name.startswith("part-"):
            assert os.path.getsize(f"{tmp_path}/shards/{name}") % materialise.stride(64) == 0
    part = materialise.read_shards(spark, path, 64, 8, start=5, stop=19).toPandas().sort_values("slot")
    assert part.slot.tolist() == list(range(5, min(19, total))) and part.ids.tolist() == got.ids.tolist()[5 : min(19, total)]
    digest = materialise.materialise(df, key=3, seq_len=64, per_shard=8).toPandas()
    assert sorted(digest.sequence_id) == list(range(total)) and sorted(digest.ids_crc32) == sorted(zlib.crc32(b) for b in got.ids)
    assert materialise.materialise(df.limit(0)).count() == 0


def test_shard_numbers_of_any_length():
    names = ["part-00007-x.txt", "file:/a/part-99999-c000.txt", "part-100000-x", "hdfs://h/shards-part-1/part-123456-c000"]
    assert [materialise.shard_number(n) for n in names] == [7, 99_999, 100_000, 123_456]
    with pytest.raises(ValueError):
        materialise.shard_number("file:/a/_SUCCESS")


def test_a_tokenizer_that_joins_words_is_refused(tmp_path):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.default_path())
    from tokenizers import pre_tokenizers

    tk.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
    tk.save(str(tmp_path / "t.json"))
    with pytest.raises(ValueError):
        tokens.WordTokenizer(str(tmp_path / "t.json"))


@pytest.mark.parametrize("version", [1, 2])
def test_arc_files_and_warc_records(version):
    records = [{"url": "http://a.example/x y\n", "type": "text/html", "content": b"HTTP/1.1 200 OK\r\n\r\n\n\nbody\r\n\r\n"}, {"url": None, "content": b""}, {"url": "http://b.example/", "date": "20240102030405", "content": b"plain"}]
    got = list(warc.parse_arc(warc.write_arc(records, version)))
    assert [c for _, c in got] == [r["content"] for r in records]
    assert [h["URL"] for h, _ in got] == ["http://a.example/x%20y%0A", "-", "http://b.example/"]
    record = warc.to_warc(*got[2], key="3")
    header, block = next(warc.parse_warc(record + warc.RECORD_END))
    assert block == b"plain" and header["WARC-Date"] == "2024-01-02T03:04:05Z" and header["WARC-Type"] == "resource"
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.write_arc(records, version)[:-3]))


def test_arc_files_from_storage(spark, tmp_path):
    r = random.Random(9)
    bodies = [b"", b"\n", b"a\n\nb\n", b"http://x.example/ 0.0.0.0 20240101000000 text/html 5\nabcde", b"no line end", b"x" * 300_000 + b"\r\n" * 50] + [bytes(r.randrange(256) for _ in range(r.randrange(400))) for _ in range(60)]
    records = [{"url": f"http://a.example/{k}", "type": "text/plain", "content": c} for k, c in enumerate(bodies)]
    import gzip

    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.arc").write_bytes(warc.write_arc(records, 1))
    whole = warc.write_arc(records, 2)
    (tmp_path / "in/two.arc.gz").write_bytes(gzip.compress(whole[:5000]) + gzip.compress(whole[5000:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = warc.read_arc(spark, str(tmp_path / "in")).collect()
        warc.convert_arc(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", file_bytes=60_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, version in (("one.arc", 1), ("two.arc.gz", 2)):
        own = sorted((x for x in got if x.file.endswith(name)), key=lambda x: x.record_no)
        assert [(x.version, x.url, bytes(x.content)) for x in own] == [(version, y["url"], y["content"]) for y in records]
    files = [p.read_bytes() for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    found = [list(warc.parse_warc(data)) for data in files]
    assert len(files) > 3 and all(f[0][0]["WARC-Type"] == "warcinfo" for f in found) and sum(len(d) > 100_000 for d in files) == 2
    assert sorted(block for f in found for h, block in f if h["WARC-Type"] != "warcinfo") == sorted(bodies * 2)
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut/x.arc").write_bytes(whole[:-40])
    with pytest.raises(Exception, match="bytes declared"):
        warc.read_arc(spark, str(tmp_path / "cut")).count()


def test_archive_files_are_bounded(spark, tmp_path):
    rows = [(k, "u", "é" * (k * 400)) for k in range(60)] + [(99, "u", "long " * 100_000)]
    warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w", file_bytes=200_000)
    sizes = [p.stat().st_size for p in (tmp_path / "w").iterdir() if p.name.startswith("part-")]
    assert len(sizes) > 4 and sorted(sizes)[-1] > 500_000 and all(s < 210_000 for s in sorted(sizes)[:-1])
    assert warc.read_archives(spark, f"file://{tmp_path}/w").filter("page_id IS NOT NULL").count() == len(rows)


@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, version):
    long = "<p>" + "é" * 60
    rows = [(5, "http://a.example/", long), (3, "http://b.example/", long), (9, None, long), (3, "http://b.example/", long), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u v", "WARC/1.1\r\n\r\n" * 30), (None, "n", long)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")), version).collect()
    expected = []
    for i, _, h in rows:
        data = (h or "").encode()
        owner = min((j for j, _, g in rows if g == h and j is not None), default=None) if len(data) >= 100 else i
        first = owner == i or owner is None
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if first else "revisit", None if first else owner))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_rules_equal_brute_force(spark):
    r = random.Random(8)
    rows = [(k, "\n".join(" ".join(r.choice(["a", "b", "c#", "the", "|"]) for _ in range(r.randrange(0, 9))) for _ in range(r.randrange(1, 9))), r.choice(["en", None])) for k in range(150)]
    rows += [(1000 + k, t, "en") for k, (_, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit(1)).withColumn("n_words", F.lit(1))
    got = {r.doc_id: r for r in rules.report(df).collect()}
    for i, t, _ in rows:
        w = words(t)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often, covered = Counter(grams), set()
        for k, g in enumerate(grams):
            if often[g] > 1:
                covered.update(range(k, k + 5))
        lines = [x for x in (t or "").split("\n") if words(x)]
        m = got[i]
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert m.base_failed == failed and not (failed and m.kept)
    passed = rules.passed(df)
    assert rules.passed(df.withColumn("lang", F.lit(7))).schema["lang"].dataType.simpleString() == "int"
    assert passed.columns == df.columns and sorted(r.doc_id for r in passed.collect()) == sorted(i for i, m in got.items() if m.kept)
    assert rules.report(df.limit(0)).count() == 0


def test_common_words_alone_decide(spark):
    import corpus_pipeline

    r = random.Random(13)
    plain = ["w" + "".join(r.choice("abcdefgh") for _ in range(3)) for _ in range(3000)]
    text = lambda n, share: " ".join(r.choice(rules.COMMON[:10]) if r.random() < share else r.choice(plain) for _ in range(n))
    rows = [(k, text(r.randrange(100, 300), 0.18), "en") for k in range(200)]
    rows += [(1000 + k, text(n, 0), "en") for k, n in enumerate((49, 50, 99, 100, 300))]
    rows += [(2000 + k, text(150, 0), "xx") for k in range(50)] + [(2100, text(150, 0.1), "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    report = {x.doc_id: x for x in rules.report(df).collect()}
    assert all(x.common_distance < 0.45 for x in report.values())
    assert {i for i, x in report.items() if not x.kept} == {1001, 1002, 1003, 1004}
    assert {x.reference for i, x in report.items() if i >= 2000} == {"characters"} and {x.reference for i, x in report.items() if i < 2000} == {"characters and words"}
    kept = {x.doc_id for x in corpus_pipeline.apply_rules(spark, df, "").collect()}
    assert set(report) - kept == {1001, 1002, 1003, 1004}


def test_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    got = spark.range(1).select(rules.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    expected = (sum((a * np.log2(a / c) if a else 0) + (b * np.log2(b / c) if b else 0) for a, b, c in zip(p, q, m, strict=True)) / 2) ** 0.5
    assert got == pytest.approx(expected)


def test_queries_and_pipeline_run(spark):
    import corpus_pipeline

    for name, f in queries.QUERIES.items():
        assert f(spark, SMALL).count() > 0, name
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.count() > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    expected = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, expected))


def test_histograms_equal_brute_force(spark):
    r = random.Random(12)
    pool = [*rules.COMMON[:12], "The", "DE", "la", "la", "x1", "ÉTÉ", "a,b", "#%", "(y)"]
    rows = [(k, " ".join(r.choice(pool) for _ in range(r.randrange(0, 60)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = {x["row"].doc_id: x for x in rules.histograms(rules.base_counts(df, ["doc_id"])).select("row", "chars", "common").collect()}
    for i, t in rows:
        low = [w.lower() for w in words(t)]
        assert got[i].common == [low.count(w) for w in rules.COMMON] + [sum(w not in rules.COMMON for w in low)]
        left, chars = "".join(words(t)), []
        for pattern in rules.CLASSES:
            rest = re.sub(pattern, "", left)
            chars.append(len(left) - len(rest))
            left = rest
        assert got[i].chars == [*chars, len(left)]
