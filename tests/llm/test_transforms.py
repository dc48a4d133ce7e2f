"""Fill-in-middle, byte-level BPE and snapshot differences against plain Python, with nulls, repeats, long texts and large groups."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

pytest.importorskip("tessera.llm")

import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import byte_bpe, fim, quality, queries, snapshots  # noqa: E402

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "Ünï cødé \x00 ﷽ 𝔘 é"), (7, "long word " * 30000), (8, "one"), (8, "one"), (None, "no id"),
    (9, "holds <M> a mark"), (10, "<S>"), (11, "a<"), (12, "<P" + ">>" * 3), (13, "'s it's 'll\r\n  x"), (14, "<|endoftext|>"), (-15, "minus id"),
]


def odd(spark):
    return spark.createDataFrame([(i, t, "clash", 7) for i, t in ODD], "doc_id long, text string, ids string, form int")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_fim(doc_id, text):
    text = text or ""
    t = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}".encode())
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, sha(text.encode())
    prefix, middle, suffix = "".join(t[:a]), "".join(t[a:b]), "".join(t[b:])
    spm = h[3] % 100 < 20
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return len(t), "spm" if spm else "psm", len(prefix), len(middle), sha(out.encode())


def test_fill_in_middle_equals_plain_python(spark):
    r = random.Random(2)
    rows = ODD + [(100 + k, "".join(r.choice(["a", "Bc", " ", "\n", "é", "1", "𝔘", "<", "P>"]) for _ in range(r.randrange(60)))) for k in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, output string")
    got = Counter((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output_sha256, x.restored_sha256) for x in fim.report(df).collect())
    assert got == Counter((i, *brute_fim(i, t), sha((t or "").encode())) for i, t in rows)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_spans_rates_and_bytes(spark):
    df = spark.createDataFrame([(k, f"token{k} and {k} more") for k in range(400)], "doc_id long, text string")
    made = fim.fill_in_middle(df, seed=5, percent=50, spm_percent=50).collect()
    count = Counter(r.form for r in made)
    assert 120 < count["plain"] < 280 and count["psm"] > 50 and count["spm"] > 50
    for r in made:
        text = f"token{r.doc_id} and {r.doc_id} more"
        assert fim.rebuilt(bytes(r.output), r.form).decode() == text
        if r.form != "plain":
            tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
            assert len("".join(tokens[: r.start])) == r.prefix_chars and len("".join(tokens[r.start : r.stop])) == r.middle_chars
    broken = b"ab\xff\xfe c\xc3"
    assert fim.encoded(fim.code_points(broken)) == broken
    assert fim.fill_in_middle(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.rebuilt(b"<P>no other", "psm")


def plain_encoding():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library(spark):
    plain = plain_encoding()
    rows = {(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in byte_bpe.decode(byte_bpe.encode(odd(spark))).collect()}
    expected = set()
    for i, t in ODD:
        ids = plain.encode_ordinary(t or "")
        expected.add((i, len(ids), b"".join(x.to_bytes(4, "little") for x in ids), (t or "").encode()))
    assert rows == expected
    assert byte_bpe.encode(odd(spark)).count() == len(ODD) and byte_bpe.report(odd(spark).limit(0)).count() == 0


def test_parted_texts_have_the_ids_of_whole_ones():
    plain, small, r = plain_encoding(), byte_bpe.ByteBpe(limit=7), random.Random(1)
    marks = ["a", "B", "é", "1", "٣", " ", " ", "\n", "\t", "\r", "'", "'s", "'re", "!", "<", "　", "\xa0", " ", "\x1c", "北", "́", "𝔘", "'l"]
    for _ in range(4000):
        text = "".join(r.choice(marks) * r.choice([1, 1, 2, 3, 12, 30]) for _ in range(r.randrange(30)))
        assert small.encode(text.encode()).tolist() == plain.encode_ordinary(text)
        assert "".join(p for p, _ in byte_bpe.pieces(text, 7)) == text


@pytest.mark.parametrize("text", [" " * 1_200_000 + "x", "x" + "\n" * 1_100_000 + " x", "y" * 300_000, "ab " * 200_000])
def test_very_long_runs(text):
    bpe = byte_bpe.ByteBpe()
    assert bpe.decode(bpe.encode(text.encode())) == text.encode()


def upper_bits(spark, rows):
    """The buckets of contents, which order the rows of a repeated key."""
    df = spark.createDataFrame(sorted({r[1:] for r in rows}, key=str), "text string, lang string, source string").withColumn("id", F.lit(1))
    made = snapshots._signed(df, 1, "id", ["text", "lang", "source"], {"row": F.struct("text", "lang", "source")})
    return {tuple(r.row): r.bits for r in made.select(F.col("carry_0").alias("row"), F.shiftright(F.xxhash64("h"), 52).alias("bits")).collect()}


def brute_difference(spark, earlier, later):
    """Rows are (key, text, lang, source); rows of a repeated key pair in the operator's order of contents."""
    bits = upper_bits(spark, earlier + later) if earlier + later else {}
    same = Counter(earlier) & Counter(later)
    out = Counter((r[0], r[0], "same", "", r[1:]) for r in same.elements())
    digest = lambda r: [b"" if v is None else b"1" + hashlib.sha256(v.encode()).digest() for v in r[1:]]
    sides = []
    for rows in (earlier, later):
        groups = defaultdict(list)
        for r, n in (Counter(rows) - same).items():
            groups[r[0]] += [(bits[r[1:]], copy // snapshots.CHUNK, digest(r), r) for copy in range(n)]
        sides.append({k: [x[3] for x in sorted(g, key=lambda x: x[:3])] for k, g in groups.items()})
    left = [defaultdict(list), defaultdict(list)]
    for k in set(sides[0]) | set(sides[1]):
        a, b = sides[0].get(k, []), sides[1].get(k, [])
        for x, y in zip(a, b, strict=False):
            out[(k, k, "update", ",".join(c for c, v, w in zip(("text", "lang", "source"), x[1:], y[1:], strict=True) if v != w), y[1:])] += 1
        for side, rest in ((0, a[len(b) :]), (1, b[len(a) :])):
            for r in rest:
                left[side][r[1:]].append(r[0])
    order = lambda k: (k is not None, k or 0)
    for content in set(left[0]) | set(left[1]):
        a, b = sorted(left[0][content], key=order), sorted(left[1][content], key=order)
        n = min(len(a), len(b))
        out.update((y, x, "rekey", "", content) for x, y in zip(a, b, strict=False))
        out.update((x, x, "delete", "", None) for x in a[n:])
        out.update((y, None, "insert", "", content) for y in b[n:])
    return out


SCHEMA = "doc_id long, text string, lang string, source string"


def both(spark, earlier, later):
    one = spark.createDataFrame(earlier, SCHEMA).withColumn("h", F.lit("clash"))
    other = spark.createDataFrame(later, SCHEMA).withColumn("sign", F.lit("clash"))
    made = snapshots.difference(one, other, "doc_id", ["text", "lang", "source"], {"new": F.struct("text", "lang", "source")})
    return Counter((r["key"], r.old_key, r.op, r.changed, tuple(r.new) if r.new is not None else None) for r in made.collect())


@pytest.mark.parametrize("seed", range(3))
def test_difference_equals_plain_python(spark, seed):
    r = random.Random(seed)
    row = lambda: (r.choice([None, *range(12)]), r.choice([None, "", "a", "b", "c"]), r.choice([None, "en", "~"]), r.choice([None, "s"]))
    earlier, later = [row() for _ in range(120)], [row() for _ in range(130)]
    got = both(spark, earlier, later)
    assert got == brute_difference(spark, earlier, later)
    assert {x[2] for x in got} == {"same", "update", "rekey", "insert", "delete"}


def test_difference_of_large_groups(spark):
    """One content under very many keys, one key with very many rows, and one row very many times."""
    earlier = [(k, "x", "en", "s") for k in range(3000)] + [(-1, f"t{k}", "en", "s") for k in range(1500)] + [(-2, "y", "de", None)] * 2500
    later = [(10_000 + k, "x", "en", "s") for k in range(2500)] + [(-1, f"t{k}", "en", "s") for k in range(700, 2300)] + [(-2, "y", "de", None)] * 1200
    assert both(spark, earlier, later) == brute_difference(spark, earlier, later)


def test_difference_of_empty_tables_and_no_carry(spark):
    rows = [(1, "a", "en", None), (1, "a", "en", None), (None, None, None, None)]
    assert both(spark, rows, []) == brute_difference(spark, rows, [])
    assert both(spark, [], rows) == brute_difference(spark, [], rows)
    assert not both(spark, [], [])
    df = spark.createDataFrame(rows, SCHEMA)
    assert snapshots.difference(df, df, "doc_id", ["text"]).columns == ["key", "old_key", "op", "changed"]


def test_difference_of_other_types(spark):
    a = spark.createDataFrame([("k", 1.5, [1, 2]), ("l", None, None)], "name string, x double, v array<int>")
    b = spark.createDataFrame([("k", 1.5, [1, 3]), ("m", None, None)], "name string, x double, v array<int>")
    got = {(r["key"], r.old_key, r.op, r.changed) for r in snapshots.difference(a, b, "name", ["x", "v"]).collect()}
    assert got == {("k", "k", "update", "v"), ("m", "l", "rekey", "")}


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op13_snapshot_difference"])
def test_queries_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(columns).collect())))
    assert got == sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()))


def test_classifier_is_fitted_on_a_bounded_sample(spark, monkeypatch):
    """Ids that repeat very often, labels that repeat, and very long texts: what reaches the driver stays bounded."""
    ids = [k for k in range(90) if zlib.crc32(str(k).encode()) % 3 != 1][:30]
    rows = [(k, f"good words number {k} " * (1 + copy % 3), "clash") for k in ids for copy in range(40)] + [(ids[0], "long word " * 40_000, "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids] * 2 + [(ids[0], 1 - ids[0] % 2), (None, 1), (7777, 0), (ids[1], None)], "doc_id long, quality int")
    seen = {}
    fit = quality.fit

    def noted(bags, y, weight, passage_words):
        seen.update(n=len(bags), longest=max(map(len, bags)), y=y.tolist())
        return fit(bags, y, weight, passage_words)

    monkeypatch.setattr(quality, "fit", noted)
    model = quality.train(docs, labels, passage_words=16, fit_passages=50)
    assert seen["n"] == 31 and seen["longest"] <= 50
    monkeypatch.setattr(quality, "fit", fit)
    again = quality.train(docs.repartition(7), labels, passage_words=16, fit_passages=50)
    one, other = (sorted((r.doc_id, round(r.score, 9)) for r in quality.score(docs.limit(50), m).collect()) for m in (model, again))
    assert one == other
    empty = quality.train(docs.limit(0), labels.limit(0))
    assert {r.score for r in quality.score(docs.limit(3), empty).collect()} == {0.5} and quality.score(docs.limit(0), model).count() == 0
