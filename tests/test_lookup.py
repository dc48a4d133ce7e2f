"""Dictionaries and host lists against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import dictionary as D
from tessera.operators import hosts

TEXTS = [None, "", "Bank", "the bank note, BANK-note and bankers", "riverbank éBank bank_1 Bank", "İstanbul bank ﬁn", "a" * 5000, "x ab abab ab", "1bank 2 bank"]
ENTRIES = [D.Entry("note", "bank note"), D.Entry("bank", "Bank"), D.Entry("prefix", "bank", True, False), D.Entry("inside", "ab", False, False), D.Entry("again", "BANK"), D.Entry("none", "")]


def brute(text, entries):
    out = []
    low = D.lowered(text or "")
    for k, e in enumerate(entries):
        needle = D.lowered(e.text)
        rx = (r"(?<!\w)" if e.starts else "") + re.escape(needle) + (r"(?!\w)" if e.ends else "")
        out += [(m.start(), k, len(needle)) for m in re.finditer(f"(?={rx})", low)] if needle else []
    return [(k, e, n) for e, k, n in sorted(out)]


def test_hits_equal_brute_force(spark):
    r = random.Random(4)
    texts = TEXTS + ["".join(r.choice(["ab", "a", "b", " ", "é", "_", "Ba"]) for _ in range(r.randrange(40))) for _ in range(200)]
    entries = ENTRIES + [D.Entry(f"r{k}", "".join(r.choice("ab ") for _ in range(r.randrange(1, 5))).strip() or "b", bool(k % 2), bool(k % 3)) for k in range(12)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    for row in df.select("id", D.hits(F.col("text"), entries).alias("h")).collect():
        assert [(h.entry, h.start, h.length) for h in row.h] == brute(texts[row.id], entries), texts[row.id]
        assert all(h.name == entries[h.entry].name for h in row.h)


def test_rules_over_hits(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "id int, text string").withColumn("h", D.hits(F.col("text"), ENTRIES))
    rows = {r.id: r for r in df.select("id", D.first_entry(F.col("h")).alias("first"), D.names_found(F.col("h"), {"again": "bank"}, {"prefix": "note"}).alias("names"), D.outside_longer(F.col("h")).alias("outer")).collect()}
    assert rows[0].first == "" and rows[0].names == [] and rows[1].names == []
    assert rows[3].first == "note" and rows[3].names == ["note", "bank"]
    assert rows[2].first == "bank" and rows[2].names == ["bank", "prefix"]
    assert [h.name for h in rows[3].outer] == ["note", "bank", "prefix", "again", "prefix"]
    counts = {(r.id, r.name): (r.n, r.first) for r in D.count_by_name(df, ["id"], F.col("h")).collect()}
    assert counts[7, "inside"] == (4, 2) and counts[3, "bank"] == (2, 4)


def test_automaton_of_no_entries_and_bounds(spark):
    df = spark.createDataFrame([("x", "y")], "name string, text string")
    assert df.select(D.hits(F.col("text"), []).alias("h")).first().h == []
    assert D.entries_of(df, "name", "text") == [D.Entry("x", "y")]
    with pytest.raises(ValueError, match="phrases_by_join"):
        D.entries_of(df.union(df), "name", "text", most=1)


def test_join_finds_what_the_automaton_finds(spark):
    r, words = random.Random(8), ["ab", "cd", "é", "x_1", "Zz"]
    texts = [(k, " ".join(r.choice(words) for _ in range(r.randrange(30)))) for k in range(60)] + [(100, None), (101, "")]
    phrases = [(f"p{k}", " ".join(r.choice(words) for _ in range(r.randrange(1, 4)))) for k in range(15)] + [("none", ""), ("null", None)]
    df, table = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame(phrases, "name string, phrase string")
    joined = sorted((x.id, x.name) for x in D.phrases_by_join(df, ["id"], "text", table, "name", "phrase").collect())
    found = df.select("id", F.explode(D.hits(F.col("text"), D.entries_of(table, "name", "phrase"))).alias("h"))
    assert joined == sorted((x.id, x.name) for x in found.select("id", "h.name").collect())


def test_longest_suffix(spark):
    listed = spark.createDataFrame([("*.A.example", 1), ("example", 2), ("deep.b.example", 3), ("www.c.example", 4), (None, 5), ("", 6), (".example", 0), ("b.example.", 7)], "name string, rank int")
    index = hosts.suffix_index(listed, "name")
    assert {(r.suffix, r["rank"]) for r in index.collect()} == {("a.example", 1), ("example", 0), ("deep.b.example", 3), ("c.example", 4), ("b.example", 7)}
    names = ["x.a.example", "a.example", "xa.example", "Y.deep.b.example.", "c.example", "example.org", "", None, "www.b.example"] + ["hot.a.example"] * 500
    df = spark.createDataFrame([(k, n, "clash") for k, n in enumerate(names)], "id int, host string, kind string")
    got = {r.id: r.matched for r in hosts.longest_match(df, "host", index).collect()}
    assert [got[k] for k in range(9)] == ["a.example", "a.example", "example", "deep.b.example", "c.example", None, None, None, "b.example"]
    assert len(got) == len(names) and got[400] == "a.example"
    assert {r.id for r in hosts.not_under_list(df, "host", index).collect()} == {5, 6, 7}
    assert hosts.under_list(df, "host", index).count() == len(names) - 3
    assert hosts.longest_match(df, "host", index.limit(0)).filter("matched IS NULL").count() == len(names)
    by = {r.matched: (r.rows, r.hosts) for r in hosts.matches_by_list(df, "host", index, []).collect()}
    assert by["a.example"] == (502, 3)


def test_many_suffixes_equal_brute_force(spark):
    r = random.Random(6)
    name = lambda: ".".join(r.choice("abc") for _ in range(r.randrange(1, 5)))
    listed, own = sorted({name() for _ in range(40)}), [name() for _ in range(300)]
    index = hosts.suffix_index(spark.createDataFrame([(x,) for x in listed], "name string"), "name")
    got = hosts.longest_match(spark.createDataFrame(list(enumerate(own)), "id int, host string"), "host", index).collect()
    for row in got:
        fit = [x for x in listed if own[row.id] == x or own[row.id].endswith("." + x)]
        assert row.matched == (max(fit, key=len) if fit else None)
