"""Files that Spark's own formats do not know: members of gzip files, workbooks, files of given bytes."""

import datetime as dt
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import files, readers, sinks


@pytest.fixture(scope="module")
def members():
    r = random.Random(1)
    lines = [f"line {i} " + "é" * r.randrange(30) + str(r.random()) for i in range(800)]
    data = "\n".join(lines).encode() + b"\n"
    cuts = [0, *sorted(r.sample(range(len(data)), 25)), len(data)]  # lines and characters go on in the next member
    return lines, [gzip.compress(data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def put(folder, name, parts):
    (folder / name).write_bytes(b"".join(parts))


@pytest.mark.parametrize("range_bytes", [700, 1 << 25])
def test_members_of_damaged_files(spark, tmp_path, members, range_bytes):
    lines, parts = members
    flipped = bytearray(parts[5])
    flipped[len(flipped) // 2] ^= 0xFF
    nested = gzip.compress(b"nested\n" * 10)
    put(tmp_path, "whole.gz", parts)
    put(tmp_path, "stored.gz", [gzip.compress(nested * 3, 0), gzip.compress(b"end\n")])
    put(tmp_path, "flipped.gz", parts[:5] + [bytes(flipped)] + parts[6:])
    put(tmp_path, "cut.gz", parts[:7] + [parts[7][: len(parts[7]) // 2]])
    put(tmp_path, "gap.gz", parts[:3] + [b"junk"] + parts[3:])
    put(tmp_path, "empty.gz", [])
    put(tmp_path, "garbage.gz", [b"no member at all"])
    put(tmp_path, "other.txt", [b"not read"])
    found = {}
    for r in files.gzip_lines(spark, f"file:{tmp_path}", range_bytes).collect():
        assert r.line_no not in found.setdefault(os.path.basename(r.file), {})
        found[os.path.basename(r.file)][r.line_no] = r.value
    assert [found["whole.gz"][k] for k in range(len(lines))] == lines and len(found["whole.gz"]) == len(lines)
    for name in ("stored", "flipped", "cut", "gap"):
        text = readers.gunzip_members((tmp_path / f"{name}.gz").read_bytes()).decode("utf-8", "replace")
        assert [found[f"{name}.gz"][k] for k in range(len(found[f"{name}.gz"]))] == text.removesuffix("\n").split("\n")
    assert set(found) == {"whole.gz", "stored.gz", "flipped.gz", "cut.gz", "gap.gz"}
    index = files.member_index(spark, str(tmp_path), range_bytes).groupBy("file").agg(F.count("*").alias("n"), F.count_if("whole").alias("whole"), F.max("stop").alias("stop")).collect()
    by = {os.path.basename(r.file): r for r in index}
    assert by["whole.gz"].n == by["whole.gz"].whole == len(parts) and by["whole.gz"].stop == sum(map(len, parts))
    assert (by["flipped.gz"].n, by["flipped.gz"].whole, by["gap.gz"].n) == (6, 5, 3)


def test_a_member_larger_than_a_range(spark, tmp_path):
    lines = [str(random.Random(k).random()) for k in range(200_000)]
    put(tmp_path, "one.gz", [gzip.compress("\n".join(lines).encode()), gzip.compress(b"\nlast")])
    got = files.gzip_lines(spark, str(tmp_path), 100_000)
    assert got.agg(F.count("*"), F.max("line_no")).first() == (200_001, 200_000)
    assert got.filter("line_no IN (7, 199999, 200000)").orderBy("line_no").select("value").collect() == [(lines[7],), (lines[-1],), ("last",)]


def test_missing_and_empty_folders(spark, tmp_path):
    assert files.gzip_lines(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        files.gzip_lines(spark, f"{tmp_path}/nowhere").count()


def test_files_of_given_bytes(spark, tmp_path):
    rows = [("a.bin", 2, b"\x00\xff"), ("a.bin", 1, b"first"), ("b", 1, None), ("sub/c", 1, b"c"), (None, 1, b"x")]
    path = f"file://{tmp_path}/out"
    files.write_files(spark.createDataFrame(rows, "name string, place int, content binary"), path)
    assert (tmp_path / "out/a.bin").read_bytes() == b"first\x00\xff"
    assert (tmp_path / "out/b").read_bytes() == b"" and (tmp_path / "out/sub/c").read_bytes() == b"c" and not list((tmp_path / "out").glob("_writing*"))
    files.write_files(spark.createDataFrame([("d", 1, "text é")], "name string, place int, content string"), path)
    assert (tmp_path / "out/d").read_text() == "text é" and (tmp_path / "out/a.bin").exists()


def test_workbooks(spark, tmp_path):
    rows = [("x.xlsx", k, f"<{k}> &", k / 4, dt.datetime(2024, 1, 1, 6) + dt.timedelta(days=k) if k % 2 else None, None) for k in range(40)] + [("y.xlsx", 1, "  é ", 5.0, None, "z")]
    df = spark.createDataFrame(rows, "book string, n int, text string, number double, seen timestamp, rare string")
    path = f"file://{tmp_path}/books"
    sinks.write_workbooks(df, path, "book", "n", ["n", "text", "number", "seen", "rare"])
    got = readers.read_xlsx(spark, path, ["rare", "text", "seen", "number", "absent"]).orderBy("file", "row_no").collect()
    assert len(got) == 41 and got[0].asDict() == {"rare": "", "text": "<0> &", "seen": "", "number": "0", "absent": "", "file": "x.xlsx", "row_no": 1}
    assert got[1].seen == "2024-01-02 06:00:00" and got[1].number == "0.25" and got[40].text == "  é " and got[40].rare == "z"
    one = files.read_workbooks(spark, path, ["text"], task_bytes=1)
    assert one.columns == ["text", "file", "row_no"] and one.rdd.getNumPartitions() == 2 and one.count() == 41


def test_gzipped_is_the_same_each_time(spark):
    df = spark.createDataFrame([("abc",), (None,)], "t string").select(sinks.gzipped(F.col("t")).alias("a"), sinks.gzipped(F.col("t")).alias("b")).collect()
    assert gzip.decompress(df[0].a) == b"abc" and df[0].a == df[0].b and df[1].a is None


@pytest.mark.parametrize("most, longest, partitions", [(1, 3, 3), (20, 12, 7), (100, 130, 5), (900, 40, 9), (100_000, 40, 4)])
def test_markdown_parts_equal_one_pass(spark, tmp_path, most, longest, partitions):
    r = random.Random(most)
    lines = ["é" * r.randrange(longest) if r.random() < 0.9 else "" for _ in range(700)]
    df = spark.createDataFrame([(k, x or None, "clash") for k, x in enumerate(lines)], "k int, line string, at string").repartitionByRange(partitions, "k").sortWithinPartitions("k")
    n = sinks.write_markdown_parts(df, str(tmp_path / "report"), "line", most=most)
    expected = list(sinks.markdown_parts(lines, most))
    assert n == len(expected)
    assert [(tmp_path / f"report/part-{k:03d}.md").read_text() for k in range(1, n + 1)] == expected
    assert len([p for p in os.listdir(tmp_path / "report") if p.startswith("part-")]) == n


def test_markdown_parts_of_empty_frames_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(k, "x" * 9) for k in range(50)], "k int, line string")
    assert sinks.write_markdown_parts(df.filter("k < 0"), str(tmp_path / "none"), "line") == 0
    holes = df.repartitionByRange(5, "k").sortWithinPartitions("k").filter("k < 8 OR k >= 45")  # partitions without rows
    assert sinks.write_markdown_parts(holes, str(tmp_path / "holes"), "line", "p", 40) == 4
    assert (tmp_path / "holes/p-002.md").read_text() == "\n".join(["x" * 9] * 4)


def test_markdown_steps_stay_few_where_greedy_cuts_meet():
    import numpy as np

    steps = sinks._steps(np.array([random.Random(k).randrange(1, 200) for k in range(20_000)]), 10_000)
    assert len(steps[0]) < 1000 and steps[0][-1] == 10_000


def test_batches_are_files_in_few_folders(spark, tmp_path):
    df = spark.range(2_604).selectExpr("id", "IF(id % 3 = 0, NULL, concat('é\n', id)) AS v", "IF(id = 2603, NULL, id DIV 2) AS b")
    path = f"file://{tmp_path}/out"
    sinks.write_batches(df.limit(9), path, "b")
    sinks.write_batches(df, path, "b")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["batches-0", "batches-1", "batches-2", "batches-null"]
    names = {p.name for p in (tmp_path / "out").rglob("*.json")}
    assert names == {f"batch-{k}.json" for k in [*range(1_302), "null"]}
    assert (tmp_path / "out/batches-1/batch-501.json").read_text().splitlines().count('{"id":1002}') == 1
    got = readers.read_batches(spark, path, "id long, v string", "b")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect())) and got.schema["b"].dataType.typeName() == "long"
    sinks.write_batches(df.filter("id < 0"), path, "b")
    assert readers.read_batches(spark, path, "id long, v string", "b").count() == 0


def test_many_small_ranges_are_few_tasks_and_small_reads(tmp_path):
    lines = [f"{k} é" for k in range(6_000)]
    text = "\n".join(lines).encode()
    put(tmp_path, "a.gz", [gzip.compress(text[low : low + 97]) for low in range(0, len(text), 97)])
    size = os.path.getsize(tmp_path / "a.gz")
    options = {"path": str(tmp_path), "rangeBytes": "64"}
    found = {}
    for tasks, most in (("0", size), ("6", 6)):
        reader = files.MemberReader({**options, "tasks": tasks})
        ranges = reader.partitions()
        assert len(ranges) <= most and [r.start for r in ranges[1:]] == [r.stop for r in ranges[:-1]] and ranges[-1].stop == size
        found[tasks] = [tuple(r.values()) for x in ranges for b in reader.read(x) for r in b.to_pylist()]
        newlines = {r[1]: r[4] for r in found[tasks] if r[2] is not None}
        edges = files.MemberReader({**options, "tasks": tasks, "edges": "true"})
        assert [tuple(r.values()) for x in edges.partitions() for b in edges.read(x) for r in b.to_pylist()] == [r for r in found[tasks] if r[5] in (None, 0, newlines[r[1]])]
    assert found["0"] == found["6"] and b"".join(r[6] + b"\n" for r in found["6"] if r[6] is not None).replace(b"\n", b"") == text.replace(b"\n", b"")

    class Counted:
        at = read_bytes = 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.read_bytes += len(block := data[self.at : self.at + n])
            self.at += len(block)
            return block

    data = b"".join(gzip.compress(text) for _ in range(200))
    handle = Counted()
    members = files._Members(handle, 0, len(data), len(data))
    search, n = members.candidates(0), 0
    at = next(search, None)
    while at is not None:
        *_, (_, end, whole) = members.pieces(at)
        n += whole
        try:
            at = search.send(end)
        except StopIteration:
            at = None
    assert n == 200 and handle.read_bytes < 8 * len(data)
