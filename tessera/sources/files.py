"""Files that Spark's own formats do not read or write, as data sources: compressed members by byte ranges, workbooks, and
files of given bytes. Partitions are planned from names and sizes; tasks open files through Arrow's file systems."""

from __future__ import annotations

import io
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from tessera.space import broadcast_if_small, cut

#: Bytes that are read at once (of a member at first), and rows that are handed to Spark at once.
BLOCK, STEP, ROWS = 1 << 20, 1 << 14, 5000


def opened(path: str):
    """Arrow's file system and the path in it; raises ArrowInvalid for stores that Arrow does not know."""
    from pyarrow import fs

    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def known(path: str) -> bool:
    """Whether Arrow reaches the store of a path."""
    try:
        opened(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def listed(path: str, ending: str) -> list[tuple[str, int]]:
    """Name and size of the files under a path, or of the path itself, with an ending; hidden ones are left out."""
    from pyarrow import fs

    store, inner = opened(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else store.get_file_info(fs.FileSelector(inner, recursive=True))
    files = [(f.path, f.size) for f in found if f.is_file and f.path.endswith(ending)]
    hidden = lambda p: any(part.startswith(("_", ".")) for part in p[len(inner) :].split("/"))
    return sorted((p, n) for p, n in files if info.is_file or not hidden(p))


@dataclass
class Range(InputPartition):
    """Bytes start to stop of a file; members that begin there belong to it."""

    file: str
    start: int
    stop: int

    def __init__(self, file: str, start: int, stop: int):
        super().__init__(None)
        self.file, self.start, self.stop = file, start, stop


MEMBER_SCHEMA = "file string, start long, stop long, whole boolean, newlines long, piece long, value binary"


class _Members:
    """The gzip members that begin in a range of a file."""

    MAGIC = b"\x1f\x8b\x08"

    def __init__(self, handle, start: int, stop: int, size: int):
        self.handle, self.start, self.stop, self.size = handle, start, stop, size

    def candidates(self, at: int) -> Iterator[int]:
        """Places from at that look like a member's header. The caller may send a place to go on from."""
        step = STEP
        while at < self.stop:
            self.handle.seek(at)
            block = self.handle.read(min(step, self.stop - at) + 3)
            here = 0
            while (k := block.find(self.MAGIC, here)) >= 0 and k < step and at + k < self.stop:
                if k + 3 < len(block) and block[k + 3] & 0xE0:  # reserved flags
                    here = k + 1
                    continue
                on = yield at + k
                if on is not None and on > at + k + 1:
                    at, here, step = on, None, STEP
                    break
                here = k + 1
            if here is not None:
                at, step = at + step, min(2 * step, BLOCK)

    def pieces(self, at: int) -> Iterator[tuple[int | None, list[bytes] | int, bool]]:
        """(number of the first, lines, whether a line feed ends each) of a member that begins at a place, then (None, end,
        whole). What is read of a broken member is given out as well; an empty piece behind the last line feed is not. Members
        are often small, so blocks begin small."""
        inflate, rest, number, place, step = zlib.decompressobj(31), b"", 0, at, STEP
        self.handle.seek(at)
        while not inflate.eof:
            raw = self.handle.read(step)
            step = min(2 * step, BLOCK)
            try:
                text = inflate.decompress(raw) if raw else b""
            except zlib.error:
                text, raw = b"", b""
            *lines, rest = (rest + text).split(b"\n")
            if lines:
                yield number, lines, True
                number += len(lines)
            place += len(raw)
            if not raw:
                break
        if rest:
            yield number, [rest], False
        yield None, place - len(inflate.unused_data), inflate.eof


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.range_bytes = options["path"], int(options.get("rangeBytes", 32 << 20))
        self.tasks, self.edges = int(options.get("tasks", 0)), options.get("edges") == "true"

    def partitions(self) -> Sequence[InputPartition]:
        out, found = [], listed(self.path, ".gz")
        #: Small ranges of large files are read together: tasks follow the cores until one has to read 32 MB.
        size_of = self.range_bytes
        if self.tasks:
            size_of = max(size_of, min(32 << 20, -(-sum(size for _, size in found) // self.tasks)))
        for name, size in found:
            out += [Range(name, low, min(size, low + size_of)) for low in range(0, size, size_of)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        types = {"start": pa.int64(), "stop": pa.int64(), "whole": pa.bool_(), "newlines": pa.int64(), "piece": pa.int64(), "value": pa.binary()}
        columns: tuple[list, ...] = tuple([] for _ in types)
        held = 0

        def add(n: int, *values: list) -> None:
            for column, own in zip(columns, values, strict=True):
                column.extend(own if own is not None else [None] * n)

        def batch() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
            file = pa.repeat(pa.scalar(partition.file, pa.string()), len(columns[0]))
            for c in columns:
                c.clear()
            return pa.RecordBatch.from_arrays([file, *arrays], ["file", *types])

        store = opened(self.path)[0]
        with store.open_input_file(partition.file) as raw:
            members = _Members(io.BufferedReader(raw, BLOCK), partition.start, partition.stop, raw.size())
            search = members.candidates(partition.start)
            at = next(search, None)
            while at is not None:
                newlines, end, whole = 0, at, False
                for number, lines, flag in members.pieces(at):
                    if number is None:
                        end, whole = lines, flag
                        break
                    newlines = number + len(lines) * flag
                    if self.edges:  # the last one has no line feed, or follows the last line feed and is empty
                        lines = lines[: number == 0 or not flag]
                    for low in range(0, len(lines), ROWS):
                        own = lines[low : low + ROWS]
                        add(len(own), [at] * len(own), None, None, None, range(number + low, number + low + len(own)), own)
                        held += sum(map(len, own))
                        if len(columns[0]) >= ROWS or held >= BLOCK:
                            yield batch()
                            held = 0
                add(1, [at], [end], [whole], [newlines], None, None)
                if len(columns[0]) >= ROWS:
                    yield batch()
                    held = 0
                try:
                    at = search.send(end if whole else at + 1)
                except StopIteration:
                    at = None
        if columns[0]:
            yield batch()


class MemberSource(DataSource):
    """tessera_gzip_members: the lines of gzip members by file and the byte at which their member begins, and a row for the
    end of each (stop, whole, newlines). Option rangeBytes: a task looks for members in so many bytes, or in more (at most 32
    MB) where these would make more tasks than the option tasks says; edges: of the lines only the first and the last one of each member."""

    @classmethod
    def name(cls) -> str:
        return "tessera_gzip_members"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return MemberReader(self.options)


def _member_rows(spark: SparkSession, path: str, range_bytes: int, edges: bool) -> DataFrame:
    _register(spark)
    reader = spark.read.format(MemberSource.name()).option("path", path).option("rangeBytes", range_bytes)
    return reader.option("tasks", 4 * spark.sparkContext.defaultParallelism).option("edges", edges).load()


def _index(rows: DataFrame) -> DataFrame:
    ends = rows.filter("stop IS NOT NULL").select("file", "start", "stop", "whole", "newlines")
    before = Window.partitionBy("file").orderBy("start", F.col("whole").desc()).rowsBetween(Window.unboundedPreceding, -1)
    till = F.coalesce(F.max(F.when(F.col("whole"), F.col("stop"))).over(before), F.lit(0))
    placed = ends.withColumn("till", till).filter("start >= till")
    #: A gap: the place that members reach up to so far is not where this one begins.
    gap = F.max((F.col("start") > F.col("till")) | ~F.col("whole")).over(before)
    kept = placed.withColumn("broken", F.coalesce(gap, F.lit(False))).filter("start = till AND NOT broken")
    return kept.withColumn("base", F.coalesce(F.sum("newlines").over(before), F.lit(0))).drop("till", "broken")


def member_index(spark: SparkSession, path: str, range_bytes: int = 32 << 20) -> DataFrame:
    """SRC4, SRC5: the members of each file that count: file, start, stop, whole, newlines and base (line feeds before).

    Members follow each other from byte 0; the first place where no whole member begins ends the file, and what can be read
    of a broken member there still counts. What looks like a header inside a member is none. The window runs over a row for
    each member of one file.
    """
    return _index(_member_rows(spark, path, range_bytes, True))


def gzip_lines(spark: SparkSession, path: str, range_bytes: int = 32 << 20) -> DataFrame:
    """SRC4: file, line_no (from 0) and value of files of many gzip members, which may end in a broken one.

    Members are looked for in ranges of a file and inflated in parallel, a block at a time, so neither a file nor a member
    has to fit a task. A line may go on in the next member. Bytes that are no UTF-8 become the replacement character. Files are
    read twice: for the index and the lines at the edges of members, which are checkpointed, and for the lines between them.
    """
    found = cut(_member_rows(spark, path, range_bytes, True))
    index = broadcast_if_small(_index(found).select("file", "start", "newlines", "base"), 100_000)

    def pieces(rows: DataFrame) -> DataFrame:
        placed = rows.filter("stop IS NULL").select("file", "start", "piece", "value").join(index, ["file", "start"])
        return placed.withColumn("line_no", F.col("base") + F.col("piece"))

    edges = pieces(found).groupBy("file", "line_no").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["value"]))
    inner = pieces(_member_rows(spark, path, range_bytes, False)).filter("piece > 0 AND piece < newlines")
    lines = inner.select("file", "line_no", "value").unionByName(edges.select("file", "line_no", joined.alias("value")))
    return lines.withColumn("value", F.make_valid_utf8(F.col("value").cast("string")))


@dataclass
class Book(InputPartition):
    files: tuple[str, ...]

    def __init__(self, files: tuple[str, ...]):
        super().__init__(None)
        self.files = files


class BookReader(DataSourceReader):
    """Cells of the columns that the schema names; others are not built."""

    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.columns, self.task_bytes = options["path"], schema.names, int(options.get("taskBytes", 16 << 20))

    def partitions(self) -> Sequence[InputPartition]:
        groups: list[list[str]] = [[]]
        held = 0
        for name, size in listed(self.path, ".xlsx"):
            if groups[-1] and held + size > self.task_bytes:
                groups.append([])
                held = 0
            groups[-1].append(name)
            held += size
        return [Book(tuple(g)) for g in groups]

    def read(self, partition: Book) -> Iterator[pa.RecordBatch]:
        from tessera.sources.readers import sheet_rows

        schema = pa.schema([(c, pa.int64() if c == "row_no" else pa.string()) for c in self.columns])
        store = opened(self.path)[0]
        for name in partition.files:
            with store.open_input_file(name) as handle:
                head: list[str] | None = None
                rows: list[list] = []
                for number, cells in enumerate(sheet_rows(handle)):
                    if head is None:
                        head = cells
                        at = [head.index(c) if c in head else None for c in self.columns]
                        continue
                    own = {"file": name.rsplit("/", 1)[-1], "row_no": number}
                    rows.append([own[c] if c in own else cells[k] if k is not None and k < len(cells) else "" for c, k in zip(self.columns, at, strict=True)])
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class BookSource(DataSource):
    """tessera_workbook: rows of the first sheets of workbooks by the columns of the schema (text), which are found by the
    first row; file and row_no (long) are the file's name and the row's number. Option taskBytes: small workbooks are read
    together up to so many bytes."""

    @classmethod
    def name(cls) -> str:
        return "tessera_workbook"

    def schema(self) -> str:
        raise ValueError("name the columns: read.schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BookReader(self.options, schema)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, str], ...]


class FileWriter(DataSourceWriter):
    """Files of the rows of one name, one after another. A task writes beside the folder's files; only what the job takes is
    moved to its name, so that a task that runs twice leaves one file."""

    def __init__(self, options: dict[str, str]):
        self.path, self.own = options["path"], f"_writing-{uuid.uuid4().hex}"

    def _place(self):
        store, inner = opened(self.path)
        return store, inner.rstrip("/"), f"{inner.rstrip('/')}/{self.own}"

    def write(self, iterator: Iterator) -> Written:
        store, inner, beside = self._place()
        task, out, made = uuid.uuid4().hex, None, []
        store.create_dir(beside, recursive=True)
        try:
            for row in iterator:
                if not made or made[-1][1] != f"{inner}/{row['name']}":
                    if out is not None:
                        out.close()
                    made.append((f"{beside}/{task}-{len(made)}", f"{inner}/{row['name']}"))
                    out = store.open_output_stream(made[-1][0])
                out.write(bytes(row["content"] or b""))
        finally:
            if out is not None:
                out.close()
        return Written(tuple(made))

    def commit(self, messages: list) -> None:
        store, inner, beside = self._place()
        store.create_dir(inner, recursive=True)
        folders = set()
        for message in messages:
            for made, name in message.files if message else ():
                folder = name.rsplit("/", 1)[0]
                if folder not in folders:
                    store.create_dir(folder, recursive=True)
                    folders.add(folder)
                store.move(made, name)
        store.delete_dir_contents(beside, missing_dir_ok=True)
        if beside in {i.path for i in store.get_file_info([beside]) if i.type.name == "Directory"}:
            store.delete_dir(beside)

    def abort(self, messages: list) -> None:
        store, _, beside = self._place()
        store.delete_dir_contents(beside, missing_dir_ok=True)


class FileSink(DataSource):
    """tessera_files: rows of name, place and content (binary) as files."""

    @classmethod
    def name(cls) -> str:
        return "tessera_files"

    def schema(self) -> str:
        return "name string, place long, content binary"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options)


@dataclass
class Folders(InputPartition):
    """Folders whose files one task reads."""

    names: tuple[str, ...]

    def __init__(self, names: tuple[str, ...]):
        super().__init__(None)
        self.names = names


class BatchWriter(DataSourceArrowWriter):
    """Lines of folder and name, which come sorted by both, as files. A task writes whole folders beside the others; the job
    moves the folders of the tasks that it takes to their names, so that it moves and hears of no single file."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.own, self.overwrite = options["path"], f"_writing-{uuid.uuid4().hex}", overwrite

    def _place(self):
        store, inner = opened(self.path)
        return store, inner.rstrip("/"), f"{inner.rstrip('/')}/{self.own}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, inner, beside = self._place()
        task, out, last, made = uuid.uuid4().hex, None, None, {}
        try:
            for b in iterator:
                folders, names = b.column(0), b.column(1)
                text = b.column(2).cast(pa.large_binary())
                at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8) if len(text) else []
                data, low = text.buffers()[2], 0
                for high in pa.compute.run_end_encode(names).run_ends.to_pylist():
                    folder, name = folders[low].as_py(), names[low].as_py()
                    if (folder, name) != last:
                        if out is not None:
                            out.close()
                        if folder not in made:
                            made[folder] = f"{beside}/{task}/{folder}"
                            store.create_dir(made[folder], recursive=True)
                        out, last = store.open_output_stream(f"{made[folder]}/{name}"), (folder, name)
                    out.write(data[int(at[low]) : int(at[high])])
                    low = high
        finally:
            if out is not None:
                out.close()
        return Written(tuple((place, f"{inner}/{folder}") for folder, place in made.items()))

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        store, inner, beside = self._place()
        store.create_dir(inner, recursive=True)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(inner)):
                if old.path.rstrip("/") != beside:
                    store.delete_dir(old.path) if old.type == fs.FileType.Directory else store.delete_file(old.path)
        for message in messages:
            for made, name in message.files if message else ():
                store.move(made, name)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        store, _, beside = self._place()
        store.delete_dir_contents(beside, missing_dir_ok=True)
        if store.get_file_info(beside).type.name == "Directory":
            store.delete_dir(beside)


class BatchReader(DataSourceReader):
    """A task lists and reads the files of its folders, so that the driver lists folders alone."""

    def __init__(self, options: dict[str, str]):
        self.path, self.tasks = options["path"], int(options.get("tasks", 32))

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        store, inner = opened(self.path)
        found = store.get_file_info(fs.FileSelector(inner))
        names = sorted(f.path for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith(("_", ".")))
        each = max(1, -(-len(names) // self.tasks))
        return [Folders(tuple(names[k : k + each])) for k in range(0, len(names), each)] or [Folders(())]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store = opened(self.path)[0]
        names: list[str] = []
        lines: list[bytes] = []
        held = 0

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.binary()).cast(pa.string())], ["name", "value"])
            names.clear()
            lines.clear()
            return made

        for folder in partition.names:
            for name in sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.is_file):
                own, rest = name.rsplit("/", 1)[-1], b""
                with store.open_input_stream(name) as handle:
                    while raw := handle.read(BLOCK):
                        *found, rest = (rest + raw).split(b"\n")
                        lines += found
                        names += [own] * len(found)
                        held += len(raw)
                        if len(lines) >= ROWS or held >= BLOCK:
                            yield batch()
                            held = 0
                if rest:
                    lines.append(rest)
                    names.append(own)
        if lines:
            yield batch()


class BatchSource(DataSource):
    """tessera_batches: lines of small files in folders. Written from folder, name and line (which ends in a line feed); read
    as name and value. Option tasks: about so many tasks read."""

    @classmethod
    def name(cls) -> str:
        return "tessera_batches"

    def schema(self) -> str:
        return "name string, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BatchReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return BatchWriter(self.options, overwrite)


def moves_folders(path: str) -> bool:
    """Whether Arrow reaches the store of a path and moves a folder there in one step."""
    return known(path) and opened(path)[0].type_name in ("local", "hdfs")


def _register(spark: SparkSession) -> None:
    for source in (MemberSource, BookSource, FileSink, BatchSource):
        spark.dataSource.register(source)


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content", place: str = "place") -> None:
    """Files under path: the contents (binary or text) of the rows of one name, one after another by place. A file is
    written by one task, a row at a time; rows without name are left out, null contents are empty."""
    _register(df.sparkSession)
    rows = df.filter(F.col(name).isNotNull()).select(F.col(name).alias("name"), F.col(place).cast("long").alias("place"), F.col(content).cast("binary").alias("content"))
    rows.repartition("name").sortWithinPartitions("name", "place").write.format(FileSink.name()).mode("append").option("path", path).save()


def read_workbooks(spark: SparkSession, path: str, columns: Sequence[str], task_bytes: int = 16 << 20) -> DataFrame:
    """SRC2: the named columns (text) of the first sheet of each workbook, with file and row_no. A column that a sheet lacks
    is "", dates are in ISO form."""
    _register(spark)
    schema = ", ".join([*(f"`{c}` string" for c in columns), "file string", "row_no long"])
    return spark.read.format(BookSource.name()).schema(schema).option("taskBytes", task_bytes).load(path)


def write_lines(df: DataFrame, path: str, folder: str, name: str, line: str) -> None:
    """Lines (text) in files by folder and name under path, whose earlier files go. A folder is written by one task, a batch
    of lines at a time."""
    _register(df.sparkSession)
    rows = df.select(F.col(folder).cast("string").alias("folder"), F.col(name).cast("string").alias("name"), F.concat(F.col(line), F.lit("\n")).alias("line"))
    rows.repartition("folder").sortWithinPartitions("folder", "name").write.format(BatchSource.name()).mode("overwrite").option("path", path).save()


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """name (of the file) and value of the lines of the files in the folders under path."""
    _register(spark)
    return spark.read.format(BatchSource.name()).option("path", path).option("tasks", 4 * spark.sparkContext.defaultParallelism).load()
