"""Sources: delimited files, JSON logs, compressed members, saved pages, XML, sitemaps. Nothing infers a schema."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import files
from tessera.space import bounded_batches

HOP = "struct<status:int,url:string,location:string,error:string>"
#: D4: a scan record; fields that a mode lacks are null.
SCAN_RECORD = (
    "domain string, ts string, network string, mode string, "
    "home struct<final_url:string,status:int,title:string,text_len:int,mentions:int,links:int,js_buttons:int,error:string,moved_to:string>, "
    f"destinations array<struct<url:string,via:string,final_url:string,kind:string,brand:string,evidence:string,pid:string,ad_route:boolean,title:string,hops:array<{HOP}>>>, "
    "result struct<group:string,reason:string,other_brands:array<string>,pids:array<string>,unresolved:int>"
)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, comment: str | None = None) -> DataFrame:
    """SRC1, SRC12: quoted cells may hold line breaks; "" becomes null; comment is the first character of preamble lines."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", None).option("nullValue", "")
    return (reader.option("comment", comment) if comment else reader).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: a list file: trimmed, lower-cased, without blanks, comments and repeats."""
    line = F.lower(F.trim("value"))
    return spark.read.text(path).select(line.alias("value")).filter("value != '' AND NOT startswith(value, '#')").distinct()


def _places() -> list[Column]:
    """The file of a line, and its place in order of files: a struct of file, block of the file, and place in the block. A
    block is read by one task from its first line to its last; numbers of the whole read follow how Spark packs files."""
    return [F.col("_metadata.file_name").alias("file"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("ordinal")]


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    return lines.withColumn("r", F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))


def read_json_log(spark: SparkSession, path: str, schema: str = SCAN_RECORD) -> DataFrame:
    """SRC3, D3: JSON lines, plain or gzip, with file and ordinal; lines that are no record are left out.

    The ordinal is the place of a line in the order of the files' names and of the lines in them, and breaks ties of equal
    times: of two records of one key the later one in a file, or in a file of a later name, is the last.
    """
    parsed = _parsed(spark.read.text(path).select("value", *_places()), schema)
    return parsed.filter("r IS NOT NULL AND r._corrupt IS NULL").select("r.*", "file", "ordinal").drop("_corrupt")


def bad_lines(spark: SparkSession, path: str, schema: str = SCAN_RECORD) -> DataFrame:
    """SRC5: the lines that repair leaves out."""
    return _parsed(spark.read.text(path), schema).filter("r IS NULL OR r._corrupt IS NOT NULL").select("value")


def repair_log(spark: SparkSession, path: str, out: str, schema: str = SCAN_RECORD) -> int:
    """SRC5: write the whole lines of a log whose tail was cut off into the folder out and return their number; -1 if all
    lines are whole, and nothing is written. Files may hold several gzip members. The order of lines in a file is kept; the
    folder counts once its _SUCCESS is there."""
    lines = read_gzip_members(spark, path).filter("value <> ''") if path.endswith(".gz") else spark.read.text(path).filter("value <> ''")
    parsed = _parsed(lines, schema)
    whole = (F.col("r").isNotNull() & F.col("r._corrupt").isNull()).alias("whole")
    counts = parsed.agg(F.count("*").alias("n"), F.count_if(whole).alias("n_whole")).first()
    if counts["n"] == counts["n_whole"]:
        return -1
    parsed.filter(whole).select("value").write.mode("overwrite").option("compression", "gzip").text(out)
    return counts["n_whole"]


def gunzip_members(data: bytes) -> bytes:
    """SRC4: all whole gzip members and what can be read of the first broken one."""
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        try:
            out.append(d.decompress(data))
            if not d.eof:
                out.append(d.flush())
                break
        except zlib.error:
            break
        data = d.unused_data
    return b"".join(out)


def read_gzip_members(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: file, line_no and value of files of several gzip members whose tail may be cut off. Members are found and read
    in parallel; stores that Arrow does not know are read as whole files."""
    if files.known(path):
        return files.gzip_lines(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                text = gunzip_members(bytes(content)).decode("utf-8", "replace")
                lines = text.removesuffix("\n").split("\n") if text else []
                yield pd.DataFrame({"file": name, "line_no": range(len(lines)), "value": lines})

    bounded_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, line_no long, value string")


def read_saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC6, SRC7: domain and source from file names like domain__source.html.gz, the header comment's fields, and html.

    A file without header comment has null fields.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [(gunzip_members(bytes(c)) if bytes(c[:2]) == b"\x1f\x8b" else bytes(c)).decode("utf-8", "replace") for c in b["content"]]
            yield pd.DataFrame({"file": b["path"].map(lambda p: p.rsplit("/", 1)[-1]), "raw": texts})

    bounded_batches(spark)
    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, raw string")
    head = F.regexp_extract("raw", r"^(<!--[^\n]*-->)", 1)
    name = r"^(.+?)(?:__([A-Za-z0-9-]+))?\.html?(?:\.gz)?$"
    return raw.select(
        F.regexp_extract("file", name, 1).alias("domain"),
        F.coalesce(F.nullif(F.regexp_extract("file", name, 2), F.lit("")), F.lit("http")).alias("source"),
        F.nullif(F.regexp_extract(head, r"(\d{4}-\d\d-\d\dT[\d:]+)", 1), F.lit("")).alias("captured_at"),
        F.nullif(F.regexp_extract(head, r"status=(\d+)", 1), F.lit("")).try_cast("int").alias("status"),
        F.nullif(F.regexp_extract(head, r"final_url=(\S+)", 1), F.lit("")).alias("final_url"),
        F.regexp_replace("raw", r"^<!--[^\n]*-->\n?", "").alias("html"),
    )


def read_json_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC8: files that hold one JSON array each, with the file's rank by name and the place in its array as file_no and
    place. The window runs over a row for each file."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))
    files = raw.select("file").distinct().withColumn("file_no", F.row_number().over(Window.orderBy("file")).cast("long"))
    rows = raw.select("file", F.posexplode(F.from_json("value", T.ArrayType(T.StructType.fromDDL(schema)))).alias("place", "r"))
    return rows.join(files, "file").select("r.*", "file", "file_no", "place")


def read_batches(spark: SparkSession, path: str, schema: str, batch: str = "batch_id") -> DataFrame:
    """SNK4: the rows that sinks.write_batches has written, with their batch (long)."""
    if not files.moves_folders(path):
        return spark.read.json(path, schema=f"{schema}, {batch} long")
    rows = files.read_folders(spark, path).select(F.from_json("value", schema).alias("r"), F.regexp_extract("name", r"^batch-(.*)\.json$", 1).try_cast("long").alias(batch))
    return rows.select("r.*", batch)


def sheet_rows(handle) -> Iterator[list[str]]:
    """The rows of a workbook's first sheet as text, one at a time: dates in ISO form, whole numbers without a point, empty
    cells "". handle is a file that can seek."""
    import datetime as dt
    import re
    import zipfile
    from xml.etree import ElementTree as ET

    main = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    book = zipfile.ZipFile(handle)
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in si.iter(main + "t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(main + "si")]
    dated: list[bool] = []
    if "xl/styles.xml" in names:
        styles = ET.fromstring(book.read("xl/styles.xml"))
        codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(main + "numFmt")}
        own = {k for k, code in codes.items() if re.search("[ymdh]", re.sub(r'"[^"]*"|\\[[^]]*\\]', "", code.lower()))}
        for xfs in styles.iter(main + "cellXfs"):
            dated = [int(x.get("numFmtId", 0)) in own or 14 <= int(x.get("numFmtId", 0)) <= 22 for x in xfs.iter(main + "xf")]
    first = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))[0]
    for _, row in ET.iterparse(book.open(first)):
        if row.tag != main + "row":
            continue
        cells: list[str] = []
        for c in row.iter(main + "c"):
            letters = re.match("[A-Z]+", c.get("r", "") or "")
            at = len(cells)
            if letters:
                at = 0
                for x in letters[0]:
                    at = at * 26 + ord(x) - 64
                at -= 1
            cells += [""] * (at + 1 - len(cells))
            value, kind = c.findtext(main + "v") or "", c.get("t", "n")
            if kind == "s":
                value = shared[int(value)]
            elif kind == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(main + "t"))
            elif kind == "n" and value:
                style = int(c.get("s", 0))
                if style < len(dated) and dated[style]:
                    when = dt.datetime(1899, 12, 30) + dt.timedelta(seconds=round(float(value) * 86400))
                    value = when.isoformat(sep=" ")
                elif float(value).is_integer():
                    value = str(int(float(value)))
            cells[at] = value
        yield cells
        row.clear()


def read_xlsx(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """SRC2: the named columns (text) of the first sheet of each workbook, found by its first row; with file and row_no. A
    column that a sheet lacks is "". A workbook is read by one task, a row at a time; stores that Arrow does not know are
    read as whole files."""
    if files.known(path):
        return files.read_workbooks(spark, path, columns)
    schema = ", ".join([*(f"`{c}` string" for c in columns), "file string", "row_no long"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                rows = list(sheet_rows(io.BytesIO(bytes(content))))
                head = rows[0] if rows else []
                at = [head.index(c) if c in head else None for c in columns]
                out = [[r[k] if k is not None and k < len(r) else "" for k in at] + [name.rsplit("/", 1)[-1], n] for n, r in enumerate(rows[1:], 1)]
                yield pd.DataFrame(out, columns=[*columns, "file", "row_no"])

    bounded_batches(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def read_keyed_json(spark: SparkSession, path: str, value: str) -> DataFrame:
    """D13: a JSON object by key -> key, value; keys that start with "_" are notes."""
    raw = spark.read.text(path, wholetext=True)
    pairs = raw.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))
    return pairs.filter("NOT startswith(key, '_')")


#: D17: a captured answer document. Its root may have any name.
ANSWER_XML = (
    "response struct<_date:string, error:struct<_VALUE:string,_code:string>, "
    "results:struct<grouping:struct<group:array<struct<doc:array<struct<url:string,title:string>>>>>>, "
    "ai:struct<answer:string,item:array<struct<url:string,title:string,snippet:string>>>, "
    "relatedQuestions:struct<item:array<struct<question:string>>>>"
)


def parse_answers(raw: DataFrame, xml_col: str = "xml", results: int = 10) -> DataFrame:
    """SRC9, D17: captured answer documents, each parsed once: date, error, ai_present, answer (HTML), sources (url, title,
    snippet), organic (position, url, title; the first results) and related (questions).

    error is "code: text" of an error that the document reports, "xml" where it is none, "b64" where the answer is no base64;
    the other fields are null or empty then. Tags in titles are dropped; a result without title or url keeps its place.
    """
    schema = T.StructType.fromDDL(f"{ANSWER_XML}, _corrupt string")
    parsed = raw.withColumn("_x", F.from_xml(F.col(xml_col), schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    r = F.col("_x.response")
    broken = F.col(xml_col).isNotNull() & (F.col("_x").isNull() | F.col("_x._corrupt").isNotNull())
    none = lambda column, kind: F.coalesce(column, F.array().cast(f"array<{kind}>"))
    docs = none(F.flatten(F.transform(r["results"]["grouping"]["group"], lambda g: none(g["doc"], "struct<url:string,title:string>"))), "struct<url:string,title:string>")
    plain = lambda t: F.regexp_replace(F.coalesce(t, F.lit("")), "<[^>]+>", "")
    organic = F.transform(F.slice(docs, 1, results), lambda d, i: F.struct((i + 1).alias("position"), d["url"].alias("url"), plain(d["title"]).alias("title")))
    held = F.nullif(F.trim(r["ai"]["answer"]), F.lit(""))
    answer = F.try_to_binary(held, F.lit("base64"))
    reported = F.when(r["error"].isNotNull(), F.concat(F.coalesce(r["error"]["_code"], F.lit("")), F.lit(": "), F.substring(F.trim(F.coalesce(r["error"]["_VALUE"], F.lit(""))), 1, 200)))
    error = F.when(broken, "xml").otherwise(F.coalesce(reported, F.when(held.isNotNull() & answer.isNull(), "b64")))
    sources = F.transform(none(r["ai"]["item"], "struct<url:string,title:string,snippet:string>"), lambda i: F.struct(i["url"].alias("url"), F.trim(F.coalesce(i["title"], F.lit(""))).alias("title"), i["snippet"].alias("snippet")))
    related = F.transform(F.filter(none(r["relatedQuestions"]["item"], "struct<question:string>"), lambda q: q["question"].isNotNull()), lambda q: q["question"])
    return parsed.withColumns({
        "date": r["_date"], "error": error, "ai_present": r["ai"].isNotNull(), "answer": F.make_valid_utf8(answer.cast("string")), "sources": sources, "organic": organic, "related": related,
    }).drop("_x")


def struct_hops(hops: str = "hops") -> Column:
    """D6: chains stored as [[status, url], ...] become the struct form."""
    return F.transform(F.col(hops), lambda h: F.struct(F.get(h, 0).try_cast("int").alias("status"), F.get(h, 1).alias("url"), F.lit(None).cast("string").alias("location"), F.lit(None).cast("string").alias("error")))


def sitemap_pages(maps: DataFrame, depth: int = 3, per_level: int = 6, most: int = 50_000) -> DataFrame:
    """SRC11: pages of captured sitemaps (site, url, xml, root), nested maps followed at most depth levels, the first
    per_level of each; site, url, level and rank. The number of levels is fixed, so are the joins."""
    from tessera.functions.html import sitemap_locations

    found = maps.select("site", F.col("url").alias("map"), F.posexplode(sitemap_locations(F.col("xml"))).alias("place", "l")).select("site", "map", "place", "l.url", "l.is_map")
    level = maps.filter("root").select("site", F.col("url").alias("map"), F.row_number().over(Window.partitionBy("site").orderBy("url")).alias("_r"))
    out = None
    for k in range(depth):
        here = found.join(level, ["site", "map"])
        pages = here.filter("NOT is_map").select("site", "url", F.lit(k).alias("level"), F.col("_r").alias("map_no"), "place")
        out = pages if out is None else out.union(pages)
        rank = F.row_number().over(Window.partitionBy("site").orderBy("_r", "place"))
        level = here.filter("is_map").withColumn("_n", rank).filter(F.col("_n") <= per_level).select("site", F.col("url").alias("map"), F.col("_n").alias("_r"))
    first = out.groupBy("site", "url").agg(F.min(F.struct("level", "map_no", "place")).alias("o"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("site").orderBy("o", "url"))).filter(F.col("rank") <= most).select("site", "url", "o.level", "rank")
