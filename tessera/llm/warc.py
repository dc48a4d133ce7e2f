"""Legacy archives to WARC: ARC records are parsed by their version's header line and declared length, and rewritten.

An ARC file starts with a version block that names the fields of its header lines: five in version 1, ten in version 2.
Identifiers, timestamps, types and digests of the WARC records are synthesised from what the ARC record holds, so the
same input always gives the same archive.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, cut, scratch, small_batches

#: The header fields of both ARC versions, in order.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Between WARC records; Spark's text writer puts it after each.
RECORD_END = b"\r\n\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _field(text: str | None) -> str:
    """A header field holds no white space and is not empty."""
    return "".join(f"%{b:02X}" if b <= 0x20 or b == 0x7F else chr(b) for b in (text or "").encode("utf-8")).encode("latin-1").decode("utf-8", "replace") or "-"


def write_arc(records: list[dict], version: int = 1, name: str = "pages.arc", date: str = "19700101000000") -> bytes:
    """An ARC file. A record: url, ip, date (14 digits), type, content (bytes); version 2 also takes status."""
    block = f"{version} 0 tessera\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 " + name
    out = [f"filedesc://{name} 0.0.0.0 {date} text/plain{extra} {len(block)}\n".encode(), block, b"\n"]
    at = sum(map(len, out))
    for r in records:
        content = r["content"]
        extra = "" if version == 1 else f" {r.get('status', 200)} - - {at} {name}"
        line = f"{_field(r['url'])} {_field(r.get('ip') or '0.0.0.0')} {r.get('date') or date} {_field(r.get('type') or 'no-type')}{extra} {len(content)}\n".encode()
        out += [line, content, b"\n"]
        at += len(line) + len(content) + 1
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of every record after the version block.

    Raises ValueError where a header line has not the version's fields or less is left than the declared length.
    """
    fields: tuple[str, ...] = ARC_FIELDS[1]
    at, first = 0, True
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line ends after byte {at}")
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        if not line:
            at = end + 1
            continue
        parts = line.split(" ")
        if first:  # the first line's last part is its length in either version
            content = data[end + 1 : end + 1 + int(parts[-1])]
            head = content.split(b"\n")
            version = int(head[0].split()[0])
            fields = ARC_FIELDS[version]
            named = tuple(head[1].decode().split()) if len(head) > 1 and head[1].strip() else fields
            if named != fields or len(parts) != len(fields):
                raise ValueError(f"version {version} has other header fields: {named}")
            at, first = end + 1 + int(parts[-1]), False
            continue
        if len(parts) != len(fields):
            raise ValueError(f"a header line has {len(parts)} fields: {line[:200]}")
        header = dict(zip(fields, parts, strict=True))
        size = int(header["Archive-length"])
        content = data[end + 1 : end + 1 + size]
        if len(content) < size:
            raise ValueError(f"{size} bytes declared, {len(content)} left")
        yield header, content
        at = end + 1 + size


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload; a content that is no HTTP response has no header."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    end = content.find(b"\r\n\r\n")
    return (content, b"") if end < 0 else (content[: end + 4], content[end + 4 :])


def record_id(key: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}:{digest}')}>"


def warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def to_warc(header: dict[str, str], content: bytes, key: str, refers_key: str | None = None, extra: list[tuple[str, str]] | None = None) -> bytes:
    """A WARC record without RECORD_END. With refers_key it is a revisit: the HTTP header alone, no payload."""
    http, payload = split_http(content)
    digest = hashlib.sha256(payload).hexdigest()
    block = http if refers_key is not None else content
    kind = "revisit" if refers_key is not None else "response" if http else "resource"
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key, digest)), ("WARC-Date", warc_date(header["Archive-date"])), ("WARC-Target-URI", header["URL"]), ("WARC-IP-Address", header["IP-address"])]
    if refers_key is not None:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_key, digest))]
    lines += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    lines += extra or []
    lines += [("Content-Type", "application/http; msgtype=response" if http else header["Content-type"]), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def warc_info(name: str) -> bytes:
    block = b"software: tessera\r\nformat: WARC File Format 1.1\r\n"
    lines = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name, "info")), ("WARC-Date", warc_date("19700101")), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def parse_warc(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, by declared lengths."""
    data, at = bytes(data), 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record starts at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        header = dict(x.split(": ", 1) for x in lines)
        size = int(header["Content-Length"])
        if end + 4 + size > len(data):
            raise ValueError(f"{size} bytes declared, {len(data) - end - 4} left")
        yield header, data[end + 4 : end + 4 + size]
        at = end + 4 + size + len(RECORD_END)


def _files(records: Iterator[bytes], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Records gathered into archive files: a value each, which begins with a warcinfo record and holds at most file_bytes,
    or one record that is longer."""
    held, size = [warc_info("pages")], 0

    def whole() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([RECORD_END.join(held)], pa.binary())], ["value"])

    for r in records:
        if size and size + len(r) > file_bytes:
            yield whole()
            held, size = [warc_info("pages")], 0
        held.append(r)
        size += len(r)
    if size:
        yield whole()


def _converter(version: int, file_bytes: int):
    """page_id, url, html (binary), refers_to -> value (binary): archive files, by way of ARC records in memory."""

    def one(page: int | None, url: str | None, html: bytes, refers: int | None) -> bytes:
        arc = write_arc([{"url": url, "type": "text/html", "content": b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html) + html}], version)
        header, content = next(parse_arc(arc))
        extra = [("X-Page-ID", "-" if page is None else str(page))]
        if refers is not None:
            extra.append(("X-Refers-To-Page-ID", str(refers)))
        return to_warc(header, content, str(page), None if refers is None else str(refers), extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _files((one(page, url, html or b"", refers) for page, url, html, refers in rows), file_bytes)

    return run


def _write_files(values: DataFrame, path: str) -> None:
    """A file for each value. The writer keeps the bytes of a string as they are."""
    values.select(F.col("value").cast("string").alias("value")).write.option("lineSep", RECORD_END.decode()).option("maxRecordsPerFile", 1).text(path)


def _arc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, line (binary) of files one after another, in order -> their records. Holds one record and one batch of output."""
    names = ["file", "record_no", "version", "url", "ip", "date", "type", "content"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]
    out: list[tuple] = []
    room = 0
    file = fields = header = None
    held, size, wanted, number = [], 0, 0, 0

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    for b in batches:
        for name, line in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if name != file:
                if header is not None:
                    raise ValueError(f"{file}: {wanted} bytes declared, {size} left")
                file, fields, number = name, None, 0
            line = line.as_py() or b""
            if header is None:
                text = line.rstrip(b"\r").decode("utf-8", "replace")
                if not text:
                    continue
                parts = text.split(" ")
                if fields is not None and len(parts) != len(fields):
                    raise ValueError(f"{file}: a header line has {len(parts)} fields: {text[:200]}")
                header, held, size, wanted = parts, [], 0, int(parts[-1])
                if wanted:
                    continue
            else:
                held += [line, b"\n"]
                size += len(line) + 1
                if size < wanted:
                    continue
            content = b"".join(held)
            if content[wanted:] not in (b"", b"\n"):
                raise ValueError(f"{file}: a record is longer than the {wanted} bytes declared")
            content = content[:wanted]
            if fields is None:
                head = content.split(b"\n")
                fields = ARC_FIELDS[int(head[0].split()[0])]
                if len(header) != len(fields) or (len(head) > 1 and head[1].strip() and tuple(head[1].decode().split()) != fields):
                    raise ValueError(f"{file}: its version has other header fields")
            else:
                h = dict(zip(fields, header, strict=True))
                out.append((file, number, 1 if fields == ARC_FIELDS[1] else 2, h["URL"], h["IP-address"], h["Archive-date"], h["Content-type"], content))
                number, room = number + 1, room + wanted
                if room >= 4_000_000:
                    yield batch()
                    out, room = [], 0
            header = None
    if header is not None:
        raise ValueError(f"{file}: {wanted} bytes declared, {size} left")
    if out:
        yield batch()


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """ARC files of either version, plain or gzip (a member per record or not): file, record_no, version, url, ip, date, type
    and content of every record after the version block.

    Lines are dealt by file and sorted by their places, so a file may be split when it is read, and a task holds one record
    at a time, whatever the size of the file. Raises ValueError where a header line has not the version's fields or a file
    ends before a declared length.
    """
    small_batches(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    ordered = lines.repartition("file").sortWithinPartitions("file", "block", "place").select("file", "line")
    return ordered.mapInArrow(_arc_records, "file string, record_no long, version int, url string, ip string, date string, type string, content binary")


def convert_arc(spark: SparkSession, path: str, out: str, file_bytes: int = 32_000_000) -> None:
    """Write the records of ARC files as WARC files into the folder out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        made = (to_warc({"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind}, content, f"{file}#{n}") for file, n, _, url, ip, date, kind, content in rows)
        yield from _files(made, file_bytes)

    _write_files(read_arc(spark, path).mapInArrow(run, "value binary"), out)


def revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, refers_to of the pages whose payload of at least so many bytes a page with a smaller id holds as well."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("p"))
    digests = own.filter(F.octet_length("p") >= least).select("page_id", F.sha2("p", 256).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    return digests.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def archive_pages(pages: DataFrame, path: str, version: int = 1, least: int = 100, file_bytes: int = 32_000_000, broadcast_rows: int = 200_000) -> None:
    """Write pages as WARC files into the folder path, one record per row, each file starting with a warcinfo record and
    holding at most file_bytes, or one record that is longer. Null html is an empty payload, a null url is written as "-"."""
    small_batches(pages.sparkSession)
    again = broadcast_if_small(cut(revisits(pages, least)), broadcast_rows)
    again = again.withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))
    same = own.page_id.eqNullSafe(F.col("_page")) & (F.sha2("html", 256) == F.col("_digest"))
    records = own.join(again, same, "left").select("page_id", "url", "html", "refers_to").mapInArrow(_converter(version, file_bytes), "value binary")
    _write_files(records, path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column(0):
            rows = []
            for header, block in parse_warc(data.as_buffer().to_pybytes()):
                if header["WARC-Type"] == "warcinfo":
                    continue
                http, payload = split_http(block)
                declared = header["WARC-Payload-Digest"].split(":", 1)[1]
                if header["WARC-Type"] == "revisit":
                    size = int(http.lower().split(b"content-length: ")[1].split(b"\r\n")[0])
                    digest = declared
                else:
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    if digest != declared:
                        raise ValueError(f"payload of {header['WARC-Record-ID']} has another digest")
                page, refers = header["X-Page-ID"], header.get("X-Refers-To-Page-ID")
                rows.append((None if page == "-" else int(page), size, digest, header["WARC-Type"], None if refers is None else int(refers)))
            if rows:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record but warcinfo; digests are checked. A file
    is read whole; a task is dealt files of spark.sql.files.maxPartitionBytes at most, or one."""
    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, version: int = 1) -> DataFrame:
    """Write pages as WARC files in the shared folder and read them back. Of rows with equal payloads of at least 100
    bytes the smallest page_id is the response (all rows that repeat it) and the others are revisits; a null page_id is
    never the one referred to. An empty table gives no rows; other columns are not looked at."""
    path = scratch(pages.sparkSession, "warc")
    archive_pages(pages, path, version)
    return read_archives(pages.sparkSession, path)


#: What round_trip gives for pages.
SQL = """
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM (SELECT page_id, h, CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
"""
