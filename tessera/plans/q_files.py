"""Sources and sinks: files written into the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import keyed, tables
from tessera.plans.inputs import GRID, grid, pick, read, spread, sql_pick
from tessera.plans.registry import query
from tessera.functions import url as U
from tessera.sources import files, readers, sinks
from tessera.space import scratch
from tessera.streaming import latest as stream


@query("""SELECT p_partkey, p_name || ' "q", x' || chr(10) || 'y' AS name, CASE WHEN p_size > 25 THEN p_size END AS size, 'a b' AS tags FROM part""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, SNK1: cells with quotes, commas and line breaks, nulls and arrays, written and read back."""
    path = scratch(spark, "csv")
    own = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(' "q", x\ny')).alias("name"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("size"), F.array(F.lit("a"), F.lit("b")).alias("tags"))
    sinks.write_csv(own, path)
    return readers.read_csv(spark, path, "p_partkey long, name string, size int, tags string")


@query("SELECT p_partkey, p_brand FROM part")
def csv_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC12: a table behind lines of remarks."""
    path = scratch(spark, "preamble")
    own = read(spark, sf_dir, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand").alias("value"))
    head = spark.sql("SELECT * FROM VALUES ('// export of a table', 0), ('// two remarks', 1), ('p_partkey,p_brand', 2) AS (value, n)").orderBy("n").select("value")
    #: A small table in one file, as such exports are.
    head.union(own).coalesce(1).write.text(path)
    return readers.read_csv(spark, path, "p_partkey long, p_brand string", comment="/")


@query("""
SELECT 'parts-' || lpad((p_partkey // 200)::VARCHAR, 6, '0') || '.xlsx' AS file, row_number() OVER (PARTITION BY p_partkey // 200 ORDER BY p_partkey) AS row_no, p_partkey::VARCHAR AS number,
  coalesce(p_name, '') || ' <&> "q"' AS name, CASE WHEN p_size % 2 = 0 THEN strftime(TIMESTAMP '2024-01-01 12:00:00' + INTERVAL 1 DAY * p_size, '%Y-%m-%d %H:%M:%S') ELSE '' END AS seen, '' AS lacking
FROM part
""")
def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2: parts in workbooks of two hundred rows, read back by the columns asked for: dates in ISO form, empty cells and
    lacking columns as empty texts."""
    path = scratch(spark, "xlsx")
    day = F.expr("make_timestamp(2024, 1, 1, 12, 0, 0) + make_interval(0, 0, 0, p_size)")
    name = F.concat(F.lit("parts-"), F.lpad(F.floor(F.col("p_partkey") / 200).cast("string"), 6, "0"), F.lit(".xlsx"))
    own = read(spark, sf_dir, "part").select(
        name.alias("book"), F.col("p_partkey").alias("number"), F.concat(F.coalesce("p_name", F.lit("")), F.lit(' <&> "q"')).alias("name"),
        F.when(F.col("p_size") % 2 == 0, day).alias("seen"), F.col("p_brand").alias("unread"),
    )
    sinks.write_workbooks(own, path, "book", "number", ["number", "unread", "name", "seen"])
    return readers.read_xlsx(spark, path, ["number", "name", "seen", "lacking"])


LOG = "domain string, ts string, n long"
S_LOG = """log AS (SELECT 'd' || user_id % 97 AS domain, strftime(ts, '%Y-%m-%d') AS ts, event_id AS n, event_id % 50 = 7 AS cut,
  'log-' || 9 - event_id % 3 || '-' || lpad((event_id // 5000)::VARCHAR, 6, '0') || '.json' AS file FROM events)"""


def _log(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Logs of events whose file names do not follow time; every fiftieth line was cut off. Days are the only times, so that
    files and lines decide between the records of a day."""
    path = scratch(spark, name)
    own = read(spark, sf_dir, "events").select(F.concat(F.lit("d"), F.col("user_id") % 97).alias("domain"), F.date_format("ts", "yyyy-MM-dd").alias("ts"), F.col("event_id").alias("n"))
    line = F.to_json(F.struct("domain", "ts", "n"))
    cut_off = F.when(F.col("n") % 50 == 7, F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line)
    file = F.concat(F.lit("log-"), 9 - F.col("n") % 3, F.lit("-"), F.lpad(F.floor(F.col("n") / 5000).cast("string"), 6, "0"), F.lit(".json"))
    files.write_files(own.select(file.alias("name"), F.col("n").alias("place"), F.concat(cut_off, F.lit("\n")).alias("content")), path)
    return path


@query(f"WITH {S_LOG} SELECT domain, n, file FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts DESC, file DESC, n DESC) AS r FROM log WHERE NOT cut) WHERE r = 1")
def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, WN1: the last record of each key by time, then in the order of files and lines; broken lines are left out."""
    found = readers.read_json_log(spark, _log(spark, sf_dir, "log"), LOG)
    return keyed.latest(found, ["domain"], ["ts", "ordinal"]).select("domain", "n", "file")


@query(f"WITH {S_LOG} SELECT domain, n, (SELECT count(*) FROM log WHERE NOT cut) AS whole, (SELECT count(*) FROM log WHERE cut) AS bad, -1 AS again FROM log WHERE NOT cut")
def log_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5: whole lines of broken logs written anew with their number; a whole log stays as it is."""
    path, out = _log(spark, sf_dir, "broken"), scratch(spark, "repaired")
    whole = readers.repair_log(spark, path, out, LOG)
    again = readers.repair_log(spark, out, scratch(spark, "again"), LOG)
    bad = readers.bad_lines(spark, path, LOG).filter("value <> ''").count()
    rows = readers.read_json_log(spark, out, LOG)
    return rows.select("domain", "n", F.lit(whole).cast("long").alias("whole"), F.lit(bad).cast("long").alias("bad"), F.lit(again).alias("again"))


S_MEMBERS = """own AS (SELECT event_id, event_id % 4 AS f, event_id // 800 AS m, event_id || ' ' || coalesce(event_type, '-') AS value FROM events),
kept AS (SELECT * FROM own WHERE f < 2 OR f = 2 AND m < 2 OR f = 3 AND m < (SELECT max(m) FROM own WHERE f = 3))"""


def _members(spark: SparkSession, sf_dir: str) -> str:
    """Four logs of many gzip members of at most two hundred lines each; a member's last line ends in the next one. The third
    member of one log is broken, and of another the last member was cut off."""
    path = scratch(spark, "members")
    own = read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 4).alias("f"), F.floor(F.col("event_id") / 800).alias("m"), F.concat_ws(" ", F.col("event_id").cast("string"), F.coalesce("event_type", F.lit("-"))).alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "line"))), lambda x: x["line"]), "\n")
    made = own.groupBy("f", "m").agg(text.alias("text"))
    content = sinks.gzipped(F.when(F.col("m") == 0, F.col("text")).otherwise(F.concat(F.lit("\n"), F.col("text"))))
    last = own.filter("f = 3").agg(F.max("m")).first()[0]
    held = F.when((F.col("f") == 2) & (F.col("m") == 2), F.concat(F.substring("content", 1, 3), F.lit(b" broken"))).when((F.col("f") == 3) & (F.col("m") == last), F.substring("content", 1, 10))
    rows = made.withColumn("content", content).select(F.concat(F.lit("log-"), F.col("f"), F.lit(".gz")).alias("name"), F.col("m").alias("place"), F.coalesce(held, F.col("content")).alias("content"))
    files.write_files(rows, path)
    return path


@query(f"WITH {S_MEMBERS} SELECT 'log-' || f || '.gz' AS file, row_number() OVER (PARTITION BY f ORDER BY event_id) - 1 AS line_no, value FROM kept")
def gzip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: the lines of logs of many members, found and read in ranges of the files up to the first broken member."""
    found = files.gzip_lines(spark, _members(spark, sf_dir), range_bytes=4096)
    return found.select(F.substring_index("file", "/", -1).alias("file"), "line_no", "value")


@query(f"WITH {S_MEMBERS}, n AS (SELECT f, m, count(*) AS n FROM kept GROUP BY f, m) SELECT 'log-' || f || '.gz' AS file, m AS member, n - (m = 0)::INT AS newlines, (sum(n) OVER (PARTITION BY f ORDER BY m) - n - (m > 0)::INT)::BIGINT AS base FROM n")
def gzip_member_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4, SRC5: the whole members of each log with their line feeds and those before."""
    from pyspark.sql import Window

    found = files.member_index(spark, _members(spark, sf_dir), range_bytes=4096).filter("whole")
    member = F.row_number().over(Window.partitionBy("file").orderBy("start")) - 1
    return found.select(F.substring_index("file", "/", -1).alias("file"), member.cast("long").alias("member"), "newlines", "base")


S_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '^www\.', '')"


@query(f"""
SELECT 'p' || page_id || '.' || {S_HOST} AS domain, CASE WHEN page_id % 2 = 0 THEN 'browser' ELSE 'http' END AS source, CASE WHEN page_id % 3 > 0 THEN 200 + page_id % 3 END::INT AS status,
  CASE WHEN page_id % 3 > 0 THEN url END AS final_url, html FROM pages
""")
def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6, SRC7: every page as a compressed file, read back by its name and its header comment."""
    path = scratch(spark, "saved")
    page, key = F.col("page_id"), F.col("page_id").cast("string")
    name = F.concat(F.lit("p"), key, F.lit("."), U.url_host(F.col("url")), F.when(page % 2 == 0, F.lit("__browser")).otherwise(F.lit("")), F.lit(".html.gz"))
    head = F.when(page % 3 > 0, F.concat(F.lit("<!-- 2024-01-01T00:00:00 status="), (200 + page % 3).cast("string"), F.lit(" final_url="), F.col("url"), F.lit(" -->\n"))).otherwise("")
    own = read(spark, sf_dir, "pages").select(name.alias("name"), F.lit(0).alias("place"), sinks.gzipped(F.concat(head, F.coalesce("html", F.lit("")))).alias("content"))
    files.write_files(own, path)
    return readers.read_saved_pages(spark, path).select("domain", "source", "status", "final_url", "html")


def _arrays(spark: SparkSession, sf_dir: str, name: str, text: Column) -> str:
    """Files of fifty labels each, as batches of reviews are, with the JSON text of each."""
    path = scratch(spark, name)
    own = read(spark, sf_dir, "labels").select(F.floor(F.col("doc_id") / 100).alias("batch"), F.struct("doc_id", "quality", "toxic").alias("r"))
    made = own.groupBy("batch").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    files.write_files(made.select(F.concat(F.lit("verdicts-"), F.lpad(F.col("batch").cast("string"), 8, "0"), F.lit(".json")).alias("name"), F.lit(0).alias("place"), text.alias("content")), path)
    return path


@query("""
SELECT dense_rank() OVER (ORDER BY doc_id // 100) AS file_no, (row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1)::INT AS place, doc_id, quality::INT AS quality FROM labels
""")
def verdict_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8: labels as files of one array each, in the order of their names."""
    path = _arrays(spark, sf_dir, "arrays", F.to_json("rows"))
    return readers.read_json_arrays(spark, path, "doc_id long, quality int").select("file_no", "place", "doc_id", "quality")


@query("SELECT 'd' || doc_id AS key, toxic::INT AS toxic FROM labels")
def keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8: labels as objects by key, notes left out."""
    pairs = F.map_from_entries(F.concat(F.array(F.struct(F.lit("_note").alias("key"), F.lit(None).cast("struct<toxic:int>").alias("value"))), F.transform("rows", lambda r: F.struct(F.concat(F.lit("d"), r["doc_id"]).alias("key"), F.struct(r["toxic"].cast("int").alias("toxic")).alias("value")))))
    path = _arrays(spark, sf_dir, "keyed", F.to_json(pairs))
    return readers.read_keyed_json(spark, path, "struct<toxic:int>").select("key", "value.toxic")


@query("""
WITH t AS (SELECT l_orderkey AS k, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN '15: no results' WHEN o_orderkey % 11 = 1 THEN 'xml' WHEN o_orderkey % 11 = 2 THEN 'b64' END AS error,
  CASE WHEN o_orderkey % 11 > 2 THEN '<p>' || o_orderstatus || '</p>' END AS answer, CASE WHEN o_orderkey % 11 > 1 THEN 1 ELSE 0 END::INT AS n_sources,
  CASE WHEN o_orderkey % 11 = 1 THEN 0 ELSE least(10, coalesce(n, 0)) END::INT AS found,
  CASE WHEN o_orderkey % 11 <> 1 THEN 'https://o' || o_orderkey || '.example/' || first END AS first_url, CASE WHEN o_orderkey % 11 <> 1 THEN 'line ' || first END AS first_title
FROM orders LEFT JOIN t ON k = o_orderkey
""")
def answer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9, D17: orders and their lines as captured answers, parsed once each: answer, error, sources and the first ten
    results in order. Some report an error, some are cut off, some hold no base64."""
    orders = spread(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    #: Line numbers are shuffled, the documents made of them are not.
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("numbers"))
    url = lambda n: F.concat(F.lit("https://o"), F.col("l_orderkey").cast("string"), F.lit(".example/"), n)
    doc = lambda n: F.concat(F.lit("<group><doc><url>"), url(n), F.lit("</url><title>line &lt;b&gt;"), n, F.lit("&lt;/b&gt;</title></doc></group>"))
    j = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("docs", F.array_join(F.transform("numbers", lambda n: doc(n.cast("string"))), ""))
    kind = F.col("o_orderkey") % 11
    text = F.when(kind == 2, F.lit("?not base64?")).otherwise(F.base64(F.concat(F.lit("<p>"), F.col("o_orderstatus"), F.lit("</p>")).cast("binary")))
    ai = F.when(kind > 1, F.concat(F.lit("<ai><answer>"), text, F.lit("</answer><item><url>https://s.example/</url><title>S</title><snippet>x</snippet></item></ai>"))).otherwise("")
    error = F.when(kind == 0, F.lit('<error code="15">no results</error>')).otherwise("")
    end = F.when(kind == 1, F.lit("</grou")).otherwise("</grouping></results></response></r>")
    xml = F.concat(F.lit('<r><response date="2024">'), error, ai, F.lit("<results><grouping>"), F.coalesce("docs", F.lit("")), end)
    found = readers.parse_answers(j.select(F.col("o_orderkey").alias("k"), xml.alias("xml")))
    return found.select("k", "error", "answer", F.size("sources").alias("n_sources"), F.size("organic").alias("found"), F.try_element_at("organic", F.lit(1))["url"].alias("first_url"), F.try_element_at("organic", F.lit(1))["title"].alias("first_title"))


@query("SELECT DISTINCT lower(p_brand) AS value FROM part UNION SELECT 'own.example'")
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10: lists of names in files, without blanks, remarks and repeats."""
    path = scratch(spark, "lists")
    lines = read(spark, sf_dir, "part").select(F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")).alias("value"))
    lines.union(spark.sql("SELECT * FROM VALUES ('# remark'), (''), ('OWN.example') AS (value)")).write.text(path)
    return readers.read_lines(spark, path)


S_SITE = f"array_to_string(list_slice(string_split({S_HOST}, '.'), -3, -1), '.')"


@query(f"""
WITH p AS (SELECT {S_SITE} AS site, page_id, url, page_id // 40 AS m FROM pages WHERE {S_HOST} <> ''), s AS (SELECT DISTINCT site FROM p),
maps AS (SELECT site, m, row_number() OVER (PARTITION BY site ORDER BY m) AS r FROM (SELECT DISTINCT site, m FROM p)),
o AS (SELECT site, 'https://' || site || '/about' AS url, 0 AS level, 0 AS map_no, 0 AS place FROM s UNION ALL SELECT site, p.url, 1, maps.r, p.page_id FROM p JOIN maps USING (site, m) WHERE maps.r <= 6)
SELECT site, url, level::INT AS level, row_number() OVER (PARTITION BY site ORDER BY level, map_no, place) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY site, url ORDER BY level, map_no, place) AS f FROM o) WHERE f = 1
""")
def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC11: sitemaps of the sites of pages, a nested map for at most forty pages; of nested maps the first six are
    followed."""
    host = F.split(U.url_host(F.col("url")), r"\.")
    site = F.array_join(F.slice(host, -F.least(F.lit(3), F.size(host)), F.lit(3)), ".")
    own = read(spark, sf_dir, "pages").filter(U.url_host(F.col("url")) != "").select(site.alias("site"), "page_id", "url", F.floor(F.col("page_id") / 40).alias("m"))
    location = lambda u: F.concat(F.lit("<url><loc> "), F.replace(u, F.lit("&"), F.lit("&amp;")), F.lit(" </loc></url>"))
    name = F.concat(F.lit("https://"), F.col("site"), F.lit("/map-"), F.lpad(F.col("m").cast("string"), 8, "0"), F.lit(".xml"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["l"]), "")
    nested = own.groupBy("site", "m").agg(listed(F.struct("page_id", location(F.col("url")).alias("l"))).alias("xml")).select("site", "m", name.alias("url"), "xml")
    #: A root names the first of its site's maps; what lies beyond those that are followed is not named.
    ranked = tables.top_per_group(nested, ["site"], [F.col("m")], 8)
    maps = ranked.groupBy("site").agg(listed(F.struct("m", F.concat(F.lit("<sitemap><loc>"), F.col("url"), F.lit("</loc></sitemap>")).alias("l"))).alias("maps"))
    about = F.concat(F.lit("<url><loc>https://"), F.col("site"), F.lit("/about</loc></url>"))
    roots = maps.select("site", F.concat(F.lit("https://"), F.col("site"), F.lit("/sitemap.xml")).alias("url"), F.concat(F.lit("<sitemapindex>"), about, F.col("maps"), F.lit("</sitemapindex>")).alias("xml"), F.lit(True).alias("root"))
    found = readers.sitemap_pages(roots.unionByName(nested.select("site", "url", "xml", F.lit(False).alias("root"))))
    return found.select("site", "url", "level", F.col("rank").cast("long").alias("rank"))


@query("SELECT event_type, count(*) * 2 AS n FROM events GROUP BY event_type")
def appended_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2: a log that two runs append to."""
    path = scratch(spark, "appended")
    own = read(spark, sf_dir, "events").select("event_id", "event_type")
    sinks.append_json(own, path)
    sinks.append_json(own, path)
    return readers.read_json_log(spark, path, "event_id long, event_type string").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'part' ELSE 'open' END AS part, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1")
def split_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3: one table into a folder for each value of an expression."""
    path = scratch(spark, "split")
    by = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "part").otherwise("open")
    sinks.write_split(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path, by)
    return spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("SELECT b AS batch_id, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 50)::INT AS b FROM orders) GROUP BY b")
def batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4, TK11: batches of fifty, a file each."""
    path = scratch(spark, "batches")
    ranked = keyed.numbered(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    sinks.write_batches(tables.in_batches(ranked, "n", 50).drop("n"), path)
    return readers.read_batches(spark, path, "o_orderkey long").groupBy(F.col("batch_id").cast("int").alias("batch_id")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


S_CARD = """'<article id="s' || n || '"><h3>' || replace(c_name, '#', '#') || '</h3><div class="meter ' || CASE WHEN s >= 80 THEN 'high' WHEN s >= 60 THEN 'middle' ELSE 'low' END || '"><i style="width:' || s || '%"></i></div><dl><dt>segment</dt><dd>' || c_mktsegment || '</dd><dt>link</dt><dd><a href="https://c.example/' || c_custkey || '">https://c.example/' || c_custkey || '</a></dd></dl></article>'"""


@query(f"SELECT ((n - 1) // 100)::INT AS chunk, {S_CARD} AS card, max(n) OVER () // 100 + (max(n) OVER () % 100 > 0)::INT AS chunks FROM (SELECT *, row_number() OVER (ORDER BY s DESC, c_name) AS n FROM (SELECT *, (c_custkey % 101)::INT AS s FROM customer))")
def html_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5, TX18: a report of cards in chunks of a hundred, the best first."""
    path = scratch(spark, "report")
    own = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_custkey") % 101).cast("int").alias("s"), F.concat(F.lit("https://c.example/"), F.col("c_custkey").cast("string")).alias("link"))
    chunks = sinks.write_html_report(own, path, "Customers", "c_mktsegment", "c_name", "s", [("segment", "c_mktsegment"), ("link", "link")])
    return spark.read.text(f"{path}/cards").select("chunk", F.col("value").alias("card"), F.lit(chunks).cast("long").alias("chunks"))


@query("SELECT o_orderkey, '- order ' || o_orderkey || ': [https://o.example/' || o_orderkey || '](https://o.example/' || o_orderkey || ') \\*done\\*' AS line FROM orders")
def markdown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: an ordered report in files of at most so many characters, read back whole."""
    path = scratch(spark, "markdown")
    key = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit("- order "), key, F.lit(": "), sinks.markdown_link(F.concat(F.lit("https://o.example/"), key)), F.lit(" "), sinks.markdown_escaped(F.lit("*done*")))
    own = read(spark, sf_dir, "orders").select("o_orderkey", line.alias("line")).orderBy("o_orderkey")
    sinks.write_markdown_parts(own, path, "line", most=50_000)
    return spark.read.text(path).select(F.regexp_extract("value", r"order (\d+)", 1).cast("long").alias("o_orderkey"), F.col("value").alias("line"))


@query("""
WITH RECURSIVE l AS (SELECT o_orderkey, sum(length('- ' || o_orderkey || ': ' || tail) + 1) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS upto FROM (SELECT o_orderkey, repeat(o_orderpriority, CAST(o_orderkey % 7 AS INT)) AS tail FROM orders)),
p AS (SELECT 1 AS part, CAST(0 AS HUGEINT) AS base UNION ALL SELECT p.part + 1, max(l.upto) FROM p JOIN l ON l.upto <= p.base + 20000 GROUP BY p.part HAVING max(l.upto) < (SELECT max(upto) FROM l))
SELECT o_orderkey, max(CAST(part AS BIGINT)) AS part FROM l JOIN p ON p.base < l.upto GROUP BY o_orderkey
""")
def markdown_part_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6: the file of each row of an ordered report of rows of uneven length, filled greedily over all partitions."""
    path = scratch(spark, "markdown")
    line = F.concat(F.lit("- "), F.col("o_orderkey").cast("string"), F.lit(": "), F.expr("repeat(o_orderpriority, CAST(o_orderkey % 7 AS INT))"))
    own = read(spark, sf_dir, "orders").select("o_orderkey", line.alias("line")).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    sinks.write_markdown_parts(own, path, "line", most=20_000)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)\.md", 1).cast("long")
    return spark.read.text(path).select(F.regexp_extract("value", r"^- (\d+):", 1).cast("long").alias("o_orderkey"), number.alias("part"))


@query("""
WITH t AS (SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1), l AS (SELECT 0 AS o, '# Customers' AS line UNION ALL SELECT 1, '## By segment' UNION ALL SELECT 2, '| segment | n |' UNION ALL SELECT 3, '| --- | --- |' UNION ALL SELECT 3 + row_number() OVER (ORDER BY segment), '| ' || segment || ' | ' || n || ' |' FROM t UNION ALL SELECT 90, '## Nothing' UNION ALL SELECT 91, 'none' UNION ALL SELECT 92, '## Shortened' UNION ALL SELECT 93, '| c_custkey |' UNION ALL SELECT 94, '| --- |' UNION ALL SELECT 95, '| ' || min(c_custkey) || ' |' FROM customer UNION ALL SELECT 96, (count(*) - 1) || ' more rows are not shown.' FROM customer)
SELECT line FROM l
""")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: a report of aggregates; a table that is cut says so."""
    customer = read(spark, sf_dir, "customer")
    by = customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n")).orderBy("segment")
    first = sinks.markdown_report("Customers", [("By segment", by), ("Nothing", by.filter("n < 0"))])
    cut_ = sinks.markdown_report("x", [("Shortened", customer.select("c_custkey").orderBy("c_custkey"))], limit=1).split("\n", 2)[2]
    return spark.createDataFrame([(x,) for x in (first + cut_).split("\n") if x], "line string")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN2, WN1: the latest record of each key, kept by a stream over a log that comes in three files."""
    path, out, mark = (scratch(spark, x) for x in ("stream", "table", "offsets"))
    schema = "event_id long, ts string, user_id long, event_type string"
    own = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type")
    for k in range(3):
        own.filter(F.pmod("event_id", F.lit(3)) == k).write.mode("append").json(path)
        stream.latest_stream(spark, path, schema, ["user_id"], ["ts", "event_id"], out, mark, 8).awaitTermination()
    return stream.read_latest(spark, out, schema).select("user_id", "event_id", "event_type")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def progress_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN4: counters of progress by hour."""
    return stream.windowed_counts(read(spark, sf_dir, "events"), "ts", "event_type")


@query(f"""
WITH g AS ({GRID}) SELECT k, {sql_pick(0, 2, ("200 https://a.example/", "timeout https://a.example/"))} || ' → 200 https://b.example/' AS chain, 2 AS hops, '{{"a":1,"b":["x","y"]}}' AS cell, 'x y' AS tags FROM g
""")
def flat_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX21, HP10, SRC3: arrays packed and unpacked, nested cells as JSON, chains of pairs as structs."""
    first = pick(0, 2, ("200", "timeout"))
    raw = F.array(F.array(first, F.lit("https://a.example/")), F.array(F.lit("200"), F.lit("https://b.example/")))
    df = grid(spark, sf_dir).select("k", raw.alias("hops"), first.alias("first"), F.struct(F.lit(1).alias("a"), F.array(F.lit("x"), F.lit("y")).alias("b")).alias("cell"), F.array(F.lit("x"), F.lit("y")).alias("tags"))
    hops = F.transform(readers.struct_hops("hops"), lambda h: F.struct(h["status"].alias("status"), F.when(h["status"].isNull(), F.lit("timeout")).alias("error"), h["url"].alias("url")))
    flat = sinks.flattened(df.select("k", T.chain_text(hops).alias("chain"), "cell", "tags"))
    return flat.select(F.col("k").cast("long").alias("k"), "chain", F.size(T.unpack(F.col("chain"), "hops")).alias("hops"), "cell", "tags")


