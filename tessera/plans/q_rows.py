"""Joins, folds, samples, queues and audits that no other query runs, over the driver's tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.functions import url as U
from tessera.operators import corpus, keyed, scan, scores, tables
from tessera.plans.inputs import GRID, flag, grid, number, pick, read, sql_flag, sql_number, sql_pick
from tessera.plans.registry import query

SIDES = "(SELECT o_custkey AS k, count(*) AS n_{s} FROM orders WHERE o_orderstatus = '{s}' GROUP BY 1)"


@query(f"""
SELECT coalesce(a.k, b.k, c.k) AS k, n_F AS n_f, n_O AS n_o, n_P AS n_p, c_mktsegment AS segment FROM {SIDES.format(s="F")} a FULL JOIN {SIDES.format(s="O")} b ON a.k = b.k FULL JOIN {SIDES.format(s="P")} c ON coalesce(a.k, b.k) = c.k LEFT JOIN customer ON coalesce(a.k, b.k, c.k) = c_custkey
""")
def outer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1: a full outer join of three tables by key, then a lookup of features."""
    orders = read(spark, sf_dir, "orders")
    sides = [orders.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias(f"n_{s.lower()}")) for s in "FOP"]
    more = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    return tables.outer_by_key(sides, "k", [more])


@query("SELECT c_custkey, c_name, coalesce(n, 0) AS n, coalesce(status, 'none') AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderstatus) AS status FROM orders WHERE o_totalprice > 300000 GROUP BY 1) ON o_custkey = c_custkey")
def lookup_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN2: a left lookup with defaults."""
    big = read(spark, sf_dir, "orders").filter("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderstatus").alias("status"))
    return tables.lookup(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), big, "c_custkey", {"n": 0, "status": "none"})


@query("SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING bool_or(l_returnflag = 'R') AND NOT bool_or(l_returnflag <> 'R')")
def tracker_set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG13: keys that lead to one side alone, in one aggregate."""
    return tables.one_sided_hosts(read(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)")
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IN1, JN3: keys that no record has yet."""
    done = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return tables.without(read(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey")


@query("""
WITH todo AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'), done AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), redo AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')
SELECT c_custkey FROM (SELECT c_custkey FROM todo WHERE c_custkey NOT IN (FROM done) UNION ALL SELECT c_custkey FROM todo WHERE c_custkey IN (FROM done) AND c_custkey IN (FROM redo)) ORDER BY 1 LIMIT 100
""")
def inventory_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT10, IN1, IN2: a list of keys, less those that are done, and those to be done again; a queue of the first hundred."""
    customer, orders = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey"), read(spark, sf_dir, "orders")
    of = lambda s: orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c_custkey"))
    return scan.inventory_queue(customer, of("F"), redo=of("P"), key="c_custkey", most=100)


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 'd' || k % 4000 AS domain, {sql_number(0, 2, 5)} AS ts, {sql_pick(0, 6, ("http", "browser", "rest"))} AS src, k FROM g), l AS (SELECT *, row_number() OVER (PARTITION BY domain, src ORDER BY ts DESC, k DESC) AS r FROM a), p AS (SELECT domain, max(ts) FILTER (WHERE src = 'http') AS h, max(k) FILTER (WHERE src = 'http') AS hk, max(ts) FILTER (WHERE src = 'browser') AS b, max(k) FILTER (WHERE src = 'browser') AS bk, max(ts) FILTER (WHERE src = 'rest') AS x, max(k) FILTER (WHERE src = 'rest') AS xk FROM l WHERE r = 1 GROUP BY domain)
SELECT domain, CASE WHEN x IS NOT NULL AND (coalesce(b, h) IS NULL OR x >= coalesce(b, h)) THEN 'rest' WHEN b IS NOT NULL THEN 'browser' ELSE 'http' END AS src, CASE WHEN x IS NOT NULL AND (coalesce(b, h) IS NULL OR x >= coalesce(b, h)) THEN xk WHEN b IS NOT NULL THEN bk ELSE hk END AS k FROM p
""")
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN1, WN3: the browser's record before the plain one, a later pass only if it is not older."""
    df = grid(spark, sf_dir).select(F.concat(F.lit("d"), F.pmod("k", F.lit(4000)).cast("string")).alias("domain"), number(0, 2, 5).alias("ts"), pick(0, 6, ("http", "browser", "rest")).alias("src"), "k")
    last = [keyed.latest(df.filter(F.col("src") == s), ["domain"], ["ts", "k"]) for s in ("http", "browser", "rest")]
    return keyed.by_precedence(last, "domain", "ts", newer_only=(2,)).select("domain", "src", "k")


@query(f"""
WITH g AS ({GRID}), v AS (SELECT 'd' || k % 3000 AS domain, k, {sql_pick(0, 2, ("correct", "wrong", "unsure", None))} AS verdict, CASE WHEN {sql_flag(0, 6, 5)} THEN NULL ELSE {sql_pick(0, 10, ("bait", "mono_other"))} END AS given, {sql_number(1, 2, 4)} AS round FROM g), n AS (SELECT 'd' || k AS domain, {sql_pick(2, 2, ("bait", "mono_other", "article"))} AS category FROM g WHERE {sql_flag(2, 7)}),
l AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY round DESC, k DESC) AS r FROM v WHERE coalesce(verdict, 'unsure') <> 'unsure'), e AS (SELECT domain, category, CASE WHEN verdict = 'wrong' THEN 'not_a_violator' ELSE coalesce(given, category) END AS expected FROM l JOIN n USING (domain) WHERE r = 1)
SELECT *, expected = category AS ok FROM e
""")
def review_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN9: the last sure verdict of each site, and whether it agrees with the class now."""
    g = grid(spark, sf_dir)
    v = g.select(F.concat(F.lit("d"), F.pmod("k", F.lit(3000)).cast("string")).alias("domain"), F.col("k").alias("ordinal"), pick(0, 2, ("correct", "wrong", "unsure", None)).alias("verdict"), F.when(~flag(0, 6, 5), pick(0, 10, ("bait", "mono_other"))).alias("given"), F.lit(None).cast("string").alias("should_be"), number(1, 2, 4).alias("round"))
    now = g.filter(flag(2, 7)).select(F.concat(F.lit("d"), F.col("k").cast("string")).alias("domain"), pick(2, 2, ("bait", "mono_other", "article")).alias("category"))
    return scores.labels(v, now)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, ''), o_orderkey) AS place FROM orders")
def null_first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK1: sorted with null as the empty text, numbered over the whole table."""
    own = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    keyed_ = own.withColumn("_s", tables.by_keyword(F.col("status")))
    return keyed.numbered(keyed_, ["_s", "o_orderkey"], "place").select("o_orderkey", "place")


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, p) AS r FROM c)
SELECT o_custkey, string_agg(p || ':' || n, ' ' ORDER BY r) AS top FROM r WHERE r <= 3 GROUP BY o_custkey
""")
def top_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK5: the three largest entries of a map in a row."""
    counts = read(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    maps = counts.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "n"))).alias("m"))
    top = F.transform(tables.top_entries(F.col("m"), 3), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return maps.select("o_custkey", F.array_join(top, " ").alias("top"))


@query("""
WITH r AS (SELECT c_custkey, c_acctbal < 0 AS refuted, md5('7:' || c_custkey) AS h FROM customer), n AS (SELECT * FROM r WHERE refuted ORDER BY h, c_custkey LIMIT 20), y AS (SELECT * FROM r WHERE NOT refuted ORDER BY h, c_custkey LIMIT 60 - (SELECT count(*) FROM n))
SELECT c_custkey, refuted FROM n UNION ALL SELECT c_custkey, refuted FROM y
""")
def control_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TK7: a control set of 60, a third of it refuted, by a seeded hash."""
    own = read(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") < 0).alias("refuted"))
    return tables.control_sample(own, "c_custkey", F.col("refuted"), 60, 7)


@query("SELECT user_id, event_type, event_id, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE r = 1")
def first_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, ST6: the first record of a composite key wins; how many there were."""
    own = read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    first = keyed.earliest(own, ["user_id", "event_type"], ["ts", "event_id"])
    counts = own.groupBy(F.col("user_id").alias("_u"), F.col("event_type").alias("_t")).agg(F.count("*").alias("n"))
    return first.join(counts, (F.col("user_id") == F.col("_u")) & (F.col("event_type") == F.col("_t"))).select("user_id", "event_type", "event_id", "n")


WORDS = (("Acme bonus", "ACME BONUS "), ("globex", "Globex"), ("umbra deposit", "umbra deposit"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT {sql_pick(0, 2, ("KZ", "AZ"))} AS cc, {sql_pick(0, 4, [w for p in WORDS for w in p])} || ' ' || k % 40 AS query, {sql_pick(0, 10, ("desktop", "mobile"))} AS device, k FROM g), b AS (SELECT *, lower(trim(query)) AS q FROM a)
SELECT cc, query, device, k AS ordinal FROM (SELECT *, row_number() OVER (PARTITION BY cc, q, device ORDER BY k) AS r FROM b) WHERE r = 1
""")
def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8, ST9: requests of two lists once each, in normal form, the first wins."""
    df = grid(spark, sf_dir).select(pick(0, 2, ("KZ", "AZ")).alias("cc"), F.concat(pick(0, 4, [w for p in WORDS for w in p]), F.lit(" "), F.pmod("k", F.lit(40)).cast("string")).alias("query"), pick(0, 10, ("desktop", "mobile")).alias("device"), F.col("k").alias("ordinal"))
    return corpus.request_keys(tables.union_by_name([df.filter("ordinal % 2 = 0"), df.filter("ordinal % 2 = 1")]))


KEYWORDS = ("обзор acme", "acme скачать", "бонус acme", "лицензия acme", "acme review", "просто слово", "вход acme")
THEMES = (("review", "(?iU)обзор|отзыв"), ("licence", "(?iU)лицензи|закон"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, 'CC' || k % 2 AS cc, {sql_pick(0, 2, KEYWORDS)} AS kw, {sql_number(1, 2, 30)} AS volume, {sql_flag(1, 8)} AS intent, {sql_flag(1, 10, 4)} AS nav, {sql_flag(1, 14, 3)} AS seen FROM g),
b AS (SELECT *, CASE WHEN kw LIKE 'обзор%' THEN 'review' WHEN kw LIKE 'лиц%' THEN 'licence' ELSE 'none' END AS theme FROM a WHERE kw NOT IN ('acme скачать', 'acme review', 'вход acme')) SELECT k, theme FROM b WHERE theme <> 'none' OR (intent AND NOT nav AND kw <> 'бонус acme')
""")
def selected_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, TX7: keywords of a script without exclusions, with a theme or an intent."""
    df = _keywords(spark, sf_dir)
    return corpus.selected(df, "[а-яё]", "(?iU)скачат|вход", THEMES, "(?iU)бонус", F.col("intent"), F.col("nav")).select("k", "theme")


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).select("k", F.concat(F.lit("CC"), F.pmod("k", F.lit(2)).cast("string")).alias("cc"), pick(0, 2, KEYWORDS).alias("keyword"), number(1, 2, 30).alias("volume"), flag(1, 8).alias("intent"), flag(1, 10, 4).alias("nav"))


@query(f"""
WITH g AS ({GRID}), a AS (SELECT 'CC' || k % 2 AS cc, {sql_pick(0, 2, KEYWORDS)} AS kw, {sql_number(1, 2, 30)} AS volume FROM g)
SELECT cc, count(*) AS n, count(*) FILTER (WHERE kw <> 'acme review') AS n_script, count(*) FILTER (WHERE volume >= 10) AS n_volume FROM a GROUP BY cc
""")
def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG5, FLT12: keywords by country, in a script, and above a volume."""
    return corpus.corpus_counts(_keywords(spark, sf_dir), ["cc"], "[а-яё]", 10)


TONES = ("positive", "negative", "neutral")


@query(f"""
WITH g AS ({GRID}), a AS (SELECT k, 'CC' || k % 2 AS cc, 'Query ' || k % 5000 || CASE WHEN k % 3 = 0 THEN ' ' ELSE '' END AS query, {sql_flag(0, 2, 4)} AS gone FROM g), c AS (SELECT DISTINCT 'CC' || k % 2 AS cc, k % 5000 AS q, (k % 5000) % 2 = 0 AS m, {"['positive','negative','neutral']"}[(k % 5000) % 3 + 1] AS s FROM g WHERE k % 5000 < 2500)
SELECT a.k, s AS sentiment FROM a JOIN c ON a.cc = c.cc AND lower(trim(a.query)) = 'query ' || c.q WHERE NOT gone AND NOT (m AND s <> 'negative')
""")
def problem_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT7, JN6: shown answers joined by country and normal query that do not name the brand well."""
    q = F.pmod("k", F.lit(5000))
    cc = F.concat(F.lit("CC"), F.pmod("k", F.lit(2)).cast("string"))
    answers = grid(spark, sf_dir).select("k", cc.alias("cc"), F.concat(F.lit("Query "), q.cast("string"), F.when(F.col("k") % 3 == 0, " ").otherwise("")).alias("query"), (~flag(0, 2, 4)).alias("present"))
    classes = grid(spark, sf_dir).filter(q < 2500).select(cc.alias("cc"), F.concat(F.lit(" query "), q.cast("string")).alias("query"), (F.pmod(q, F.lit(2)) == 0).alias("mentioned"), F.element_at(F.array(*[F.lit(t) for t in TONES]), (F.pmod(q, F.lit(3)) + 1).cast("int")).alias("sentiment")).distinct()
    return corpus.problem_answers(answers, classes).select("k", "sentiment")


@query("""
WITH p AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), '^www\\.', '') AS host FROM pages), u AS (SELECT host, count(DISTINCT url) AS urls, sum(page_id % 4)::BIGINT AS citations, count(*) FILTER (WHERE page_id % 4 > 0) AS cited_urls, count(*) FILTER (WHERE page_id % 3 > 0) AS top_urls, count(*) FILTER (WHERE page_id % 120 > 50) AS usable, string_agg(DISTINCT CASE WHEN page_id % 2 = 0 THEN 'good' ELSE 'bad' END, ' ' ORDER BY CASE WHEN page_id % 2 = 0 THEN 'good' ELSE 'bad' END) AS tones FROM p GROUP BY host)
SELECT u.host, citations, cited_urls, top_urls, usable, tones, length(host)::INT AS domain_rating FROM u
""")
def host_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG7, JN7: hosts of a pool of pages with their citations, usable pages, tones and metrics."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    cited = F.slice(F.array(F.lit("q1"), F.lit("q2"), F.lit("q3")), 1, (F.col("page_id") % 4).cast("int"))
    top = F.slice(F.array(F.lit("q1"), F.lit("q2")), 1, (F.col("page_id") % 3).cast("int"))
    pool = pages.select("url", cited.alias("cited"), top.alias("top10"))
    words = pages.select("url", (F.col("page_id") % 120).alias("words"), F.lit("x").alias("host"))
    tones = pages.select("url", F.when(F.col("page_id") % 2 == 0, "good").otherwise("bad").alias("tone"))
    metrics = pages.select(U.loc_host(F.col("url")).alias("host")).distinct().select("host", F.length("host").alias("domain_rating"), F.lit(1).alias("refdomains"))
    found = corpus.host_rollup(pool, words, tones, metrics)
    return found.select("host", "citations", "cited_urls", "top_urls", "usable", F.array_join("tones", " ").alias("tones"), "domain_rating")


@query("""
WITH a AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)), '^www\\.', '') AS host, page_id % 97 AS dr, page_id % 11 AS rd, CASE page_id % 5 WHEN 0 THEN 'spam placement' ELSE '' END AS issues, page_id % 3 > 0 AS usable FROM pages)
SELECT page_id, url FROM a WHERE usable AND issues = '' AND host NOT LIKE '%example.net' ORDER BY dr DESC, rd DESC, url LIMIT 60
""")
def page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT8, TK3: a shortlist of usable pages without spam and the brand's own."""
    own = read(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 97).alias("domain_rating"), (F.col("page_id") % 11).alias("refdomains"), F.when(F.col("page_id") % 5 == 0, "spam placement").alias("issues"))
    return corpus.candidates(own, "(?i)spam", r"example\.net$", F.col("page_id") % 3 > 0).select("page_id", "url")


@query("""
SELECT c_custkey AS domain FROM customer WHERE c_mktsegment = 'MACHINERY' UNION ALL SELECT * FROM (SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING') ORDER BY c_acctbal DESC, c_custkey LIMIT 50)
""")
def missed_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT11, TK8: the riskiest of all but a skipped class, and all of a forced one."""
    own = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("domain"), F.col("c_mktsegment").alias("category"), F.col("c_acctbal").alias("risk"))
    return scan.review_queue(own, ["MACHINERY"], 50, ["BUILDING"]).select("domain")


@query("WITH h AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders GROUP BY 1) SELECT strftime(m, '%Y-%m') AS month, f AS part, n AS whole, f / n::DOUBLE AS share FROM h ORDER BY m DESC LIMIT 1")
def share_at_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT2: the share of a part in the last month."""
    monthly = read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("part"), F.count("*").alias("whole"))
    return tables.share_at_last(monthly, "month", "part", "whole")


PAIRS = "(SELECT l_suppkey AS donor, l_shipmode AS target, max(l_quantity) AS rating FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) GROUP BY ALL)"


@query(f"""
SELECT 'shared' AS what, donor, targets::VARCHAR AS value, 0 AS rank FROM (SELECT donor, count(*) AS targets FROM {PAIRS} GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'best', donor, target, rank FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY rating DESC, donor) AS rank FROM {PAIRS}) WHERE rank <= 3
""")
def shared_donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT7: donors that several targets share, and the three best-rated of each target."""
    links = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("donor"), F.concat("l_returnflag", "l_linestatus").alias("target"), F.col("l_quantity").alias("rating"))
    shared, best = tables.shared_donors(links, "donor", "target", "rating", 3)
    a = shared.select(F.lit("shared").alias("what"), "donor", F.col("targets").cast("string").alias("value"), F.lit(0).cast("long").alias("rank"))
    return a.union(best.select(F.lit("best"), "donor", "target", F.col("rank").cast("long")))


CAPTURES = "SELECT page_id, 1 AS capture, html FROM pages UNION ALL SELECT page_id, 2, CASE WHEN page_id % 3 = 0 THEN html || '<!-- later -->' ELSE html END FROM pages"


def _captures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages, pages.withColumn("html", F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("<!-- later -->"))).otherwise(F.col("html")))


@query(f"SELECT md5(html) AS content_hash, count(*) AS n, min(page_id) AS first_page FROM ({CAPTURES}) WHERE html IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def identical_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT9: responses that are the same to the byte in two captures."""
    a, b = _captures(spark, sf_dir)
    own = a.union(b).filter("html IS NOT NULL").select("page_id", F.md5(F.col("html").cast("binary")).alias("content_hash"))
    return own.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("page_id").alias("first_page")).filter("n > 1")


def s_words(h: str) -> str:
    return f"len(regexp_extract_all(regexp_replace(regexp_replace({h}, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[^ \\t\\n\\r]+'))::INT"


AFTER = "CASE WHEN page_id % 4 = 0 THEN replace(html, '</body>', '<h2>New</h2><table><tr><td>1.85</td></tr></table></body>') WHEN page_id % 4 = 1 THEN replace(html, '<title>', '<title>New ') ELSE html END"


@query(f"""
WITH b AS (SELECT 'p' || page_id AS url, html AS h FROM pages WHERE page_id % 10 <> 9), a AS (SELECT 'p' || page_id AS url, {AFTER} AS h, page_id % 4 AS m, contains(html, '</body>') AS shut, contains(html, '<title>') AS titled FROM pages WHERE page_id % 10 <> 8)
SELECT coalesce(b.url, a.url) AS url, CASE WHEN b.url IS NULL THEN 'right' WHEN a.url IS NULL THEN 'left' ELSE 'both' END AS status, {s_words("b.h")} AS words_before, {s_words("a.h")} AS words_after, len(regexp_extract_all(b.h, '(?i)<h2[\\s>]'))::INT AS n_h2_before, len(regexp_extract_all(a.h, '(?i)<h2[\\s>]'))::INT AS n_h2_after,
  len(regexp_extract_all(b.h, '(?i)<table[\\s>]'))::INT AS n_tables_before, len(regexp_extract_all(a.h, '(?i)<table[\\s>]'))::INT AS n_tables_after, CASE WHEN b.url IS NULL OR a.url IS NULL THEN '' WHEN m = 0 AND shut THEN 'words n_h2 n_tables n_odds' WHEN m = 1 AND titled THEN 'words title' ELSE '' END AS changed
FROM b FULL JOIN a ON a.url = b.url
""")
def page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT10: two captures of pages side by side, and what changed."""
    h, k = F.col("html"), F.col("page_id") % 4
    pages = read(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("url"), "html")
    new = F.when(k == 0, F.replace(h, F.lit("</body>"), F.lit("<h2>New</h2><table><tr><td>1.85</td></tr></table></body>"))).when(k == 1, F.replace(h, F.lit("<title>"), F.lit("<title>New "))).otherwise(h)
    found = tables.page_audit(pages.filter("page_id % 10 <> 9").select("url", "html"), pages.filter("page_id % 10 <> 8").select("url", new.alias("html")))
    return found.select("url", "status", "words_before", "words_after", "n_h2_before", "n_h2_after", "n_tables_before", "n_tables_after", "changed")


IMAGES = (('<img src="a.png" alt="A red door">', 0, 0), ('<img src="b.png">', 1, 0), ('<img alt="">', 1, 0), ('<img alt="IMG_2041.jpg">', 0, 1), ('<img alt="hero_main_2">', 0, 1), ('<img alt="123">', 0, 1), ("", 0, 0))


@query(f"""
WITH p AS (SELECT page_id, html || ([{", ".join("'" + i.replace("'", "''") + "'" for i, _, _ in IMAGES)}])[page_id % {len(IMAGES)} + 1] AS h FROM pages), t AS (SELECT *, trim(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM p)
SELECT page_id, NOT regexp_matches(h, '(?i)<h1[\\s>]') AS missing_h1, title = '' AS missing_title, title <> '' AND count(*) OVER (PARTITION BY title) > 1 AS shared_title, {s_words("h")} < 300 AS few_words, (page_id % {len(IMAGES)} < 6)::INT AS images, ([{", ".join(str(m) for _, m, _ in IMAGES)}])[page_id % {len(IMAGES)} + 1] AS missing_alt, ([{", ".join(str(m) for _, _, m in IMAGES)}])[page_id % {len(IMAGES)} + 1] AS technical_alt FROM t
""")
def audit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT11: missing and shared titles, missing h1, few words, images without a text or with a technical one."""
    more = F.element_at(F.array(*[F.lit(i) for i, _, _ in IMAGES]), (F.col("page_id") % len(IMAGES) + 1).cast("int"))
    return tables.audit_flags(read(spark, sf_dir, "pages").select("page_id", F.concat("html", more).alias("html")))


@query(f"""
WITH g AS ({GRID}), e AS (SELECT DISTINCT k % 2000 AS p, {sql_pick(0, 2, ("en", "de", "x-default", "english_gb", "kk-KZ"))} AS code, {sql_number(0, 8, 2000)} AS t FROM g), l AS (SELECT DISTINCT p, lower(code) AS code, t FROM e)
SELECT 'u' || a.p AS page, bool_or(a.t = a.p) AS self_reference, bool_or(a.code = 'x-default') AS x_default, count(*) FILTER (WHERE a.code = 'english_gb') AS invalid_codes, count(*) FILTER (WHERE b.p IS NULL) AS not_returned FROM l a LEFT JOIN (SELECT DISTINCT p, t FROM l) b ON a.t = b.p AND a.p = b.t GROUP BY a.p
""")
def hreflang_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MT12, HT14: alternate links read from markup, and whether they are returned."""
    rows = grid(spark, sf_dir).select(F.pmod("k", F.lit(2000)).alias("p"), pick(0, 2, ("en", "de", "x-default", "english_gb", "kk-KZ")).alias("code"), number(0, 8, 2000).alias("t")).distinct()
    tag = F.concat(F.lit('<link rel="alternate" hreflang="'), "code", F.lit('" href="u'), F.col("t").cast("string"), F.lit('"/>'))
    pages = rows.groupBy("p").agg(F.array_join(F.collect_list(tag), "").alias("html"))
    pairs = pages.select(F.concat(F.lit("u"), F.col("p").cast("string")).alias("page"), F.explode(H.hreflangs(F.col("html"))).alias("l")).select("page", "l.code", "l.href").distinct()
    return tables.hreflang_checks(pairs)


@query("SELECT user_id, sum(value) FILTER (WHERE value > 5) > 50 AS busy, count(*) FILTER (WHERE hour(ts) = 3) AS night, strftime(min(ts), '%Y-%m-%d') AS first_day FROM events GROUP BY user_id")
def user_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1, AG12: flags and counts per key."""
    own = read(spark, sf_dir, "events")
    return own.groupBy("user_id").agg((F.sum(F.when(F.col("value") > 5, F.col("value"))) > 50).alias("busy"), F.count_if(F.hour("ts") == 3).alias("night"), F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"))


