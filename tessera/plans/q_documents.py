"""Queries over documents and conversations: terms, themes, languages, dictionaries, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dictionary as D
from tessera.functions import text as T
from tessera.operators import keyed, tables
from tessera.plans.registry import query
from tessera.space import cut

THEMES = (("licence", r"(?i)licen[sc]e"), ("contact", r"[\w.]@[\w.]"), ("shout", r"!!"), ("table", r" \| "), ("money", r"[$€]"))
NAMES = ("Anda", "Ther", "Enan", "Ou")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


@query("""
SELECT doc_id, n_terms, CASE WHEN n > 0 THEN n_terms * 1000.0::DOUBLE / n ELSE 0.0 END AS density
FROM (SELECT doc_id, coalesce(len(regexp_extract_all(text, '(?i)\\bthe\\b')), 0)::INT AS n_terms, coalesce(length(text), 0) AS n FROM documents)
""")
def term_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX3, TX4: mentions of a term and their density by 1,000 characters."""
    n = T.count_matches(F.col("text"), r"(?i)\bthe\b")
    return documents(spark, sf_dir).select("doc_id", n.alias("n_terms"), T.per_thousand(n, F.coalesce(F.length("text"), F.lit(0))).alias("density"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'licence' WHEN regexp_matches(text, '[A-Za-z0-9_.]+@[A-Za-z0-9_.]+') THEN 'contact' WHEN contains(text, '!!') THEN 'shout'
  WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[$€]') THEN 'money' ELSE 'plain' END AS theme FROM documents
""")
def theme_of_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX7, FLT2."""
    return documents(spark, sf_dir).select("doc_id", T.first_rule(F.col("text"), THEMES, "plain").alias("theme"))


@query("""
SELECT theme, count(*) AS n, sum(n_chars)::BIGINT AS volume, array_to_string(list_slice(list(doc_id ORDER BY n_chars DESC, doc_id), 1, 5), ' ') AS top FROM (
  SELECT *, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN 'licence' WHEN regexp_matches(text, '[A-Za-z0-9_.]+@[A-Za-z0-9_.]+') THEN 'contact' WHEN contains(text, '!!') THEN 'shout'
  WHEN contains(text, ' | ') THEN 'table' WHEN regexp_matches(text, '[$€]') THEN 'money' ELSE 'plain' END AS theme FROM documents) GROUP BY theme
""")
def theme_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG3, TK4: number, volume and five largest examples of each theme; the examples come from a ranked cut, not from a
    list of the whole group. The classified rows are kept without their texts, so that each text is read once."""
    own = cut(documents(spark, sf_dir).select("doc_id", "n_chars", T.first_rule(F.col("text"), THEMES, "plain").alias("theme")))
    sums = own.groupBy("theme").agg(F.count("*").alias("n"), F.sum("n_chars").alias("volume"))
    best = tables.top_per_group(own, ["theme"], [F.desc("n_chars"), F.col("doc_id")], 5)
    top = best.groupBy(F.col("theme").alias("_t")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda x: x["doc_id"].cast("string")).alias("top"))
    return sums.join(top, F.col("theme") == F.col("_t")).select("theme", "n", "volume", F.array_join("top", " ").alias("top"))


@query("SELECT lang, n, volume, volume / sum(volume) OVER () AS share FROM (SELECT lang, count(*) AS n, sum(n_chars)::DOUBLE AS volume FROM documents GROUP BY lang)")
def lang_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG10, AG21."""
    own = documents(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").cast("double").alias("volume"))
    return tables.share_of_total(own, "volume")


#: RE2 knows word borders of ASCII alone; the engine's are those of all scripts.
S_BORDER = r"(?i)(^|[^\p{L}\p{N}_])"


@query(f"""
SELECT doc_id, CASE {" ".join(f"WHEN regexp_matches(text, '{S_BORDER}{name.lower()}') THEN '{name}'" for name in NAMES)} ELSE '' END AS first_name
FROM documents
""")
def dictionary_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX5, JN11: the first entry in order that begins a word; one automaton finds all entries in one pass."""
    found = D.hits(F.col("text"), [D.Entry(name, name, ends=False) for name in NAMES])
    return documents(spark, sf_dir).select("doc_id", D.first_entry(found).alias("first_name"))


@query("SELECT substr(sha1(text), 1, 12) AS fingerprint, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def text_fingerprint_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TX14, ST2."""
    own = documents(spark, sf_dir).filter("text IS NOT NULL").select("doc_id", T.short_hash(F.col("text")).alias("fingerprint"))
    return own.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query("SELECT conv_id, turn, (turn // 10) * 10 + turn % 10 + 1 AS position, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank FROM conversations")
def conversation_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN6, WN8: absolute positions from page and place, and running ranks."""
    from pyspark.sql import Window

    place = (F.floor(F.col("turn") / 10) * 10 + F.pmod("turn", F.lit(10)) + 1).alias("position")
    return conversations(spark, sf_dir).select("conv_id", "turn", place, F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long").alias("rank"))


@query("SELECT conv_id, role, n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, first_turn) AS r FROM (SELECT conv_id, role, count(*) AS n, min(turn) AS first_turn FROM conversations GROUP BY ALL)) WHERE r = 1")
def majority_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG18: ties go to the role that spoke first."""
    return tables.majority(conversations(spark, sf_dir), "conv_id", "role", "turn")


@query("SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r = 1 OR role IS DISTINCT FROM b")
def role_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WN5."""
    return keyed.collapsed(conversations(spark, sf_dir).select("conv_id", "turn", "role"), "conv_id", ["turn"], "role")
