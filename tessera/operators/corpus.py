"""Keyword corpora, result snapshots and answers: builds, host rollups, shares and candidate lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import url as U
from tessera.operators import tables


def build_corpus(raw: DataFrame) -> DataFrame:
    """AG4: one row per (cc, keyword): the first volume and topic by ordinal, all seeds (sorted), the sum of units.

    raw: cc, keyword, seed, units, volume, topic, ordinal.
    """
    keyed = raw.withColumn("keyword", F.trim("keyword")).filter("keyword <> ''")
    first = F.min_by(F.struct("volume", "topic"), "ordinal")
    out = keyed.groupBy("cc", "keyword").agg(first.alias("f"), F.array_sort(F.collect_set("seed")).alias("seeds"), F.sum("units").alias("units"), F.min("ordinal").alias("ordinal"))
    return out.select("cc", "keyword", F.col("f.volume").alias("volume"), F.col("f.topic").alias("topic"), "seeds", "units", "ordinal")


def selected(corpus: DataFrame, script: str, excluded: str, themes: Sequence[tuple[str, str]], soft: str, intents: Column | None = None, navigational: Column | None = None) -> DataFrame:
    """FLT2: keywords of a script without hard exclusions; those without a theme need an intent, and no soft exclusion or
    navigational intent. Adds theme."""
    k = F.col("keyword")
    df = corpus.filter(k.rlike(script) & ~k.rlike(excluded)).withColumn("theme", T.first_rule(k, themes, "none"))
    wanted = F.coalesce(intents, F.lit(False)) if intents is not None else F.lit(True)
    away = F.coalesce(navigational, F.lit(False)) if navigational is not None else F.lit(False)
    return df.filter((F.col("theme") != "none") | (wanted & ~away & ~k.rlike(soft)))


def corpus_counts(corpus: DataFrame, by: Sequence[str], script: str, least_volume: int = 10) -> DataFrame:
    """AG5, FLT12: number, number in a script, number from a volume on."""
    return corpus.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("keyword").rlike(script)).alias("n_script"), F.count_if(F.col("volume") >= least_volume).alias("n_volume"))


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """D16: one row per position: cc, keyword, place, url, host, rating, types."""
    p = snapshots.select("cc", F.lower(F.trim("keyword")).alias("keyword"), F.posexplode("positions").alias("place", "p"))
    return p.select("cc", "keyword", (F.col("place") + 1).alias("place"), "p.url", U.loc_host(U.unwrap(F.col("p.url"))).alias("host"), F.col("p.domain_rating").alias("rating"), F.col("p.type").alias("types"))


def host_citations(rows: DataFrame, group: str, top: int = 10) -> DataFrame:
    """AG6: per host the distinct queries that cite it, by group, those within the first places, and the rating of its
    first rated row (in order of cc, keyword, place)."""
    q = F.struct("cc", "keyword")
    rated = F.min_by("rating", F.when(F.col("rating").isNotNull(), F.struct("cc", "keyword", "place")))
    per = rows.groupBy("host").agg(F.count_distinct(q).alias("queries"), F.count_distinct(F.when(F.col("place") <= top, q)).alias("top_queries"), F.array_sort(F.collect_set(group)).alias("groups"), rated.alias("rating"))
    return per.orderBy(F.desc("queries"), "host")


def host_rollup(pool: DataFrame, pages: DataFrame, tones: DataFrame, metrics: DataFrame) -> DataFrame:
    """AG7, JN7: per host its URLs, citations, top places, usable pages and flags, with the host's metrics.

    The tables may hold a URL in several rows: each row of the pool, and each page of a URL in the pool, counts once. Rows
    meet in one aggregate by URL, not in joins, which would count every row of one table with every row of another.
    """
    here, none = F.lit(1), F.lit(0)
    parts = [
        pool.select("url", here.alias("_pool"), F.size("cited").alias("_c"), (F.size("cited") > 0).cast("int").alias("_cited"), (F.size("top10") > 0).cast("int").alias("_top"), none.alias("_usable"), F.lit(None).cast("string").alias("_tone")),
        pages.select("url", none, none, none, none, F.coalesce(F.col("words") > 50, F.lit(False)).cast("int"), F.lit(None).cast("string")),
        tones.select("url", none, none, none, none, none, F.col("tone")),
    ]
    by_url = reduce(DataFrame.union, parts).groupBy("url").agg(F.max("_pool").alias("_pool"), *[F.sum(c).alias(c) for c in ("_c", "_cited", "_top", "_usable")], F.array_sort(F.collect_set("_tone")).alias("_tones"))
    known = by_url.filter("_pool = 1").withColumn("host", U.loc_host(F.col("url")))
    tone_sets = F.array_sort(F.array_distinct(F.flatten(F.collect_set("_tones"))))
    per = known.groupBy("host").agg(F.count("url").alias("urls"), F.sum("_c").alias("citations"), F.sum("_cited").alias("cited_urls"), F.sum("_top").alias("top_urls"), F.sum("_usable").alias("usable"), tone_sets.alias("tones"))
    return per.join(metrics.select(F.col("host").alias("_h"), "domain_rating", "refdomains"), F.col("host") == F.col("_h"), "left").drop("_h")


def country_summary(answers: DataFrame) -> DataFrame:
    """AG8: answers asked, shown and naming the brand per country, with whole percents."""
    per = answers.groupBy("cc").agg(F.count("*").alias("asked"), F.count_if("present").alias("shown"), F.count_if(F.col("present") & (F.col("mentions") > 0)).alias("named"))
    return per.withColumn("shown_percent", tables.floor_percent(F.col("shown"), F.col("asked"))).withColumn("named_percent", tables.floor_percent(F.col("named"), F.col("shown")))


def cited_pages(rows: DataFrame) -> DataFrame:
    """AG11: per cited host the number of answers and its most cited page (the smaller URL of equal ones), in two steps."""
    pages = rows.groupBy("host", "url").agg(F.count_distinct("cc", "keyword").alias("n"))
    best = pages.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("m"), "url")).alias("b"))
    hosts = rows.groupBy(F.col("host").alias("_h")).agg(F.count_distinct("cc", "keyword").alias("answers"))
    return best.join(hosts, F.col("host") == F.col("_h")).select("host", "answers", F.col("b.url").alias("page"), (-F.col("b.m")).alias("page_answers"))


def brand_frequency(answers: DataFrame, k: int = 12) -> DataFrame:
    """AG16, AG20: the k brands that most answers of a country name, each once per answer."""
    named = answers.select("cc", F.explode(F.array_distinct("brands")).alias("brand")).groupBy("cc", "brand").agg(F.count("*").alias("n"))
    return tables.top_per_group(named, ["cc"], [F.desc("n"), F.col("brand")], k)


def problem_answers(answers: DataFrame, classes: DataFrame) -> DataFrame:
    """FLT7, JN6: shown and classified answers that do not name the brand well."""
    j = tables.by_normal_key(answers.filter("present"), classes, "cc", "query")
    return j.filter(~(F.coalesce(F.col("mentioned"), F.lit(False)) & (F.coalesce(F.col("sentiment"), F.lit("")) != "negative")))


def candidates(pages: DataFrame, spam: str, own: str, usable: Column, k: int = 60) -> DataFrame:
    """FLT8, TK3: a ranked shortlist of usable pages that are neither spam nor the brand's own."""
    kept = pages.filter(usable & ~F.coalesce(F.col("issues"), F.lit("")).rlike(spam) & ~U.loc_host(F.col("url")).rlike(own))
    return kept.orderBy(F.desc_nulls_last("domain_rating"), F.desc_nulls_last("refdomains"), "url").limit(k)


def request_keys(requests: DataFrame) -> DataFrame:
    """ST8, ST9: requests once per (cc, query, device) in normal form, the first by ordinal."""
    from tessera.operators.keyed import earliest

    normal = requests.withColumn("_q", F.lower(F.trim("query")))
    return earliest(normal, ["cc", "_q", "device"], ["ordinal"]).drop("_q")


def page_analysis(pages: DataFrame, brands: Sequence[tuple[str, str]], target: str, negative: str) -> DataFrame:
    """D18: words, brands in order of first mention, the target's rank, negative terms near it, contexts and a hash."""
    from tessera.operators.keyed import first_mention_ranks

    at = T.match_positions(F.col("text"), target)
    df = pages.withColumn("_at", at).withColumn("brands_order", first_mention_ranks(F.col("text"), brands))
    rank = F.nullif(F.array_position("brands_order", F.lit(target)), F.lit(0).cast("long"))
    return df.select("url", F.size(F.split(F.trim("text"), r"\s+")).alias("words"), "brands_order", F.size("brands_order").alias("n_brands"), rank.alias("target_rank"), T.near_count(F.col("text"), F.col("_at"), negative).alias("neg_near"), T.contexts(F.col("text"), F.col("_at"), 220, 260).alias("ctx"), T.short_hash(F.col("text")).alias("text_sha"))
