"""The queries opN_<name> over the driver's tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import ann, byte_bpe, fim, licenses, lm_score, materialise, minhash, mixing, packing, quality, rules, snapshots, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), queries="vec_id % 20 = 0", k=20)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op5_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_score.differences(docs, table(spark, sf_dir, "labels").filter("quality = 1"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.materialise(table(spark, sf_dir, "documents"), key=20)


def op9_warc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.report(table(spark, sf_dir, "documents"))


def op13_snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_graph_neighbours,
        op3_quality_classifier,
        op4_source_mixing,
        op5_slack_packing,
        op6_lm_score,
        op7_license_scan,
        op8_token_shards,
        op9_warc_convert,
        op10_quality_rules,
        op11_fill_in_middle,
        op12_byte_bpe,
        op13_snapshot_difference,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_source_mixing": mixing.SQL,
    "op9_warc_convert": warc.SQL,
    "op10_quality_rules": rules.SQL,
    "op11_fill_in_middle": fim.SQL,
    "op13_snapshot_difference": snapshots.SQL,
}
