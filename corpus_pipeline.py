"""A corpus pipeline over documents: every stage takes all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import minhash, mixing, packing, quality, rules
from tessera.llm.common import drop, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, also those that nearly lack the common words of their language."""
    return rules.passed(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    return minhash.keep_one(docs, minhash.near_duplicates(docs, words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target shares."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, MinHash and packing are no SQL; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again as the next one's docs."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # what a whole stage was made of is not read again
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
