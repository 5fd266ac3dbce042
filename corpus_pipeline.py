"""Training-data pipeline over ``documents``: five stages, each by one operator of ``ledgerlake.llm``.

Every stage works on the rows that its predecessor kept and hands on the columns of
``documents``; the last one adds the rate at which a document should be read.

1. language: documents that language identification rejects go.
2. exact copies: of equal texts the row with the largest ``doc_id`` stays.
3. near copies: of each group of similar documents the one with the smallest ``doc_id`` stays.
4. benchmark: documents that overlap a benchmark item go.
5. mixing: every document gets a rate; one whose rate is zero would not be read and goes.

Rows that agree in ``doc_id`` and text are one document written twice; one of them stays. Nulls,
empty texts and empty tables are treated as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import blocks, decontaminate, exact_dedup, jaccard_join, language_id, mixing


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels are those of the stage's own rows."""
    return language_id.accepted(docs, language_id.train(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The earlier half of the identifiers is history, the later half arrives."""
    ends = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    early = F.coalesce(F.col("doc_id") <= ((ends[0] or 0) + (ends[1] or 0)) // 2, F.lit(False))
    decisions = blocks.stored(exact_dedup.exact_dedup(docs.where(early), docs.where(~early)), "decisions")
    return exact_dedup.keep_one_row(docs, decisions)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decisions = blocks.stored(jaccard_join.similar_groups(docs), "decisions")
    return exact_dedup.keep_one_row(docs, decisions)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.domain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.with_rates(docs, labels).where("rate > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("mixed", mixed),
]

#: SQL cannot express the classifiers and the projected gradient.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = blocks.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
