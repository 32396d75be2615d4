"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark
decontamination, packing.

Each stage takes the documents its predecessor kept; ``run`` writes every
stage's result as Parquet below the shared folder and reads it back.  All but
the last stage return the columns of ``documents``.

Defined results: what each operator's docstring says of nulls, empty and very long
texts and ties holds for its stage.  Texts without 50 words are rejected by the
first stage.  Of repeated rows (one doc_id and text) one stays after the near-duplicate
stage; rows of one doc_id with different texts are judged each by its own text.
Extra columns, clashing names included, pass through the first four stages.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terroir.llm import decontaminate, line_dedup, ngram_jaccard, packing, quality_rules
from terroir.llm.storage import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.reject(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across documents."""
    return line_dedup.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_jaccard.one_per_group(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every remaining document, as training sequences."""
    return packing.digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rule_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# Robust covariances and tokenisation are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
