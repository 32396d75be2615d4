"""The contract queries of the dealt operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terroir.llm import (
    decontaminate,
    filter_audit,
    hard_negatives,
    line_dedup,
    mixing,
    ngram_jaccard,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    url_filter,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


@query("op3_line_dedup", line_dedup.ORACLE_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op4_decontamination", decontaminate.ORACLE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


@query("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


@query("op7_warc", warc.ORACLE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_ngram_jaccard", ngram_jaccard.ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.digest(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", filter_audit.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_hard_negatives", hard_negatives.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


@query("op13_mixing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))
