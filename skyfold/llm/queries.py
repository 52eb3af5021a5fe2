"""The registered query of each operator, over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import (
    collocations,
    compact_windows,
    cotraining,
    decontaminate,
    language_id,
    periodic_runs,
    piece_bpe,
    quality_rules,
    secrets,
    simhash,
    suffix_dedup,
    toxicity,
    url_filters,
)
from skyfold.sources.tables import read_table


def model_path() -> str:
    """The vocabulary file of operator 3, from the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.query(read_table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.query(read_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.query(read_table(spark, sf_dir, "documents"), model_path())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.query(read_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.query(read_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark"))


def op9_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.query(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(read_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.query(read_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.query(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filters, op2_quality_rules, op3_sentencepiece, op4_simhash, op5_suffix_dedup,
        op6_quality_classifier, op7_secret_scans, op8_decontamination, op9_compact_windows, op10_language_id,
        op11_toxicity, op12_collocations, op13_periodic_runs)
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE: dict[str, str] = {
    "op1_url_filters": url_filters.SQL,
    "op2_quality_rules": quality_rules.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op12_collocations": collocations.SQL,
}
