"""The queries op1 to op10, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowkin.llm import oracles
from rowkin.llm.common import table
from rowkin.llm.decontaminate import decontaminate
from rowkin.llm.licenses import scan_licenses
from rowkin.llm.ngram_join import near_duplicates
from rowkin.llm.packing import best_fit
from rowkin.llm.pii import find_personal
from rowkin.llm.pseudo_likelihood import score_documents
from rowkin.llm.quality import quality_rules
from rowkin.llm.toxicity import score_toxicity
from rowkin.llm.training_order import write_training_order
from rowkin.llm.url_filter import filter_urls


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_training_order(table(spark, sf_dir, "documents"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op7_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_training_order": op1_training_order,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_url_filters": op6_url_filters,
    "op7_pseudo_likelihood": op7_pseudo_likelihood,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scan": op10_license_scan,
}

ORACLE_SQL: dict[str, str] = {"op8_ngram_jaccard_join": oracles.NEAR_DUPLICATES}
