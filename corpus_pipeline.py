"""Corpus pipeline over ``documents``; each stage is written as Parquet and reread as the next one's input.

Quality rules drop what they reject; one document of each near-duplicate class
stays; documents that hold benchmark items go; personal data is masked; what is
left is packed into training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowkin.llm.common import materialise, release, table
from rowkin.llm.decontaminate import drop_leaks
from rowkin.llm.ngram_join import keep_one
from rowkin.llm.packing import best_fit
from rowkin.llm.pii import mask_personal
from rowkin.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_personal(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal),
    ("best-fit packing", pack),
]

#: The stages hold models that SQL cannot express; tests/llm compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
