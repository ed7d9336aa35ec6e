"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowkin.plans import blocking_queries, pair_queries, record_queries

PARTS = (blocking_queries, pair_queries, record_queries)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for part in PARTS for k, f in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: q for part in PARTS for k, q in part.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking_queries.owned_candidates(spark, sf_dir)
