"""Joins and orderings with a promise attached: checked keys, first rows, stacked score columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_to_one(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that fails while running if a key repeats on a side or is missing on one: no separate counting pass."""
    once = lambda df, name: df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*on)))
    both = once(a, "rowkin_n_a").join(once(b, "rowkin_n_b"), on, "full_outer")
    fine = (F.col("rowkin_n_a") == 1) & (F.col("rowkin_n_b") == 1)
    checked = both.withColumn("rowkin_fine", F.when(F.coalesce(fine, F.lit(False)), True).otherwise(F.raise_error(F.lit("keys are not one to one")).cast("boolean")))
    return checked.where("rowkin_fine").drop("rowkin_n_a", "rowkin_n_b", "rowkin_fine")


def stacked(frames: dict[str, DataFrame], on: list[str], score: str) -> DataFrame:
    """Each frame's score as a column of its own, for keys that all frames have."""
    renamed = [df.select(*on, F.col(score).alias(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.join(b, on), renamed)


def first_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order: duplicates dropped the same way every time."""
    return df.withColumn("rowkin_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rowkin_at = 1").drop("rowkin_at")


def back_reference(edited: DataFrame, rec: DataFrame, keys: list[str], take: list[str], order: list[Column]) -> DataFrame:
    """Columns of the first record with the same source text, beside each edited row; nulls where there is none."""
    return edited.join(first_rows(rec, keys, order).select(*keys, *take), keys, "left")


def by_length(df: DataFrame, text: str) -> DataFrame:
    """Rows of a partition in order of length, so that a model's batches need little padding."""
    return df.sortWithinPartitions(F.length(text))


def head_of_groups(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group, for review reports."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= n)


def implied_share(total: float, parts: dict[str, tuple[float, float]], weight: float) -> float:
    """The unknown part of a weighted sum whose other parts (weight, value) are known."""
    return (total - sum(w * v for w, v in parts.values())) / weight
