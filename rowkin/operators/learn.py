"""Rewrites learned from matched pairs: address parts, words, and a dictionary of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowkin.functions.similarity import indel_ratio
from rowkin.functions.text import skeleton

REWRITE_SUPPORT, REWRITE_PRECISION = 50, 0.95
DICTIONARY_SUPPORT, DICTIONARY_PRECISION = 20, 0.90


def related(x: Column, y: Column) -> Column:
    """One form abbreviates or misspells the other: prefix, initials, letters left out, same skeleton, one edit. Never with digits."""
    swap = F.length(x) > F.length(y)
    short, long = F.when(swap, y).otherwise(x), F.when(swap, x).otherwise(y)
    two = F.length(short) >= 2
    initials = F.array_join(F.transform(F.split(long, " "), lambda w: F.substring(w, 1, 1)), "")
    closed = F.replace(long, F.lit(" "), F.lit(""))
    # letters of the short form in order within the long one: what is left of it after a walk along the long one
    left = F.aggregate(F.split(closed, ""), short, lambda s, c: F.when((s != "") & s.startswith(c), F.substring(s, 2, 1_000_000)).otherwise(s))
    abbreviates = two & (F.substring(short, 1, 1) == F.substring(long, 1, 1)) & ~short.contains(" ") & (left == "")
    sounds = (skeleton(x) != "") & (skeleton(x) == skeleton(y))
    edited = (F.length(short) >= 5) & (F.levenshtein(x, y) <= 1)
    plain = (x != y) & (x != "") & (y != "") & ~F.concat(x, y).rlike("[0-9]")
    said = two & long.contains(" ") & (F.replace(short, F.lit(" "), F.lit("")) == initials)
    return plain & ((two & long.startswith(short)) | said | abbreviates | sounds | edited)


def single_difference(pairs: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """(by, form, target): pairs whose arrays differ in exactly one element on each side; form is b's."""
    left, right = F.array_except(a, b), F.array_except(b, a)
    return pairs.where((F.size(left) == 1) & (F.size(right) == 1)).select(*by, right[0].alias("form"), left[0].alias("target"))


def select(seen: DataFrame, by: list[str], support: int, precision: float, good: Column) -> DataFrame:
    """(by, form, target, n, total): the best target of a form if it is frequent and precise enough.

    ``good`` marks rows that count for a target; all rows count for the total.
    """
    counts = seen.groupBy(*by, "form", "target").agg(F.sum(good.cast("long")).alias("n"), F.count(F.lit(1)).alias("all"))
    w = Window.partitionBy(*by, "form")
    ranked = counts.withColumn("total", F.sum("all").over(w)).withColumn("at", F.row_number().over(w.orderBy(F.col("n").desc(), "target")))
    return ranked.where((F.col("at") == 1) & (F.col("n") >= support) & (F.col("n") / F.col("total") >= precision)).select(*by, "form", "target", "n", "total")


def learn_rewrites(pairs: DataFrame, a: str, b: str, by: list[str], support: int = REWRITE_SUPPORT, precision: float = REWRITE_PRECISION) -> DataFrame:
    seen = single_difference(pairs, a, b, by)
    return select(seen, by, support, precision, related(F.col("form"), F.col("target")))


def aligned(pairs: DataFrame, q: str, s: str, by: list[str]) -> DataFrame:
    """(by, form, target): words side by side where the counts agree, else each with its closest word if that is close at all."""
    same = F.size(q) == F.size(s)
    straight = pairs.where(same & (F.size(q) > 0)).select(*by, F.explode(F.arrays_zip(F.col(q).alias("form"), F.col(s).alias("target"))).alias("x")).select(*by, "x.form", "x.target")
    keyed = pairs.where(~same & (F.size(q) > 0) & (F.size(s) > 0)).withColumn("pair_key", F.monotonically_increasing_id())
    crossed = keyed.select(*by, "pair_key", F.posexplode(q).alias("at", "form"), s).select(*by, "pair_key", "at", "form", F.posexplode(s).alias("s_at", "target"))
    scored = crossed.withColumn("sim", indel_ratio(F.col("form"), F.col("target")))
    best = scored.groupBy(*by, "pair_key", "at", "form").agg(F.max_by(F.struct("target", "sim"), F.struct(F.col("sim"), -F.col("s_at"))).alias("x"))
    close = (F.col("x.sim") >= 0.40) | (skeleton(F.col("form")) == skeleton(F.col("x.target")))
    return straight.unionByName(best.where(close).select(*by, "form", "x.target"))


def learn_dictionary(pairs: DataFrame, q: str, s: str, by: list[str], support: int = DICTIONARY_SUPPORT, precision: float = DICTIONARY_PRECISION) -> DataFrame:
    seen = aligned(pairs, q, s, by)
    return select(seen, by, support, precision, F.col("form") != F.col("target")).where("form != target")
