"""Partition keys of addresses and routes between them: a query searches few keys instead of its whole country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_COUNT, COVERAGE, MIN_MATCHES = 50, 0.997, 30
PURITY, SUPPORT, MAX_KEYS, MAX_SELF_MISS = 0.98, 20, 2, 0.002


def place_parts(parts: DataFrame, carry: list[str], column: str = "parts") -> DataFrame:
    """(carry, part, at): address parts without digits, with their place in the record."""
    return parts.select(*carry, F.posexplode(column).alias("at", "part")).where((F.col("part") != "") & ~F.col("part").rlike("[0-9]"))


def key_vocabulary(parts: DataFrame, by: list[str], least: int = MIN_COUNT) -> DataFrame:
    """(by, part, n): parts that occur often enough. parts: (by, part)."""
    return parts.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def assign_keys(parts: DataFrame, vocabulary: DataFrame, by: list[str], rid: str = "rid") -> DataFrame:
    """(rid, key): a record's most frequent known part; the first one of equal ones."""
    return parts.hint("merge").join(vocabulary, [*by, "part"]).groupBy(rid).agg(F.max_by("part", F.struct(F.col("n"), -F.col("at"))).alias("key"))


def coverage_routes(matches: DataFrame, by: list[str], coverage: float = COVERAGE, least: int = MIN_MATCHES) -> DataFrame:
    """(by, qkey, skey): the fewest S1 keys that cover a query key's matches. matches: (by, qkey, skey).

    Matches of an S1 without a key ("") count as covered beforehand; rare query keys get no route.
    """
    group = [*by, "qkey"]
    counts = matches.groupBy(*group, "skey").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(*group)
    before = every.orderBy((F.col("skey") == "").desc(), F.col("n").desc(), "skey").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("total", F.sum("n").over(every)).withColumn("covered", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ranked.where((F.col("total") >= least) & (F.col("skey") != "") & (F.col("covered") / F.col("total") < coverage)).select(*group, "skey", "n")


def place_table(parts: DataFrame, keys: DataFrame, purity: float = PURITY, support: int = SUPPORT, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, part, key): parts that stand with one key nearly always. parts: (by, rid, part), keys: (rid, key)."""
    together = parts.select(*by, "rid", "part").distinct().join(keys.where("key != ''").hint("merge"), "rid").groupBy(*by, "part", "key").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by, "part")
    ranked = together.withColumn("total", F.sum("n").over(w)).withColumn("at", F.row_number().over(w.orderBy(F.col("n").desc(), "key")))
    return ranked.where((F.col("at") == 1) & (F.col("total") >= support) & (F.col("n") / F.col("total") >= purity)).select(*by, "part", "key")


def resolve(parts: DataFrame, table: DataFrame, by: tuple[str, ...] = (), most: int = MAX_KEYS) -> DataFrame:
    """(rid, route): the keys of a record's parts, sorted; no row where there are none or too many."""
    found = parts.hint("merge").join(table, [*by, "part"]).groupBy("rid").agg(F.array_sort(F.collect_set("key")).alias("route"))
    return found.where(F.size("route") <= most)


def label_free_routes(s1: DataFrame, queries: DataFrame, by: tuple[str, ...] = (), least: int = MIN_COUNT, purity: float = PURITY, support: int = SUPPORT, most_miss: float = MAX_SELF_MISS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keys of S1, routes of queries, self-check) without labels. s1, queries: (by, rid, at, part).

    A table from places to keys is learned from S1, then extended once by parts of any
    record that resolves to one key. If S1's own places miss their key too often,
    nothing is routed: the gate is part of the plan, not a driver's decision.
    """
    keys = assign_keys(s1, key_vocabulary(s1, list(by), least), list(by))
    first = place_table(s1, keys, purity, support, by)
    every = s1.unionByName(queries)
    single = resolve(every, first, by).where(F.size("route") == 1).select("rid", F.col("route")[0].alias("key"))
    more = place_table(every, single, purity, support, by).hint("merge").join(first.select(*by, "part"), [*by, "part"], "left_anti")
    table = first.unionByName(more)
    # a row per record on both sides: small as files, large in a driver's memory, so never broadcast
    own = s1.select(*by, "rid").distinct().join(keys.hint("merge"), "rid", "left").join(resolve(s1, table, by).hint("merge"), "rid", "left")
    missed = F.col("route").isNotNull() & F.col("key").isNotNull() & ~F.coalesce(F.array_contains("route", F.col("key")), F.lit(False))
    check = own.agg(F.avg(missed.cast("double")).alias("self_miss"))
    routes = resolve(queries, table, by).crossJoin(F.broadcast(check)).where(F.col("self_miss") <= most_miss).drop("self_miss")  # check is one row
    return keys, routes, check


def share_of_keys(keyed: DataFrame, share: float) -> DataFrame:
    """(key, n): keys in the order of their hash until they hold the share of all rows. keyed: (key)."""
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    # a running sum in two steps: over 4,096 ranges of the hash, and within each
    counts = counts.withColumn("hash", F.md5("key")).withColumn("range", F.substring("hash", 1, 3))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("range").orderBy("hash", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(ranges), "range")
    return placed.withColumn("before", F.col("ahead") + F.col("own")).crossJoin(F.broadcast(total)).where(F.col("before") < share * F.col("total")).select("key", "n")
