"""Columns that compare a pair with the other pairs of its query and of its entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_in(group: str | list[str], *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(group).orderBy(*order))


def second_best(group: str | list[str], p: str) -> Column:
    """Second-largest value of the group, 0 if it has one row."""
    whole = Window.partitionBy(group).orderBy(F.col(p).desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.nth_value(p, 2).over(whole), F.lit(0.0))


def margin(group: str | list[str], p: str) -> Column:
    """To the second best for the best, to the best for the others."""
    best = F.max(p).over(Window.partitionBy(group))
    return F.when(F.col(p) >= best, F.col(p) - second_best(group, p)).otherwise(F.col(p) - best)


def add_context(pairs: DataFrame, channels: list[str]) -> DataFrame:
    """best score over channels, the query's best, margin to it, pairs of the query and of the entity, entity's first ranks."""
    q, s = Window.partitionBy("q"), Window.partitionBy("s")
    first = F.least(*[F.col(f"{c}_rank") for c in channels]) == 0 if len(channels) > 1 else F.col(f"{channels[0]}_rank") == 0
    out = pairs.withColumn("best", F.greatest(*[F.col(f"{c}_score") for c in channels]) if len(channels) > 1 else F.col(f"{channels[0]}_score"))
    out = out.withColumn("q_best", F.max("best").over(q)).withColumn("q_cnt", F.count(F.lit(1)).over(q))
    return out.withColumn("margin", F.col("best") - F.col("q_best")).withColumn("s_cnt", F.count(F.lit(1)).over(s)).withColumn("s_first", F.sum(first.cast("long")).over(s))


def mutual_best(p: str) -> Column:
    return (F.col(p) >= F.max(p).over(Window.partitionBy("q"))) & (F.col(p) >= F.max(p).over(Window.partitionBy("s")))


def one_owner(pairs: DataFrame, p: str = "p") -> DataFrame:
    """keep: the record's pair of highest p; ties go to the lower entity."""
    return pairs.withColumn("keep", first_in("q", F.col(p).desc(), F.col("s")) == 1)


def cap_per_entity(pairs: DataFrame, most: int, p: str = "p") -> DataFrame:
    return pairs.withColumn("at", first_in("s", F.col(p).desc(), F.col("q"))).where(F.col("at") <= most)


def crowd(pairs: DataFrame, rec: DataFrame) -> DataFrame:
    """Ten columns on how crowded a pair's name, address and street are.

    rec: rid, source, country, name_core, addr, street. pairs: q, s, p. Empty text collides with nothing.
    """
    s1 = rec.where("source = 1")

    def shared(column: str, name: str) -> DataFrame:
        return s1.where(F.col(column) != "").groupBy("country", column).agg(F.count(F.lit(1)).alias(name))

    sides = rec
    for column in ("name_core", "addr", "street"):
        sides = sides.join(shared(column, f"n_{column}"), ["country", column], "left")
    side = lambda x: sides.select(F.col("rid").alias(x), F.col("name_core").alias(f"{x}_core"), *[F.coalesce(f"n_{c}", F.lit(0)).alias(f"{x}_{c}") for c in ("name_core", "addr", "street")])
    both = pairs.join(side("q"), "q").join(side("s"), "s")
    rival = F.when(F.col("s_core") == "", F.concat(F.lit("\x00"), F.col("s").cast("string"))).otherwise(F.col("s_core"))
    both = both.withColumn("rival", rival)
    group = ["q", "rival"]
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    return both.select(
        "q",
        "s",
        F.greatest(F.col("s_name_core"), F.lit(1)).alias("name_dup_country"),
        n.alias("name_dup_cand"),
        first_in(group, F.col("p").desc(), F.col("s")).alias("crowd_rank"),
        F.when(n > 1, margin(group, "p")).otherwise(1.0).alias("crowd_margin"),
        ((F.col("q_core") == F.col("s_core")) & (F.col("q_core") != "")).cast("int").alias("q_core_equal"),
        F.col("s_addr").alias("addr_dup_country"),
        F.col("s_street").alias("street_dup_country"),
        F.col("q_name_core").alias("q_name_dup_country"),
        F.col("q_addr").alias("q_addr_dup_country"),
        F.col("q_street").alias("q_street_dup_country"),
    )


def siblings(pairs: DataFrame, rec: DataFrame, similarity, top: int = 8, strong_p: float = 0.5, strong_sim: float = 0.8) -> DataFrame:
    """Support of an entity's best candidates for each of its pairs, itself excluded.

    similarity(a, b) compares names and addresses. pairs: q, s, p. rec: rid, name_core, addr, house_num, postcode, source.
    The best few are joined to the entity's pairs, so a group grows by a constant factor.
    """
    # records and pairs are never broadcast: small as files, they are large in a driver's memory
    one = lambda x: rec.select(F.col("rid").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("name_core", "addr", "house_num", "postcode", "source")]).hint("merge")
    best = pairs.withColumn("at", first_in("s", F.col("p").desc(), F.col("q"))).where(F.col("at") <= top).select("s", F.col("q").alias("t"), F.col("p").alias("w"))
    met = pairs.select("q", "s").join(best.hint("merge"), "s").where("q != t").join(one("q"), "q").join(one("t"), "t")
    met = met.withColumn("name", similarity(F.col("q_name_core"), F.col("t_name_core"))).withColumn("address", similarity(F.col("q_addr"), F.col("t_addr")))
    strong = F.col("w") >= strong_p
    same = lambda c: ((F.col(f"q_{c}") == F.col(f"t_{c}")) & (F.col(f"q_{c}") != "")).cast("double")
    found = met.groupBy("q", "s").agg(
        F.max(F.col("name") * F.col("w")).alias("sib_support_name"),
        F.max(F.col("address") * F.col("w")).alias("sib_support_addr"),
        F.sum((strong & (F.col("name") >= strong_sim)).cast("long")).alias("sib_strong_name"),
        F.sum((strong & (F.col("address") >= strong_sim)).cast("long")).alias("sib_strong_addr"),
        F.avg(F.when(strong, F.col("name"))).alias("sib_mean_name"),
        F.avg(F.when(strong, F.col("address"))).alias("sib_mean_addr"),
        F.max(F.when(F.col("q_source") == F.col("t_source"), F.col("name") * F.col("w")).otherwise(0.0)).alias("sib_same_source"),
        F.max(same("house_num") * F.col("w")).alias("sib_house"),
        F.max(same("postcode") * F.col("w")).alias("sib_postcode"),
    )
    missing = {c: -1.0 if "mean" in c else 0 for c in found.columns if c not in ("q", "s")}
    out = pairs.join(found.hint("merge"), ["q", "s"], "left").na.fill(missing)
    s = Window.partitionBy("s")
    return (
        out.withColumn("q_p_margin", margin("q", "p"))
        .withColumn("s_p_rank", first_in("s", F.col("p").desc(), F.col("q")))
        .withColumn("s_p_sum", F.sum("p").over(s))
        .withColumn("s_p_count", F.sum((F.col("p") > 0.5).cast("long")).over(s))
        .withColumn("s_p_max", F.max("p").over(s))
        .withColumn("q_is_argmax", (F.col("p") >= F.max("p").over(Window.partitionBy("q"))).cast("int"))
    )


def cross_source(pairs: DataFrame, rec: DataFrame, similarity, among: int = 12, most: int = 6) -> DataFrame:
    """For each pair the best similarity to candidates of the entity from another source, and whether the entity's top is that one; -1 without any."""
    one = lambda x: rec.select(F.col("rid").alias(x), F.col("name_core").alias(f"{x}_core"), F.col("source").alias(f"{x}_source"))
    ranked = pairs.withColumn("at", first_in("s", F.col("p").desc(), F.col("q")))
    near = ranked.where(F.col("at") <= among).select("s", F.col("q").alias("t"), F.col("at").alias("t_at")).join(one("t"), "t")
    met = ranked.select("q", "s").join(one("q"), "q").join(near, "s").where("q_source != t_source")
    met = met.withColumn("k", first_in(["q", "s"], F.col("t_at"))).where(F.col("k") <= most).withColumn("sim", similarity(F.col("q_core"), F.col("t_core")))
    best = met.groupBy("q", "s").agg(F.max("sim").alias("cross_best_sim"), (F.max_by("t_at", F.struct("sim", -F.col("t_at"))) == 1).cast("int").alias("cross_best_is_top"))
    return pairs.join(best, ["q", "s"], "left").na.fill({"cross_best_sim": -1.0, "cross_best_is_top": -1})
