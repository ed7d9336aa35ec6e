"""Splits, bootstrap and synthetic cases, all reproducible from hashes of ids."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def stratified_split(entities: DataFrame, shares: tuple[tuple[str, float], ...], key: str = "s", by: str = "country") -> DataFrame:
    """fold: within each stratum the first share of keys in hash order, then the next; the last fold takes the rest."""
    w = Window.partitionBy(by)
    at = F.row_number().over(w.orderBy(F.md5(F.col(key).cast("string")), key)) / F.count(F.lit(1)).over(w)
    ranked, fold, upto = entities.withColumn("at", at), None, 0.0
    for name, share in shares[:-1]:
        upto += share
        test = F.col("at") <= upto + 1e-12
        fold = F.when(test, name) if fold is None else fold.when(test, name)
    return ranked.withColumn("fold", fold.otherwise(shares[-1][0])).drop("at")


#: Draws that one MD5 gives, sixteen bits each; a draw above 8 is rarer than their resolution.
DRAWS = 8
POISSON = tuple(math.ceil(65536 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(8))


def drawn_from(key: Column, block: Column, salt: str = "boot") -> Column:
    """The MD5 that a block of draws of one key comes from."""
    return F.md5(F.concat_ws("|", F.lit(salt), key.cast("string"), block.cast("string")))


def poisson(digest: Column, i: int) -> Column:
    """Draw i of DRAWS Poisson(1) draws of 0 to 8: four digits of a digest against the distribution, as text, since they sort like their numbers."""
    u = F.substring(digest, 1 + 4 * i, 4)
    return sum(((u >= f"{edge:04x}").cast("int") for edge in POISSON if edge < 65536), F.lit(0))


def paired_bootstrap(deltas: DataFrame, replicates: int = 200, key: str = "s", value: str = "delta") -> DataFrame:
    """(delta, ci_low, ci_high, significant): every entity counts a Poisson(1) number of times in each replicate.

    Entities are never collected: replicates are summed map-side, a constant number of sums per task. A row of an
    entity stands for DRAWS replicates at once.
    """
    blocks = deltas.select(key, value, F.explode(F.sequence(F.lit(0), F.lit(-(-replicates // DRAWS) - 1))).alias("b"))
    drawn = blocks.withColumn("digest", drawn_from(F.col(key), F.col("b"))).withColumns({f"w{i}": poisson(F.col("digest"), i) for i in range(DRAWS)})
    sums = drawn.groupBy("b").agg(*[x for i in range(DRAWS) for x in (F.sum(F.col(f"w{i}") * F.col(value)).alias(f"v{i}"), F.sum(f"w{i}").alias(f"n{i}"))])
    each = F.explode(F.array(*[F.struct((F.col("b") * DRAWS + i).alias("r"), (F.col(f"v{i}") / F.col(f"n{i}")).alias("m")) for i in range(DRAWS)]))
    means = sums.select(each.alias("x")).select("x.r", "x.m").where(F.col("r") < replicates)
    point = deltas.agg(F.avg(value).alias("delta"))
    out = means.agg(F.percentile("m", F.lit(0.025)).alias("ci_low"), F.percentile("m", F.lit(0.975)).alias("ci_high"))
    return point.crossJoin(out).withColumn("significant", (F.col("ci_low") > 0) | (F.col("ci_high") < 0))  # one row each


def keep_rule(delta: float, ci_low: float, tie: float = 0.002) -> str:
    """A change is kept if it gains surely; within the tie it is to be repeated with other seeds."""
    if abs(delta) < tie:
        return "repeat"
    return "keep" if delta > 0 and ci_low > 0 else "reject"


@F.pandas_udf(StringType())
def moved_house(house: pd.Series, seed: pd.Series) -> pd.Series:
    """The number moved by up to 25, with a digit replaced, or two swapped; as many digits as before, else as it was."""
    import random

    def move(h: str, s: int) -> str:
        r = random.Random(s)
        d = "".join(c for c in h if c.isdigit())
        if not d:
            return h
        for _ in range(10):
            op = r.choice(("near", "far", "digit", "swap"))
            new = list(d)
            if op in ("near", "far"):
                new = list(str(max(0, int(d) + r.choice((-1, 1)) * r.randint(1, 2 if op == "near" else 25))))
            elif op == "digit":
                new[r.randrange(len(new))] = r.choice("0123456789")
            elif len(new) > 1:
                i = r.randrange(len(new) - 1)
                new[i], new[i + 1] = new[i + 1], new[i]
            said = "".join(new)
            if said != d and len(said) == len(d) and said[0] != "0":
                return h.replace(d, said, 1) if d in h else said
        return h

    return pd.Series([move(h or "", int(s)) for h, s in zip(house, seed, strict=True)])


def lookalikes(rec: DataFrame, share: float = 0.25) -> DataFrame:
    """Copies of owned records with a moved house number and no owner; some get a word of a neighbour's name. rec: rid, name, house_num, owner."""
    seed = F.xxhash64("rid")
    # the word comes from the next name in a hash order of small groups, so no group grows with the table
    near = Window.partitionBy(F.pmod(F.xxhash64("name"), F.lit(1 << 20))).orderBy(F.xxhash64("rid", F.lit("near")), "rid")
    theirs = F.split(F.coalesce(F.lead("name").over(near), F.lag("name").over(near), F.col("name")), " ")
    word = F.coalesce(F.get(F.array_except(theirs, F.split("name", " ")), F.lit(0)), F.element_at(theirs, -1))
    rec = rec.withColumn("rowkin_word", word)
    extra = F.when(F.pmod(seed, F.lit(1000)) < int(share * 1000), F.concat_ws(" ", "name", "rowkin_word")).otherwise(F.col("name"))
    out = rec.where("owner >= 0 AND house_num != ''").withColumns({"house_num": moved_house("house_num", seed), "name": extra, "owner": F.lit(-1).cast("long"), "synthetic": F.lit(True)})
    return out.drop("rowkin_word")


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """The first whole word ``old`` replaced; a text without it, or an empty word, stays."""
    words = F.split(text, " ")
    at = F.array_position(words, old)
    return F.when((at > 0) & (old != ""), F.array_join(F.transform(words, lambda w, i: F.when(i + 1 == at, new).otherwise(w)), " ")).otherwise(text)


def clipped(guess: Column, low: Column, high: Column) -> Column:
    """A guess within the range that training saw."""
    return F.greatest(low, F.least(high, guess))


def least_biased(guess: Column, spread: Column, weight: float = 0.5) -> Column:
    """The guess taken down by a share of its spread, never below zero: for scores that punish what is too high."""
    return F.greatest(F.lit(0.0), guess - weight * spread)


def snap(values: DataFrame, known: DataFrame, value: str = "v") -> DataFrame:
    """snapped: the nearest known value, the lower one of equally near ones. values: (id, v); known: (v).

    Both are sorted together once; the neighbours below and above come from running windows over value ranges.
    """
    marks = known.select(F.col(value)).distinct().withColumn("known", F.col(value))
    both = values.withColumn("known", F.lit(None).cast("double")).unionByName(marks, allowMissingColumns=True)
    cuts = both.agg(F.percentile_approx(value, [i / 256 for i in range(1, 256)], 10_000)).first()[0]  # equal shares of the rows, whatever their spread
    splits = [-math.inf, *sorted(set(cuts or [])), math.inf]
    both = Bucketizer(splits=splits if len(splits) > 2 else [-math.inf, 0.0, math.inf], inputCol=value, outputCol="band").transform(both)
    ends = both.where("known IS NOT NULL").groupBy("band").agg(F.min("known").alias("first"), F.max("known").alias("last"))  # 256 bands at most
    span = Window.orderBy("band")
    bands = both.select("band").distinct().join(ends, "band", "left").withColumn("under", F.last("last", True).over(span.rowsBetween(Window.unboundedPreceding, -1))).withColumn("over", F.first("first", True).over(span.rowsBetween(1, Window.unboundedFollowing)))
    own, down = (Window.partitionBy("band").orderBy(x) for x in (F.col(value), F.col(value).desc()))  # a frame up to the end would be read anew for each row
    placed = both.withColumn("below", F.last("known", True).over(own.rangeBetween(Window.unboundedPreceding, 0))).withColumn("above", F.last("known", True).over(down.rangeBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(F.broadcast(bands.select("band", "under", "over")), "band").withColumns({"below": F.coalesce("below", "under"), "above": F.coalesce("above", "over")})
    v = F.col(value)
    nearest = F.when(F.col("below").isNull(), F.col("above")).when(F.col("above").isNull(), F.col("below")).when(v - F.col("below") <= F.col("above") - v, F.col("below")).otherwise(F.col("above"))
    return placed.where("known IS NULL").withColumn("snapped", nearest).drop("known", "band", "below", "above", "under", "over")
