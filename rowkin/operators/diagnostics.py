"""Why pairs are missed, what single errors cost, and how two populations differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowkin.operators.metrics import f05, with_total

#: Probability bins of error tables, closed on the left.
P_BINS = (0.02, 0.1, 0.3, 0.5, 0.7, 0.9, 0.98)


def p_bin(p: Column) -> Column:
    """Number of the left-closed bin, from 0."""
    return F.aggregate(F.array(*map(F.lit, P_BINS)), F.lit(0), lambda n, edge: n + (p >= edge).cast("int"))


def recall_gap(truth: DataFrame, left: DataFrame, right: DataFrame, kept: DataFrame, found: DataFrame) -> DataFrame:
    """(s, q, cause) of true pairs that aren't candidates.

    truth, found: s, q. left: s, token; right: q, token (all words); kept: token (words not purged).
    ranked_out: they share a kept word; purged: they share only dropped words; zero_overlap: none.
    """
    missed = truth.select("s", "q").join(found.select("s", "q"), ["s", "q"], "left_anti")
    met = missed.join(left, "s").join(right, ["q", "token"]).join(kept.select("token", F.lit(1).alias("live")), "token", "left")
    shared = met.groupBy("s", "q").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("live", F.lit(0))).alias("n_live"))
    cause = F.when(F.coalesce("n_live", F.lit(0)) > 0, "ranked_out").when(F.coalesce("n", F.lit(0)) > 0, "purged").otherwise("zero_overlap")
    return missed.join(shared, ["s", "q"], "left").select("s", "q", cause.alias("cause"))


def missed_category(s: dict[str, Column], q: dict[str, Column], name_count: Column, name_sim: Column, addr_sim: Column) -> Column:
    """The first that holds: another script, a crowded name, a typing error in a key word, the address alone agrees, other names."""
    own = lambda a, b: F.filter(F.array_except(F.split(a["name"], " "), F.split(b["name"], " ")), lambda t: F.length(t) >= 4)
    typo = F.exists(own(s, q), lambda a: F.exists(own(q, s), lambda b: F.levenshtein(a, b) <= 2))
    return (
        F.when(q["raw_name"].rlike("[ऀ-෿]"), "indic_script")
        .when((name_sim >= 0.9) & (name_count >= 10), "chain_crowded")
        .when(typo, "typo_key_token")
        .when((name_sim < 0.5) & (addr_sim >= 0.7), "address_only")
        .when(name_sim < 0.5, "name_very_different")
        .otherwise("other")
    )


def error_costs(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s, q, kind, p_bin, gain): what an entity's F gains if one error alone were right.

    counts: s, t, k, tp. pairs: s, q, p, label, pred. A missed pair adds a right answer, a wrong one goes.
    """
    wrong = pairs.where(F.col("pred") != F.col("label")).join(counts.select("s", "t", "k", "tp"), "s")
    t, k, tp = F.col("t"), F.col("k"), F.col("tp")
    fixed = F.when(F.col("pred"), f05(t, k - 1, tp)).otherwise(f05(t, k + 1, tp + 1))
    return wrong.select("s", "q", F.when(F.col("pred"), "wrong_accept").otherwise("missed").alias("kind"), p_bin(F.col("p")).alias("p_bin"), (fixed - f05(t, k, tp)).alias("gain"))


def data_profile(entities: DataFrame) -> DataFrame:
    """Per country and over all: entities, share without a match, mean and largest number of matches. entities: s, country, t."""
    return with_total(entities, F.count(F.lit(1)).alias("n"), F.avg((F.col("t") == 0).cast("double")).alias("singleton_share"), F.avg("t").alias("mean_t"), F.max("t").alias("max_t"))


def script_shares(texts: DataFrame, column: str, by: str) -> DataFrame:
    """Shares of texts with letters of Indic scripts, of other non-Latin scripts, and with any sign outside ASCII."""
    t = F.coalesce(F.col(column), F.lit(""))
    share = lambda form: F.avg(t.rlike(form).cast("double"))
    return texts.groupBy(by).agg(share("[ऀ-෿]").alias("indic"), share(r"[\p{L}&&[^\u0000-ɏḀ-ỿऀ-෿]]").alias("other_script"), share(r"[^\x00-\x7F]").alias("non_ascii"))


def shift_ratio(a: DataFrame, b: DataFrame, by: str, entity: str = "s") -> DataFrame:
    """(by, per_a, per_b, ratio): rows per entity of each kind in two populations."""
    per = lambda df, name: df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(df.agg(F.countDistinct(entity).alias("of")))).select(by, (F.col("n") / F.greatest("of", F.lit(1))).alias(name))  # noqa: E731  the count is one row
    both = per(a, "per_a").join(per(b, "per_b"), by, "full_outer").na.fill(0.0, ["per_a", "per_b"])
    return both.withColumn("ratio", F.when(F.col("per_a") > 0, F.col("per_b") / F.col("per_a")))


def band_rows(pairs: DataFrame, low: float = 0.02, high: float = 0.98, easy: float = 0.2) -> DataFrame:
    """Rows for a second, dearer model: all uncertain pairs and a share of the easy ones by hash. pairs: s, q, p."""
    from rowkin.functions.hashing import md5_mod

    inside = F.col("p").between(low, high)
    chosen = md5_mod(F.concat_ws(":", "s", "q"), 1000, "easy") < int(1000 * easy)
    return pairs.withColumn("in_band", inside).where(inside | chosen)


def text_of(rec: DataFrame, mode: str, columns: tuple[str, ...] = ("name", "address")) -> DataFrame:
    """The text that comparisons see: raw, casefold, or normalized (the columns' norm_ forms). Another mode is an error."""
    if mode not in ("raw", "casefold", "normalized"):
        raise ValueError(f"unknown text mode {mode}")
    return rec.withColumns({c: F.col(f"norm_{c}") if mode == "normalized" else F.lower(c) if mode == "casefold" else F.col(c) for c in columns})


def blend_weights(rows: DataFrame, guesses: list[str], y: str, steps: int = 10) -> DataFrame:
    """The weights (of sum 1, in steps) with the least mean squared error, from sums of products: one pass whatever the grid."""
    n = len(guesses)
    names = [*guesses, y]
    sums = rows.agg(*[F.avg(F.col(a) * F.col(b)).alias(f"m_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]).first()
    moment = lambda i, j: sums[f"m_{min(i, j)}_{max(i, j)}"]

    def weights(left: int, parts: int):
        if parts == 1:
            yield (left,)
            return
        for k in range(left + 1):
            for rest in weights(left - k, parts - 1):
                yield (k, *rest)

    def loss(w: tuple[float, ...]) -> float:
        v = [*w, -1.0]
        return sum(v[i] * v[j] * moment(i, j) for i in range(n + 1) for j in range(n + 1))

    best = min((tuple(k / steps for k in w) for w in weights(steps, n)), key=loss)
    return rows.sparkSession.createDataFrame([(g, float(w), float(loss(best))) for g, w in zip(guesses, best, strict=True)], "guess string, weight double, mse double")
