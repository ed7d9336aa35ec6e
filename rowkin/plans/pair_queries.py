"""Queries over scored pairs: context, features of pairs, decoding, metrics, answer lists, learners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowkin.functions import house as H
from rowkin.functions import similarity as sim
from rowkin.functions.hashing import fold_of
from rowkin.operators import context as C
from rowkin.operators import decode as D
from rowkin.operators import diagnostics as G
from rowkin.operators import features as X
from rowkin.operators import learn, learner
from rowkin.operators import metrics as M
from rowkin.operators import relational as L
from rowkin.operators import resample as R
from rowkin.operators import submissions as S
from rowkin.plans import matching
from rowkin.plans.blocking_queries import md5_sql
from rowkin.plans import views as V
from rowkin.sources.tables import append_ledger, null_profile

CUT = 0.6


def _r(c, n: int = 6):
    return F.round(c, n)


# ---- windows over pairs ----


def one_owner(spark: SparkSession, d: str) -> DataFrame:
    return C.one_owner(V.pairs(spark, d)).select("s", "q", "p", "keep")


def cap_per_entity(spark: SparkSession, d: str) -> DataFrame:
    return C.cap_per_entity(V.pairs(spark, d), 3).select("s", "q", "p", F.col("at").cast("long").alias("place"))


def mutual_best(spark: SparkSession, d: str) -> DataFrame:
    return V.pairs(spark, d).withColumn("mutual", C.mutual_best("p")).select("s", "q", "mutual")


def second_best_margin(spark: SparkSession, d: str) -> DataFrame:
    p = V.pairs(spark, d)
    return p.withColumn("second", C.second_best("q", "p")).withColumn("margin", _r(C.margin("q", "p"))).select("s", "q", "second", "margin")


def crowd_features(spark: SparkSession, d: str) -> DataFrame:
    out = C.crowd(V.crowd_pairs(spark, d), V.crowd_records(spark, d))
    return out.select("q", "s", *[F.col(c).cast("long").alias(c) for c in ("name_dup_country", "name_dup_cand", "crowd_rank", "q_core_equal", "addr_dup_country", "street_dup_country", "q_name_dup_country", "q_addr_dup_country", "q_street_dup_country")], _r("crowd_margin").alias("crowd_margin"))


_CROWD_SQL = f"""WITH {V.CROWD}, nn AS (SELECT country, name_core AS v, count(*) AS n FROM crec WHERE source = 1 GROUP BY 1, 2), na AS (SELECT country, addr AS v, count(*) AS n FROM crec WHERE source = 1 GROUP BY 1, 2),
ns AS (SELECT country, street AS v, count(*) AS n FROM crec WHERE source = 1 GROUP BY 1, 2),
side AS (SELECT r.rid, r.name_core, coalesce(nn.n, 0) AS n1, coalesce(na.n, 0) AS n2, coalesce(ns.n, 0) AS n3 FROM crec r LEFT JOIN nn ON nn.country = r.country AND nn.v = r.name_core
  LEFT JOIN na ON na.country = r.country AND na.v = r.addr LEFT JOIN ns ON ns.country = r.country AND ns.v = r.street),
b AS (SELECT p.q, p.s, p.p, x.name_core AS qc, y.name_core AS sc, x.n1 AS q1, x.n2 AS q2, x.n3 AS q3, y.n1 AS s1, y.n2 AS s2, y.n3 AS s3 FROM cpairs p JOIN side x ON x.rid = p.q JOIN side y ON y.rid = p.s),
w AS (SELECT *, count(*) OVER g AS n, row_number() OVER (PARTITION BY q, sc ORDER BY p DESC, s) AS k, max(p) OVER g AS best, nth_value(p, 2) OVER (PARTITION BY q, sc ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM b WINDOW g AS (PARTITION BY q, sc))
SELECT q, s, greatest(s1, 1) AS name_dup_country, n AS name_dup_cand, k AS crowd_rank, CAST(qc = sc AS BIGINT) AS q_core_equal, s2 AS addr_dup_country, s3 AS street_dup_country, q1 AS q_name_dup_country, q2 AS q_addr_dup_country, q3 AS q_street_dup_country,
round(CASE WHEN n > 1 THEN CASE WHEN p >= best THEN p - second ELSE p - best END ELSE 1.0 END, 6) AS crowd_margin FROM w"""


def _sim_rec(spark: SparkSession, d: str) -> DataFrame:
    return V.crowd_records(spark, d).select("rid", "name_core", "addr", F.lit("").alias("house_num"), F.col("street").alias("postcode"), F.col("source"))


def _jac(a, b):
    return _r(sim.jaccard(sim.distinct_tokens(a), sim.distinct_tokens(b)))


def sibling_support(spark: SparkSession, d: str) -> DataFrame:
    out = C.siblings(V.crowd_pairs(spark, d), _sim_rec(spark, d), _jac)
    return out.select("q", "s", *[_r(c).alias(c) for c in ("sib_support_name", "sib_support_addr", "sib_mean_name", "sib_same_source", "sib_postcode")], F.col("sib_strong_name").cast("long").alias("sib_strong_name"), F.col("s_p_count"), F.col("q_is_argmax").cast("long").alias("q_is_argmax"))


_J = "round(CASE WHEN len(list_distinct(list_concat({a}, {b}))) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END, 6)"


def _words(c: str) -> str:
    return f"list_distinct(string_split({c}, ' '))"


_SIB_SQL = f"""WITH {V.CROWD}, best AS (SELECT s, q AS t, p AS w FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p DESC, q) AS k FROM cpairs) WHERE k <= 8),
met AS (SELECT p.q, p.s, b.w, {_J.format(a=_words("x.name_core"), b=_words("y.name_core"))} AS name, {_J.format(a=_words("x.addr"), b=_words("y.addr"))} AS address, x.source = y.source AS same, x.street = y.street AS post
  FROM cpairs p JOIN best b ON b.s = p.s AND b.t <> p.q JOIN crec x ON x.rid = p.q JOIN crec y ON y.rid = b.t),
f AS (SELECT q, s, max(name * w) AS n, max(address * w) AS a, avg(CASE WHEN w >= 0.5 THEN name END) AS m, max(CASE WHEN same THEN name * w ELSE 0 END) AS ss, max(CASE WHEN post THEN w ELSE 0 END) AS pc, sum(CASE WHEN w >= 0.5 AND name >= 0.8 THEN 1 ELSE 0 END) AS st FROM met GROUP BY 1, 2)
SELECT p.q, p.s, round(coalesce(n, 0), 6) AS sib_support_name, round(coalesce(a, 0), 6) AS sib_support_addr, round(coalesce(m, -1), 6) AS sib_mean_name, round(coalesce(ss, 0), 6) AS sib_same_source, round(coalesce(pc, 0), 6) AS sib_postcode, CAST(coalesce(st, 0) AS BIGINT) AS sib_strong_name,
CAST(sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) OVER (PARTITION BY p.s) AS BIGINT) AS s_p_count, CAST(p >= max(p) OVER (PARTITION BY p.q) AS BIGINT) AS q_is_argmax FROM cpairs p LEFT JOIN f ON f.q = p.q AND f.s = p.s"""


def cross_source_best(spark: SparkSession, d: str) -> DataFrame:
    out = C.cross_source(V.crowd_pairs(spark, d), _sim_rec(spark, d), _jac)
    return out.select("q", "s", _r("cross_best_sim").alias("cross_best_sim"), F.col("cross_best_is_top").cast("long").alias("cross_best_is_top"))


_CROSS_SQL = f"""WITH {V.CROWD}, rk AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p DESC, q) AS pos FROM cpairs),
met AS (SELECT p.q, p.s, t.pos, x.name_core AS a, y.name_core AS b FROM rk p JOIN rk t ON t.s = p.s AND t.pos <= 12 JOIN crec x ON x.rid = p.q JOIN crec y ON y.rid = t.q WHERE x.source <> y.source),
six AS (SELECT q, s, pos, {_J.format(a=_words("a"), b=_words("b"))} AS sim FROM (SELECT *, row_number() OVER (PARTITION BY q, s ORDER BY pos) AS k FROM met) WHERE k <= 6),
f AS (SELECT q, s, sim, pos FROM (SELECT *, row_number() OVER (PARTITION BY q, s ORDER BY sim DESC, pos) AS k FROM six) WHERE k = 1)
SELECT p.q, p.s, coalesce(sim, -1) AS cross_best_sim, CASE WHEN sim IS NULL THEN -1 ELSE CAST(f.pos = 1 AS BIGINT) END AS cross_best_is_top FROM cpairs p LEFT JOIN f ON f.q = p.q AND f.s = p.s"""


# ---- features of two texts ----


def house_relation(spark: SparkSession, d: str) -> DataFrame:
    return V.house_pairs(spark, d).select("line", "a", "b", H.relation(F.col("a"), F.col("b")).alias("rel"), H.known_different(F.col("a"), F.col("b")).alias("differs"))


_REL = """CASE WHEN a = '' OR b = '' THEN 'missing' WHEN a = b THEN 'equal' WHEN x = '' OR y = '' THEN 'different' WHEN x = y THEN CASE WHEN ltrim(a, '0') = ltrim(b, '0') THEN 'equal' ELSE 'letters_only' END
WHEN abs(length(x) - length(y)) = 1 AND levenshtein(x, y) = 1 THEN 'digit_dropped_or_added'
WHEN length(x) = length(y) AND levenshtein(x, y) = 1 THEN CASE WHEN abs(CAST(x AS BIGINT) - CAST(y AS BIGINT)) <= 2 THEN 'near_1_2' ELSE 'digit_substituted' END
WHEN array_to_string(list_sort(string_split(x, '')), '') = array_to_string(list_sort(string_split(y, '')), '') THEN 'permuted' WHEN starts_with(x, y) OR starts_with(y, x) THEN 'prefix_or_extension' ELSE 'different' END"""
_HOUSE_SQL = f"""WITH {V.HOUSES}, r AS (SELECT line, a, b, {_REL} AS rel FROM houses2) SELECT line, a, b, rel, rel IN ('digit_dropped_or_added', 'digit_substituted', 'near_1_2', 'permuted', 'prefix_or_extension', 'different') AS differs FROM r"""


def house_gap(spark: SparkSession, d: str) -> DataFrame:
    side = lambda h: {"house_num": F.col(h), "num_tokens": F.lit(""), "postcode": F.lit("")}
    f = H.pair_features(side("a"), side("b"))
    keep = ("house_digit_edit", "house_in_other", "house_num_overlap", "house_gap", "house_gap_log", "house_gap_small", "house_same_len")
    return V.house_pairs(spark, d).select("line", "a", "b", *[_r(f[c]).alias(c) for c in keep])


_GAP_SQL = f"""WITH {V.HOUSES} SELECT line, a, b, CASE WHEN x <> '' AND y <> '' THEN levenshtein(x, y)::DOUBLE ELSE -1 END AS house_digit_edit, CASE WHEN y <> '' THEN (x = y)::DOUBLE ELSE -1 END AS house_in_other,
CASE WHEN x = '' AND y = '' THEN -1.0::DOUBLE WHEN x = y THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS house_num_overlap, CASE WHEN x <> '' AND y <> '' THEN abs(CAST(x AS BIGINT) - CAST(y AS BIGINT))::DOUBLE ELSE -1 END AS house_gap,
CASE WHEN x <> '' AND y <> '' THEN round(ln(1 + abs(CAST(x AS BIGINT) - CAST(y AS BIGINT))::DOUBLE), 6) ELSE -1 END AS house_gap_log, CASE WHEN x <> '' AND y <> '' THEN (abs(CAST(x AS BIGINT) - CAST(y AS BIGINT)) BETWEEN 1 AND 20)::DOUBLE ELSE -1 END AS house_gap_small,
CASE WHEN x <> '' AND y <> '' THEN (length(x) = length(y))::DOUBLE ELSE -1 END AS house_same_len FROM houses2"""


def jaccard_tokens(spark: SparkSession, d: str) -> DataFrame:
    return V.name_pairs(spark, d).select("a", "b", _r(sim.jaccard(sim.distinct_tokens(F.col("a")), sim.distinct_tokens(F.col("b")))).alias("jaccard"), sim.acronym(F.col("a"), F.col("b")).alias("acronym"), sim.end_token_equal(F.col("a"), F.col("b"), 1).alias("first_equal"), sim.end_token_equal(F.col("a"), F.col("b"), -1).alias("last_equal"))


_INI = "array_to_string(list_transform(string_split({0}, ' '), lambda w: substr(w, 1, 1)), '')"


def _acr(x: str, y: str) -> str:
    i = _INI.format(x)
    return f"(length({i}) >= 2 AND ({i} = replace({y}, ' ', '') OR list_contains(string_split({y}, ' '), {i})))"


_JAC_SQL = f"""WITH {V.NAME_PAIRS} SELECT a, b, {_J.format(a=_words("a"), b=_words("b"))} AS jaccard, ({_acr("a", "b")} OR {_acr("b", "a")})::DOUBLE AS acronym,
(string_split(a, ' ')[1] = string_split(b, ' ')[1])::DOUBLE AS first_equal, (string_split(a, ' ')[-1] = string_split(b, ' ')[-1])::DOUBLE AS last_equal FROM npairs"""


def jaro_winkler(spark: SparkSession, d: str) -> DataFrame:
    return V.name_pairs(spark, d).select("a", "b", _r(sim.jaro_winkler_ratio(F.col("a"), F.col("b"))).alias("jw"), F.levenshtein("a", "b").cast("long").alias("lev"))


def indel_ratio(spark: SparkSession, d: str) -> DataFrame:
    return V.name_pairs(spark, d).select("a", "b", _r(sim.indel_ratio(F.col("a"), F.col("b"))).alias("ratio"), _r(sim.token_sort_ratio(F.col("a"), F.col("b"))).alias("sorted_ratio"))


def token_set_ratio(spark: SparkSession, d: str) -> DataFrame:
    return V.name_pairs(spark, d).select("a", "b", _r(sim.token_set_ratio(F.col("a"), F.col("b"))).alias("token_set"), _r(sim.partial_ratio(F.col("a"), F.col("b"))).alias("partial"))


def novel_words(spark: SparkSession, d: str) -> DataFrame:
    return V.name_pairs(spark, d).select("a", "b", X.novel_features(F.col("a"), F.col("a"), F.col("b"), F.col("b")).alias("n")).select("a", "b", *[F.col(f"n.{c}").cast("long").alias(c) for c in ("novel_q", "novel_s", "novel_any", "extra_q", "extra_s", "novel_q_len")])


_LEGAL_ALL = "[" + ", ".join(f"'{x}'" for x in X.LEGAL_WORDS) + "]"


def _novel_sql(a: str, b: str) -> str:
    extra = f"list_filter(string_split({a}, ' '), lambda t: NOT list_contains(string_split({b}, ' '), t))"
    fresh = f"list_filter({extra}, lambda t: length(t) >= 3 AND NOT list_contains(list_transform(string_split({b}, ' '), lambda w: jaro_winkler_similarity(t, w) >= 0.75), true) AND NOT list_contains(list_transform({_LEGAL_ALL}, lambda w: substr(t, 1, 1) = substr(w, 1, 1) AND jaro_winkler_similarity(t, w) >= 0.8), true))"
    return f"({fresh})", f"({extra})"


_NA, _EA = _novel_sql("a", "b")
_NB, _EB = _novel_sql("b", "a")
_NOVEL_SQL = f"""WITH {V.NAME_PAIRS} SELECT a, b, len({_NA}) AS novel_q, len({_NB}) AS novel_s, CAST(len({_NA}) + len({_NB}) > 0 AS BIGINT) AS novel_any, len({_EA}) AS extra_q, len({_EB}) AS extra_s, coalesce(list_max(list_transform({_NA}, lambda t: length(t))), 0) AS novel_q_len FROM npairs"""


def idf_overlap(spark: SparkSession, d: str) -> DataFrame:
    rec = V.crowd_records(spark, d)
    stats = X.country_idf(rec, "name_core").withColumn("idf", F.round("idf", 6))
    out = X.idf_overlap(V.crowd_pairs(spark, d), rec, "name_core", stats)
    return out.select("q", "s", _r("overlap", 4).alias("overlap"), _r("max_shared", 4).alias("max_shared"), _r("one_sided", 4).alias("one_sided"))


_IDF_SQL = f"""WITH {V.CROWD}, n AS (SELECT country, count(*) AS n FROM crec GROUP BY 1), tk AS (SELECT DISTINCT rid, country, unnest(string_split(name_core, ' ')) AS token FROM crec),
st AS (SELECT country, token, round(ln(any_value(n.n)::DOUBLE / count(*)), 6) AS idf FROM tk JOIN n USING (country) GROUP BY 1, 2),
pr AS (SELECT p.q, p.s, x.country, {_words("x.name_core")} AS a, {_words("y.name_core")} AS b FROM cpairs p JOIN crec x ON x.rid = p.q JOIN crec y ON y.rid = p.s),
fl AS (SELECT q, s, country, a, b, unnest(list_distinct(list_concat(a, b))) AS token FROM pr),
w AS (SELECT fl.*, coalesce(st.idf, ln(n.n::DOUBLE)) AS w, list_contains(a, fl.token) AS ia, list_contains(b, fl.token) AS ib FROM fl LEFT JOIN st ON st.country = fl.country AND st.token = fl.token JOIN n ON n.country = fl.country),
g AS (SELECT q, s, sum(w) AS every, coalesce(sum(CASE WHEN ia AND ib THEN w END), 0) AS sh, coalesce(max(CASE WHEN ia AND ib THEN w END), 0) AS mx, greatest(coalesce(sum(CASE WHEN ia AND NOT ib THEN w END), 0), coalesce(sum(CASE WHEN ib AND NOT ia THEN w END), 0)) AS one FROM w GROUP BY 1, 2)
SELECT q, s, round(CASE WHEN every = 0 THEN 0 ELSE sh / every END, 4) AS overlap, round(mx, 4) AS max_shared, round(one, 4) AS one_sided FROM g"""


def rewrite_select(spark: SparkSession, d: str) -> DataFrame:
    """Words that stand for each other in names that differ in one word."""
    pairs = V.crowd_pairs(spark, d).join(V.crowd_records(spark, d).select(F.col("rid").alias("q"), F.split("name_core", " ").alias("a"), "country"), "q").join(V.crowd_records(spark, d).select(F.col("rid").alias("s"), F.split("name_core", " ").alias("b")), "s")
    seen = learn.single_difference(pairs, "a", "b", ["country"])
    return learn.select(seen, ["country"], 2, 0.05, F.lit(True))


_REWRITE_SQL = f"""WITH {V.CROWD}, pr AS (SELECT x.country, list_distinct(string_split(x.name_core, ' ')) AS a, list_distinct(string_split(y.name_core, ' ')) AS b FROM cpairs p JOIN crec x ON x.rid = p.q JOIN crec y ON y.rid = p.s),
df AS (SELECT country, list_filter(a, lambda t: NOT list_contains(b, t)) AS l, list_filter(b, lambda t: NOT list_contains(a, t)) AS r FROM pr),
c AS (SELECT country, r[1] AS form, l[1] AS target, count(*) AS n FROM df WHERE len(l) = 1 AND len(r) = 1 GROUP BY 1, 2, 3),
k AS (SELECT *, CAST(sum(n) OVER (PARTITION BY country, form) AS BIGINT) AS total, row_number() OVER (PARTITION BY country, form ORDER BY n DESC, target) AS pos FROM c)
SELECT country, form, target, n, total FROM k WHERE pos = 1 AND n >= 2 AND n::DOUBLE / total >= 0.05::DOUBLE"""


def embedding_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Each vector against its label's mean direction."""
    e = V.read(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    e = e.withColumn("u", F.when(norm > 0, F.transform("v", lambda x: x / norm)).otherwise(F.col("v")))
    mean = e.select("label", F.posexplode("u").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda z: z["x"]).alias("m"))
    return e.join(mean, "label").select("vec_id", "label", _r(sim.dot(F.col("u"), F.col("m")), 5).alias("cosine"))


_EMB_SQL = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT vec_id, label, CASE WHEN list_dot_product(v, v) > 0 THEN list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) ELSE v END AS u FROM e),
x AS (SELECT label, unnest(range(1, len(u) + 1)) AS i, unnest(u) AS x FROM u), m0 AS (SELECT label, i, avg(x) AS x FROM x GROUP BY 1, 2), m AS (SELECT label, list(x ORDER BY i) AS m FROM m0 GROUP BY 1)
SELECT vec_id, u.label, round(list_dot_product(u, m), 5) AS cosine FROM u JOIN m ON u.label = m.label"""


# ---- decoding and metrics ----


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return C.one_owner(V.pairs(spark, d))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return M.entity_counts(V.entities(spark, d), V.pairs(spark, d).withColumn("pred", F.col("p") >= CUT))


_COUNTS = f"""cnt AS (SELECT e.s, e.country, e.t, coalesce(sum(CASE WHEN p >= {CUT}::DOUBLE THEN 1 ELSE 0 END), 0) AS k, coalesce(sum(CASE WHEN p >= {CUT}::DOUBLE AND label THEN 1 ELSE 0 END), 0) AS tp, coalesce(sum(CASE WHEN label THEN 1 ELSE 0 END), 0) AS r
  FROM ents e LEFT JOIN pairs p ON p.s = e.s GROUP BY 1, 2, 3)"""


def _f(t: str, k: str, tp: str) -> str:
    return f"CASE WHEN {t} = 0 THEN CASE WHEN {k} = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END WHEN {k} = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * {tp} / (0.25::DOUBLE * {t} + {k}) END"


def f05_per_entity(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d).select("s", "t", "k", "tp", _r(M.f05(F.col("t"), F.col("k"), F.col("tp"))).alias("f"))


def evaluate_rollup(spark: SparkSession, d: str) -> DataFrame:
    out = M.report(_counts(spark, d))
    return out.select("country", "n", *[_r(c).alias(c) for c in out.columns if c not in ("country", "n")])


_EVAL_SQL = f"""WITH {V.PAIRS}, {_COUNTS}, f AS (SELECT *, {_f("t", "k", "tp")} AS f FROM cnt)
SELECT coalesce(country, 'ALL') AS country, count(*) AS n, round(avg(f), 6) AS macro_f05, round(avg(CASE WHEN t = 0 THEN (k = 0)::DOUBLE END), 6) AS singleton_acc, round(avg(CASE WHEN t = 0 THEN (k > 0)::DOUBLE END), 6) AS singleton_false_merge,
round(sum(tp)::DOUBLE / greatest(sum(k), 1)::DOUBLE, 6) AS pair_precision, round(sum(tp)::DOUBLE / greatest(sum(t), 1)::DOUBLE, 6) AS pair_recall, round(avg((k > 0)::DOUBLE), 6) AS pred_match_rate, round(avg((t > 0)::DOUBLE), 6) AS true_match_rate FROM f GROUP BY ROLLUP (country)"""


def error_decomposition(spark: SparkSession, d: str) -> DataFrame:
    out = M.decomposition(_counts(spark, d))
    return out.select("country", *[_r(c).alias(c) for c in out.columns if c != "country"])


_DEC_SQL = f"""WITH {V.PAIRS}, {_COUNTS}, f AS (SELECT country, t, {_f("t", "k", "tp")} AS a, {_f("t", "r", "r")} AS o, {_f("t", "tp", "tp")} AS c FROM cnt)
SELECT coalesce(country, 'ALL') AS country, round(avg(a), 6) AS actual, round(avg(o), 6) AS oracle, round(avg(1 - o), 6) AS blocking_loss, round(avg(CASE WHEN t = 0 THEN o - a ELSE 0 END), 6) AS singleton_false_merge,
round(avg(CASE WHEN t > 0 THEN c - a ELSE 0 END), 6) AS fp_on_matched, round(avg(CASE WHEN t > 0 THEN o - c ELSE 0 END), 6) AS missed_retrieved FROM f GROUP BY ROLLUP (country)"""


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    return V.pairs(spark, d).withColumn("rank", C.first_in("s", F.col("p").desc(), F.col("q")) - 1)


def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return M.recall_at(V.entities(spark, d), _ranked(spark, d), (1, 3, 5)).select(F.col("k").cast("long").alias("k"), "country", _r("pair_recall").alias("pair_recall"), _r("entity_all_recall").alias("entity_all_recall"))


_RECALL_SQL = f"""WITH {V.PAIRS}, rk AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p DESC, q) - 1 AS rank FROM pairs), ks AS (SELECT unnest([1, 3, 5]::BIGINT[]) AS k),
g AS (SELECT k, e.s, e.country, e.t, coalesce(sum(CASE WHEN label AND rank < k THEN 1 ELSE 0 END), 0) AS got FROM ents e CROSS JOIN ks LEFT JOIN rk ON rk.s = e.s GROUP BY 1, 2, 3, 4)
SELECT k, coalesce(country, 'ALL') AS country, round(sum(got)::DOUBLE / greatest(sum(t), 1)::DOUBLE, 6) AS pair_recall, round(avg(CASE WHEN t > 0 THEN (got = t)::DOUBLE END), 6) AS entity_all_recall FROM g GROUP BY GROUPING SETS ((k, country), (k))"""


def candidate_stats(spark: SparkSession, d: str) -> DataFrame:
    return M.candidate_stats(V.entities(spark, d), V.pairs(spark, d)).select(_r("avg").alias("avg_n"), _r("p95").alias("p95"), F.col("max").alias("max_n"))


def conflict_rate(spark: SparkSession, d: str) -> DataFrame:
    pool = V.read(spark, d, "part").select(F.col("p_partkey").alias("q"), F.col("p_brand").alias("country"))
    out = M.assignment_checks(_keyed(spark, d).withColumn("pred", F.col("keep") & (F.col("p") >= CUT)), pool)
    return out.select("country", "n_claimed", _r("conflict_rate").alias("conflict_rate"), _r("assignment_rate").alias("assignment_rate"))


_CONFLICT_SQL = f"""WITH {V.PAIRS}, o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY p DESC, s) = 1 AS keep FROM pairs), r AS (SELECT q, sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) AS n, bool_or(keep AND p >= {CUT}::DOUBLE) AS a FROM o GROUP BY 1)
SELECT p_brand AS country, CAST(sum(CASE WHEN coalesce(n, 0) >= 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_claimed, round(avg(CASE WHEN n >= 1 THEN (n >= 2)::DOUBLE END), 6) AS conflict_rate, round(avg(coalesce(a, false)::DOUBLE), 6) AS assignment_rate FROM part LEFT JOIN r ON r.q = p_partkey GROUP BY 1"""


def country_cutoff_quantile(spark: SparkSession, d: str) -> DataFrame:
    rows = V.pairs(spark, d).join(V.entities(spark, d).select("s", "country"), "s")
    return D.apply_cutoffs(rows, D.cutoffs(rows, 0.05)).groupBy("country").agg(F.sum(F.col("keep").cast("long")).alias("kept"), F.count(F.lit(1)).alias("n"))


_CUT_SQL = f"""WITH {V.PAIRS}, r AS (SELECT p.*, e.country FROM pairs p JOIN ents e ON e.s = p.s), c AS (SELECT country, quantile_cont(p, 0.05) AS cut FROM r WHERE label GROUP BY 1)
SELECT r.country, CAST(sum((p >= coalesce(cut, (SELECT min(cut) FROM c)))::BIGINT) AS BIGINT) AS kept, count(*) AS n FROM r LEFT JOIN c ON c.country = r.country GROUP BY 1"""


def threshold_grid(spark: SparkSession, d: str) -> DataFrame:
    return D.threshold_curve(_keyed(spark, d), V.entities(spark, d)).select("threshold", _r("f").alias("f"))


_GRID_SQL = f"""WITH {V.PAIRS}, o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY p DESC, s) = 1 AS keep FROM pairs), g AS (SELECT unnest([{", ".join(map(str, D.THRESHOLDS))}]::DOUBLE[]) AS threshold),
c AS (SELECT threshold, e.s, e.t, sum(CASE WHEN keep AND p >= threshold THEN 1 ELSE 0 END) AS k, sum(CASE WHEN keep AND label AND p >= threshold THEN 1 ELSE 0 END) AS tp FROM ents e CROSS JOIN g LEFT JOIN o ON o.s = e.s GROUP BY 1, 2, 3)
SELECT threshold, round(avg({_f("t", "k", "tp")}), 6) AS f FROM c GROUP BY 1"""


def expected_f_decode(spark: SparkSession, d: str) -> DataFrame:
    return D.expected_f(_keyed(spark, d), 1.0, 0.1).select("s", "q", "pred")


_EXPECTED = """run AS (SELECT s, q, p, keep, label, row_number() OVER w AS k, sum(p) OVER (PARTITION BY s ORDER BY p DESC, q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sk, sum(p) OVER (PARTITION BY s) AS total, exp(sum(ln(1 - least(p, 1 - 1e-9::DOUBLE))) OVER (PARTITION BY s)) AS none FROM o WHERE keep AND p > 0 WINDOW w AS (PARTITION BY s ORDER BY p DESC, q)),
sc AS (SELECT *, 1.25::DOUBLE * sk / (0.25::DOUBLE * (total + {m}::DOUBLE) + k) AS f FROM run), bs AS (SELECT *, max(f) OVER (PARTITION BY s) AS best FROM sc), bk AS (SELECT *, min(CASE WHEN f >= best THEN k END) OVER (PARTITION BY s) AS best_k FROM bs)"""
_OWN = "o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY p DESC, s) = 1 AS keep FROM pairs)"
_EXP_SQL = f"""WITH {V.PAIRS}, {_OWN}, {_EXPECTED.format(m=0.1)} SELECT o.s, o.q, coalesce(best > none AND k <= best_k, false) AS pred FROM o LEFT JOIN bk ON bk.s = o.s AND bk.q = o.q"""


def alpha_grid(spark: SparkSession, d: str) -> DataFrame:
    return D.alpha_curve(_keyed(spark, d), V.entities(spark, d), 0.1).select(F.col("threshold").alias("alpha"), _r("f").alias("f"))


_ALPHA_SQL = f"""WITH {V.PAIRS}, {_OWN}, {_EXPECTED.format(m=0.1)}, g AS (SELECT unnest([{", ".join(map(str, D.ALPHAS))}]::DOUBLE[]) AS alpha),
c AS (SELECT alpha, e.s, e.t, coalesce(sum(CASE WHEN best > alpha * none AND k <= best_k THEN 1 ELSE 0 END), 0) AS kk, coalesce(sum(CASE WHEN best > alpha * none AND k <= best_k AND label THEN 1 ELSE 0 END), 0) AS tp FROM ents e CROSS JOIN g LEFT JOIN bk ON bk.s = e.s GROUP BY 1, 2, 3)
SELECT alpha, round(avg({_f("t", "kk", "tp")}), 6) AS f FROM c GROUP BY 1"""


def logit_shift(spark: SparkSession, d: str) -> DataFrame:
    return V.pairs(spark, d).select("s", "q", _r(D.logit(F.col("p")), 5).alias("z"), _r(D.shifted(F.col("p"), F.lit(-0.5)), 5).alias("shifted"), D.in_band(F.col("p"), 0.1, 0.9).alias("band"))


def train_priors(spark: SparkSession, d: str) -> DataFrame:
    rows = V.pairs(spark, d).join(V.entities(spark, d).select("s", "country"), "s").withColumn("rel", F.when(F.col("p") >= 0.5, "near").otherwise("far"))
    return D.train_priors(rows).select("country", "rel", _r("rate").alias("rate"))


def em_prior(spark: SparkSession, d: str) -> DataFrame:
    rows = V.pairs(spark, d).join(V.entities(spark, d).select("s", "country"), "s").withColumn("rel", F.when(F.col("p") >= 0.5, "near").otherwise("far"))
    out = D.em_shifts(rows, D.train_priors(rows), 50)
    return out.select("country", "rel", "pairs", _r("train_rate").alias("train_rate"), _r("em_rate", 3).alias("em_rate"), _r("shift", 2).alias("shift"))


def match_count_crosstab(spark: SparkSession, d: str) -> DataFrame:
    e = V.entities(spark, d).withColumn("country", F.regexp_replace(F.lower(F.substring("country", 3, 20)), " ", "_"))
    names = ["urgent", "high", "medium", "not_specified", "low"]
    bin_ = F.when(F.col("t") == 0, "0").when(F.col("t") == 1, "1").when(F.col("t") < 4, "2-3").otherwise("4+")
    return e.groupBy(bin_.alias("bin")).pivot("country", names).agg(F.count(F.lit(1))).na.fill(0)


_PIVOT_SQL = f"""WITH {V.PAIRS}, b AS (SELECT CASE WHEN t = 0 THEN '0' WHEN t = 1 THEN '1' WHEN t < 4 THEN '2-3' ELSE '4+' END AS bin, replace(lower(substr(country, 3)), ' ', '_') AS c FROM ents)
SELECT bin, {", ".join(f"count(*) FILTER (c = '{x}') AS {x}" for x in ("urgent", "high", "medium", "not_specified", "low"))} FROM b GROUP BY 1"""


def prob_histogram(spark: SparkSession, d: str) -> DataFrame:
    return V.pairs(spark, d).groupBy(F.floor(F.col("p") * 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("hits"))


def missed_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = _ranked(spark, d)
    return p.where("label").select("s", "q").join(p.where("rank < 2").select("s", "q"), ["s", "q"], "left_anti")


# ---- answer lists ----


def _lists(spark: SparkSession, d: str, cut: float) -> DataFrame:
    return S.id_lists(V.entities(spark, d), V.pairs(spark, d).where(F.col("p") >= cut).select("s", F.col("q").cast("string").alias("q")))


def _lists_sql(name: str, cut: float) -> str:
    return f"{name} AS (SELECT e.s, coalesce(array_to_string(list_sort(list(CAST(q AS VARCHAR)) FILTER (q IS NOT NULL)), ','), '') AS ids FROM ents e LEFT JOIN (SELECT * FROM pairs WHERE p >= {cut}::DOUBLE) p ON p.s = e.s GROUP BY 1)"


def id_list_output(spark: SparkSession, d: str) -> DataFrame:
    return _lists(spark, d, CUT)


def _countries(spark: SparkSession, d: str) -> DataFrame:
    return V.entities(spark, d).select("s", "country")


CHOSEN = ["1-URGENT", "5-LOW"]
_IN = "country IN ('1-URGENT', '5-LOW')"


def splice(spark: SparkSession, d: str) -> DataFrame:
    return S.splice(_lists(spark, d, 0.6), _lists(spark, d, 0.8), _countries(spark, d), CHOSEN)


def intersect(spark: SparkSession, d: str) -> DataFrame:
    return S.intersect(_lists(spark, d, 0.3), _lists(spark, d, 0.7), _countries(spark, d), CHOSEN)


def vote(spark: SparkSession, d: str) -> DataFrame:
    return S.vote([_lists(spark, d, c) for c in (0.3, 0.6, 0.8)], 2, _lists(spark, d, 0.3), _countries(spark, d), CHOSEN)


_VOTE_SQL = f"""WITH {V.PAIRS}, {_lists_sql("a", 0.3)}, {_lists_sql("b", 0.6)}, {_lists_sql("c", 0.8)}, fl AS (SELECT s, unnest(string_split(ids, ',')) AS q FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)),
v AS (SELECT s, array_to_string(list_sort(list(q)), ',') AS won FROM (SELECT s, q FROM fl WHERE q <> '' GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY 1)
SELECT a.s, CASE WHEN {_IN} THEN coalesce(won, '') ELSE a.ids END AS ids FROM a JOIN ents e ON e.s = a.s LEFT JOIN v ON v.s = a.s"""


def owner_map(spark: SparkSession, d: str) -> DataFrame:
    truth = V.pairs(spark, d).where("label").groupBy("s").agg(F.collect_list("q").alias("ids"))
    return S.owners(truth, V.read(spark, d, "part").select(F.col("p_partkey").alias("q")))


def validator_rules(spark: SparkSession, d: str) -> DataFrame:
    records = V.read(spark, d, "part").select(F.col("p_partkey").alias("q"))
    entities = V.entities(spark, d)
    return S.violations(entities, _lists(spark, d, 0.8), _lists(spark, d, 0.3), records)


_RULES_SQL = f"""WITH {V.PAIRS}, m AS (SELECT DISTINCT q FROM pairs WHERE p >= 0.8::DOUBLE) SELECT * FROM (VALUES ('entity_without_row', 0::BIGINT), ('unknown_entity', 0), ('repeated_row', 0), ('repeated_id', 0), ('match_not_candidate', 0), ('unknown_id', 0)) t(rule, n)
UNION ALL SELECT 'entity_as_match', (SELECT count(*) FROM pairs WHERE p >= 0.8::DOUBLE AND q IN (SELECT s FROM ents))"""


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    return R.stratified_split(V.entities(spark, d).select("s", "country"), (("train", 0.7), ("tune", 0.15), ("val", 0.15)))


_SPLIT_SQL = f"""WITH {V.PAIRS}, r AS (SELECT s, country, row_number() OVER (PARTITION BY country ORDER BY md5(CAST(s AS VARCHAR)), s)::DOUBLE / count(*) OVER (PARTITION BY country) AS a FROM ents)
SELECT s, country, CASE WHEN a <= 0.7::DOUBLE + 1e-12::DOUBLE THEN 'train' WHEN a <= 0.7::DOUBLE + 0.15::DOUBLE + 1e-12::DOUBLE THEN 'tune' ELSE 'val' END AS fold FROM r"""


def snap_to_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Order totals to the nearest customer balance."""
    values = V.read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 50).alias("v"))
    known = V.read(spark, d, "customer").select(F.col("c_acctbal").alias("v"))
    return R.snap(values, known).select("id", _r("snapped", 2).alias("snapped"))


_SNAP_SQL = """WITH k AS (SELECT DISTINCT c_acctbal AS v FROM customer), x AS (SELECT o_orderkey AS id, o_totalprice / 50 AS v FROM orders),
a AS (SELECT x.id, x.v, k.v AS lo FROM x ASOF LEFT JOIN k ON x.v >= k.v), b AS (SELECT x.id, k.v AS hi FROM x ASOF LEFT JOIN k ON x.v <= k.v)
SELECT a.id, round(CASE WHEN lo IS NULL THEN hi WHEN hi IS NULL THEN lo WHEN v - lo <= hi - v THEN lo ELSE hi END, 2) AS snapped FROM a JOIN b ON a.id = b.id"""


def smape_mape(spark: SparkSession, d: str) -> DataFrame:
    rows = V.read(spark, d, "orders").join(V.read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = M.regression_scores(rows, "o_totalprice", "c_acctbal")
    return out.select(_r("smape", 4).alias("smape"), _r("mape_score", 4).alias("mape_score"))


_SMAPE_SQL = """SELECT round(avg(abs(o_totalprice - c_acctbal) / ((abs(o_totalprice) + abs(c_acctbal)) / 2 + 1e-8::DOUBLE)) * 100, 4) AS smape, round(greatest(0.0::DOUBLE, 100 * (1 - avg(abs((o_totalprice - c_acctbal) / (o_totalprice + 1e-8::DOUBLE))))), 4) AS mape_score FROM orders JOIN customer ON o_custkey = c_custkey"""


def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return null_profile(V.read(spark, d, "documents"))


def event_props(spark: SparkSession, d: str) -> DataFrame:
    return V.read(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("event_type").agg(F.sum("k").alias("total"), F.countDistinct("k").alias("kinds"))


def ledger_union(spark: SparkSession, d: str) -> DataFrame:
    a = V.read(spark, d, "region").select(F.col("r_regionkey").alias("id"), "r_name")
    b = V.read(spark, d, "nation").select(F.col("n_nationkey").alias("id"), "n_name")
    return append_ledger(a, b)


def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    per = _counts(spark, d)
    delta = per.select("s", (M.f05(F.col("t"), F.col("k"), F.col("tp")) - M.f05(F.col("t"), F.col("r"), F.col("r"))).alias("delta"))
    out = R.paired_bootstrap(delta, 1000)
    return out.select(*[_r(c).alias(c) for c in ("delta", "ci_low", "ci_high")], "significant")


def _training(spark: SparkSession, d: str) -> DataFrame:
    p = V.pairs(spark, d)
    rows = p.withColumn("margin", C.margin("q", "p")).withColumn("s_rank", C.first_in("s", F.col("p").desc(), F.col("q"))).withColumn("train", fold_of(F.col("s")) == "train")
    return learner.assembled(rows, ["p", "margin", "s_rank"]).withColumnRenamed("p", "p0")


def gbt_crossfit(spark: SparkSession, d: str) -> DataFrame:
    rows = _training(spark, d)
    out = learner.cross_fit(rows, 2, lambda r, g: learner.fit_gbt(r, 42 + g))
    return out.select("s", "q", "label", "p", "train")


def isotonic_calibration(spark: SparkSession, d: str) -> DataFrame:
    p = V.pairs(spark, d)
    return learner.calibrate(p.where(fold_of(F.col("s")) == "tune"), p).select("s", "q", "p", "p_cal")


def pseudo_labels(spark: SparkSession, d: str) -> DataFrame:
    return learner.pseudo_labels(V.pairs(spark, d), 0.9, 0.05).select("s", "q", "label")


def synthetic_lookalikes(spark: SparkSession, d: str) -> DataFrame:
    rec = V.addresses(spark, d).select("rid", "name", F.col("rid").cast("string").alias("house_num"), F.col("rid").alias("owner"))
    return R.lookalikes(rec)


# ---- checked joins and first rows ----


def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """One part per name and type: the cheapest, then the lowest number."""
    part = V.read(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return L.first_rows(part, ["p_name", "p_type"], [F.col("p_retailprice"), F.col("p_partkey")])


def validated_join(spark: SparkSession, d: str) -> DataFrame:
    return L.one_to_one(V.entities(spark, d).select("s", "t"), V.read(spark, d, "orders").select(F.col("o_orderkey").alias("s"), "o_orderstatus"), ["s"])


def stacked_scores(spark: SparkSession, d: str) -> DataFrame:
    p = V.pairs(spark, d)
    return L.stacked({"high": p.where("p >= 0.3"), "labelled": p.where("label"), "every": p}, ["s", "q"], "p")


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    """Each country's five records of most words."""
    rec = V.records(spark, d).select("rid", "country", F.size("tokens").cast("long").alias("n"))
    return L.head_of_groups(rec, ["country"], [F.col("n").desc(), F.col("rid")], 5).select("country", "rid", "n", F.col("place").cast("long").alias("place"))


# ---- diagnostics and the whole way ----


def error_mining(spark: SparkSession, d: str) -> DataFrame:
    pairs = V.pairs(spark, d).withColumn("pred", F.col("p") >= CUT)
    costs = G.error_costs(_counts(spark, d), pairs)
    return costs.groupBy("kind", F.col("p_bin").cast("long").alias("p_bin")).agg(F.count(F.lit(1)).alias("n"), _r(F.sum("gain"), 3).alias("gain"))


def _fixed(t: str, k: str, tp: str) -> str:
    return _f(t, f"({k})", f"({tp})")


_MINING_SQL = f"""WITH {V.PAIRS}, {_COUNTS}, w AS (SELECT p.*, c.t, c.k, c.tp, p.p >= {CUT}::DOUBLE AS pred FROM pairs p JOIN cnt c ON c.s = p.s WHERE (p.p >= {CUT}::DOUBLE) <> p.label),
g AS (SELECT CASE WHEN pred THEN 'wrong_accept' ELSE 'missed' END AS kind, len(list_filter([{", ".join(f"{x}::DOUBLE" for x in G.P_BINS)}], lambda e: p >= e)) AS p_bin, CASE WHEN pred THEN {_fixed("t", "k - 1", "tp")} ELSE {_fixed("t", "k + 1", "tp + 1")} END - {_f("t", "k", "tp")} AS gain FROM w)
SELECT kind, p_bin, count(*) AS n, round(sum(gain), 3) AS gain FROM g GROUP BY 1, 2"""


def recall_gap(spark: SparkSession, d: str) -> DataFrame:
    """Lines as true pairs, those of high score as found; words of the parts' names, the commonest purged."""
    rec = V.crowd_records(spark, d).select("rid", F.split("name_core", " ").alias("tokens"))
    words = rec.select("rid", F.explode("tokens").alias("token"))
    n = rec.agg(F.count(F.lit(1)).alias("n"))
    kept = words.groupBy("token").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).where(F.col("df") <= 0.12 * F.col("n"))  # n is one row
    truth = V.crowd_pairs(spark, d).select("s", "q")
    found = V.crowd_pairs(spark, d).where("p >= 0.5").select("s", "q")
    left, right = words.select(F.col("rid").alias("s"), "token"), words.select(F.col("rid").alias("q"), "token")
    return G.recall_gap(truth, left, right, kept, found)


_GAPS_SQL = f"""WITH {V.CROWD}, wd AS (SELECT rid, unnest(string_split(name_core, ' ')) AS token FROM crec), kept AS (SELECT token FROM wd GROUP BY 1 HAVING count(*) <= 0.12::DOUBLE * (SELECT count(*) FROM crec)),
ms AS (SELECT s, q FROM cpairs WHERE p < 0.5), m AS (SELECT ms.s, ms.q, count(*) AS n, sum(CASE WHEN a.token IN (SELECT token FROM kept) THEN 1 ELSE 0 END) AS live FROM ms JOIN wd a ON a.rid = ms.s JOIN wd b ON b.rid = ms.q AND a.token = b.token GROUP BY 1, 2)
SELECT ms.s, ms.q, CASE WHEN coalesce(live, 0) > 0 THEN 'ranked_out' WHEN coalesce(n, 0) > 0 THEN 'purged' ELSE 'zero_overlap' END AS cause FROM ms LEFT JOIN m ON m.s = ms.s AND m.q = ms.q"""


def data_profile(spark: SparkSession, d: str) -> DataFrame:
    return G.data_profile(V.entities(spark, d)).select("country", "n", _r("singleton_share").alias("singleton_share"), _r("mean_t").alias("mean_t"), "max_t")


def script_shares(spark: SparkSession, d: str) -> DataFrame:
    return G.script_shares(V.read(spark, d, "documents"), "text", "lang").select("lang", *[_r(c).alias(c) for c in ("indic", "other_script", "non_ascii")])


def shift_ratio(spark: SparkSession, d: str) -> DataFrame:
    p = V.pairs(spark, d).withColumn("rel", F.floor(F.col("p") * 5).cast("string"))
    return G.shift_ratio(p.where("label"), p.where("NOT label"), "rel").select("rel", *[_r(c).alias(c) for c in ("per_a", "per_b", "ratio")])


_SHIFT_SQL = f"""WITH {V.PAIRS}, r AS (SELECT *, CAST(CAST(floor(p * 5) AS BIGINT) AS VARCHAR) AS rel FROM pairs), a AS (SELECT rel, count(*)::DOUBLE / (SELECT count(DISTINCT s) FROM r WHERE label) AS x FROM r WHERE label GROUP BY 1), b AS (SELECT rel, count(*)::DOUBLE / (SELECT count(DISTINCT s) FROM r WHERE NOT label) AS x FROM r WHERE NOT label GROUP BY 1)
SELECT coalesce(a.rel, b.rel) AS rel, round(coalesce(a.x, 0), 6) AS per_a, round(coalesce(b.x, 0), 6) AS per_b, round(CASE WHEN a.x > 0 THEN coalesce(b.x, 0) / a.x END, 6) AS ratio FROM a FULL JOIN b ON a.rel = b.rel"""


def uncertain_band(spark: SparkSession, d: str) -> DataFrame:
    return G.band_rows(V.pairs(spark, d), 0.2, 0.8).select("s", "q", "in_band")


def blend_weights(spark: SparkSession, d: str) -> DataFrame:
    rows = V.read(spark, d, "orders").join(V.read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select((F.col("o_totalprice") / 1000).alias("y"), (F.col("c_acctbal") / 10).alias("a"), F.lit(250.0).alias("b"), (F.col("o_totalprice") / 900).alias("c"))
    return G.blend_weights(rows, ["a", "b", "c"], "y")


def full_match(spark: SparkSession, d: str) -> DataFrame:
    """Lines as pairs of parts: those of one name and type belong together."""
    rec = V.crowd_records(spark, d)
    side = lambda x: rec.select(F.col("rid").alias(x), F.col("name_core").alias(f"{x}_n"), F.col("street").alias(f"{x}_t")).hint("merge")
    pairs = V.crowd_pairs(spark, d).join(side("q"), "q").join(side("s"), "s")
    pairs = pairs.select("q", "s", "p", (F.col("q_n") == F.col("s_n")).alias("label"), _jac(F.col("q_n"), F.col("s_n")).alias("name_jac"), (F.col("q_t") == F.col("s_t")).cast("double").alias("same_type"))
    true = pairs.where("label").groupBy("s").agg(F.count(F.lit(1)).alias("t"))
    entities = pairs.select("s").distinct().join(true.hint("merge"), "s", "left").na.fill(0, ["t"]).join(rec.select(F.col("rid").alias("s"), F.col("street").alias("country")).hint("merge"), "s")
    return matching.match(pairs, _sim_rec(spark, d), entities, ["name_jac", "same_type"], _jac, matching.Plan()).lists


QUERIES = {
    f.__name__: f
    for f in (
        one_owner, cap_per_entity, mutual_best, second_best_margin, crowd_features, sibling_support, cross_source_best, house_relation, house_gap, jaccard_tokens, jaro_winkler, indel_ratio, token_set_ratio, novel_words, idf_overlap, rewrite_select, embedding_cosine, f05_per_entity,
        evaluate_rollup, error_decomposition, recall_at_k, candidate_stats, conflict_rate, country_cutoff_quantile, threshold_grid, expected_f_decode, alpha_grid, logit_shift, train_priors, em_prior, match_count_crosstab, prob_histogram, missed_pairs, id_list_output, splice, intersect, vote,
        owner_map, validator_rules, stratified_split, snap_to_nearest, smape_mape, column_profile, event_props, ledger_union, bootstrap_ci, gbt_crossfit, isotonic_calibration, pseudo_labels, synthetic_lookalikes,
        first_rows, validated_join, stacked_scores, review_sample, error_mining, recall_gap, data_profile, script_shares, shift_ratio, uncertain_band, blend_weights, full_match,
    )
}

_P = f"WITH {V.PAIRS}"


def lcs_sql(a: str, b: str) -> str:
    """The longest common subsequence of two texts of fewer than 63 signs, a row of its table in the bits of one number."""
    full = f"((1::BIGINT << CAST(length({a}) AS INTEGER)) - 1)"
    masks = f"list_transform(string_split({b}, ''), lambda c: CAST(coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i, 1) = c THEN 1::BIGINT << CAST(i - 1 AS INTEGER) ELSE 0::BIGINT END)), 0) AS BIGINT))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE length({a}) - bit_count(list_reduce({masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full})) END"


def ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * ({lcs_sql(a, b)}) / (length({a}) + length({b})) END"


_INDEL_SQL = f"""WITH {V.NAME_PAIRS}, w AS (SELECT a, b, array_to_string(list_sort(string_split(a, ' ')), ' ') AS x, array_to_string(list_sort(string_split(b, ' ')), ' ') AS y FROM npairs)
SELECT a, b, round({ratio_sql("a", "b")}, 6) AS ratio, round({ratio_sql("x", "y")}, 6) AS sorted_ratio FROM w"""
_TOKEN_SET_SQL = f"""WITH {V.NAME_PAIRS}, w AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM npairs),
v AS (SELECT a, b, list_sort(list_intersect(x, y)) AS m, list_sort(list_filter(x, lambda t: NOT list_contains(y, t))) AS l, list_sort(list_filter(y, lambda t: NOT list_contains(x, t))) AS r FROM w),
u AS (SELECT *, array_to_string(m, ' ') AS head, array_to_string(list_concat(m, l), ' ') AS one, array_to_string(list_concat(m, r), ' ') AS two FROM v),
ts AS (SELECT a, b, CASE WHEN len(m) > 0 AND (len(l) = 0 OR len(r) = 0) THEN 1.0::DOUBLE WHEN len(m) > 0 THEN greatest({ratio_sql("one", "two")}, {ratio_sql("head", "one")}, {ratio_sql("head", "two")}) ELSE {ratio_sql("one", "two")} END AS token_set FROM u),
sl AS (SELECT a, b, CASE WHEN length(a) > length(b) THEN b ELSE a END AS short, CASE WHEN length(a) > length(b) THEN a ELSE b END AS long FROM npairs),
wn AS (SELECT a, b, short, substr(long, greatest(st, 0) + 1, CAST(st + length(short) - greatest(st, 0) AS BIGINT)) AS win FROM (SELECT *, unnest(range(1 - length(short), length(long))) AS st FROM sl)),
pt AS (SELECT a, b, max({ratio_sql("short", "win")}) AS p FROM wn GROUP BY 1, 2)
SELECT ts.a, ts.b, round(token_set, 6) AS token_set, round(p, 6) AS partial FROM ts JOIN pt ON pt.a = ts.a AND pt.b = ts.b"""
_EM_SQL = f"""{_P}, r AS (SELECT p.label, p.p, e.country, CASE WHEN p.p >= 0.5 THEN 'near' ELSE 'far' END AS rel FROM pairs p JOIN ents e ON e.s = p.s),
c AS (SELECT country, rel, count(*) AS pairs, avg(label::INTEGER::DOUBLE) AS train_rate, list(p) AS ps FROM r GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN pairs >= 50 AND train_rate > 0 AND train_rate < 1 THEN list_reduce(range(100), lambda now, i: list_avg(list_transform(ps, lambda p: now / train_rate * p / (now / train_rate * p + (1 - now) / (1 - train_rate) * (1 - p)))), train_rate) END AS em FROM (SELECT country, rel, pairs, train_rate, ps FROM c)),
z AS (SELECT *, least(greatest(em, 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) AS e1, least(greatest(train_rate, 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) AS r1 FROM m)
SELECT country, rel, pairs, round(train_rate, 6) AS train_rate, round(em, 3) AS em_rate, round(coalesce(greatest(-6.0::DOUBLE, least(6.0::DOUBLE, ln(e1 / (1 - e1)) - ln(r1 / (1 - r1)))), 0), 2) AS shift FROM z"""
_BOOT_SQL = f"""{_P}, {_COUNTS}, d AS (SELECT s, {_f("t", "k", "tp")} - {_f("t", "r", "r")} AS delta FROM cnt),
h AS (SELECT delta, b, md5('boot|' || CAST(s AS VARCHAR) || '|' || CAST(b AS VARCHAR)) AS h FROM d, (SELECT unnest(range(0, 125)) AS b)),
x AS (SELECT delta, b * 8 + i AS r, ('0x' || substr(h, CAST(1 + 4 * i AS BIGINT), 4))::BIGINT AS u FROM h, (SELECT unnest(range(0, 8)) AS i)),
w AS (SELECT r, delta, {" + ".join(f"CAST(u >= {e} AS INTEGER)" for e in R.POISSON)} AS w FROM x), m AS (SELECT r, sum(w * delta) / sum(w) AS m FROM w GROUP BY 1)
SELECT (SELECT round(avg(delta), 6) FROM d) AS delta, round(quantile_cont(m, 0.025), 6) AS ci_low, round(quantile_cont(m, 0.975), 6) AS ci_high, quantile_cont(m, 0.025) > 0 OR quantile_cont(m, 0.975) < 0 AS significant FROM m"""
_EASY = md5_sql("'easy' || s || ':' || q", 1000)
ORACLE_SQL = {
    "one_owner": f"{_P}, {_OWN} SELECT s, q, p, keep FROM o",
    "cap_per_entity": f"{_P} SELECT s, q, p, place FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p DESC, q) AS place FROM pairs) WHERE place <= 3",
    "mutual_best": f"{_P} SELECT s, q, p >= max(p) OVER (PARTITION BY q) AND p >= max(p) OVER (PARTITION BY s) AS mutual FROM pairs",
    "second_best_margin": f"""{_P}, w AS (SELECT s, q, p, max(p) OVER (PARTITION BY q) AS best, coalesce(nth_value(p, 2) OVER (PARTITION BY q ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS second FROM pairs)
SELECT s, q, second, round(CASE WHEN p >= best THEN p - second ELSE p - best END, 6) AS margin FROM w""",
    "crowd_features": _CROWD_SQL,
    "sibling_support": _SIB_SQL,
    "cross_source_best": _CROSS_SQL,
    "house_relation": _HOUSE_SQL,
    "house_gap": _GAP_SQL,
    "jaccard_tokens": _JAC_SQL,
    "jaro_winkler": f"WITH {V.NAME_PAIRS} SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS jw, levenshtein(a, b) AS lev FROM npairs",
    "novel_words": _NOVEL_SQL,
    "idf_overlap": _IDF_SQL,
    "rewrite_select": _REWRITE_SQL,
    "embedding_cosine": _EMB_SQL,
    "f05_per_entity": f"{_P}, {_COUNTS} SELECT s, t, CAST(k AS BIGINT) AS k, CAST(tp AS BIGINT) AS tp, round({_f('t', 'k', 'tp')}, 6) AS f FROM cnt",
    "evaluate_rollup": _EVAL_SQL,
    "error_decomposition": _DEC_SQL,
    "recall_at_k": _RECALL_SQL,
    "candidate_stats": f"{_P}, n AS (SELECT e.s, count(p.q) AS n FROM ents e LEFT JOIN pairs p ON p.s = e.s GROUP BY 1) SELECT round(avg(n), 6) AS avg_n, round(quantile_cont(n, 0.95), 6) AS p95, max(n) AS max_n FROM n",
    "conflict_rate": _CONFLICT_SQL,
    "country_cutoff_quantile": _CUT_SQL,
    "threshold_grid": _GRID_SQL,
    "expected_f_decode": _EXP_SQL,
    "alpha_grid": _ALPHA_SQL,
    "logit_shift": f"{_P}, z AS (SELECT *, least(greatest(p, 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) AS c FROM pairs) SELECT s, q, round(ln(c / (1 - c)), 5) AS z, round(1 / (1 + exp(-(ln(c / (1 - c)) - 0.5::DOUBLE))), 5) AS shifted, p BETWEEN 0.1::DOUBLE AND 0.9::DOUBLE AS band FROM z",
    "train_priors": f"{_P}, r AS (SELECT p.label, e.country, CASE WHEN p.p >= 0.5 THEN 'near' ELSE 'far' END AS rel FROM pairs p JOIN ents e ON e.s = p.s) SELECT coalesce(country, '*') AS country, rel, round(avg(label::INTEGER::DOUBLE), 6) AS rate FROM r GROUP BY GROUPING SETS ((country, rel), (rel))",
    "match_count_crosstab": _PIVOT_SQL,
    "prob_histogram": f"{_P} SELECT CAST(floor(p * 10) AS BIGINT) AS bin, count(*) AS n, CAST(sum(label::BIGINT) AS BIGINT) AS hits FROM pairs GROUP BY 1",
    "missed_pairs": f"{_P} SELECT s, q FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY p DESC, q) AS k FROM pairs) WHERE label AND k > 2",
    "id_list_output": f"{_P}, {_lists_sql('a', CUT)} SELECT s, ids FROM a",
    "splice": f"{_P}, {_lists_sql('a', 0.6)}, {_lists_sql('b', 0.8)} SELECT a.s, CASE WHEN {_IN} THEN b.ids ELSE a.ids END AS ids FROM a JOIN b ON a.s = b.s JOIN ents e ON e.s = a.s",
    "intersect": f"{_P}, {_lists_sql('a', 0.3)}, {_lists_sql('b', 0.7)} SELECT a.s, CASE WHEN {_IN} THEN b.ids ELSE a.ids END AS ids FROM a JOIN b ON a.s = b.s JOIN ents e ON e.s = a.s",
    "vote": _VOTE_SQL,
    "owner_map": f"{_P} SELECT p_partkey AS q, coalesce(min(s), -1) AS owner FROM part LEFT JOIN (SELECT * FROM pairs WHERE label) p ON p.q = p_partkey GROUP BY 1",
    "validator_rules": _RULES_SQL,
    "stratified_split": _SPLIT_SQL,
    "snap_to_nearest": _SNAP_SQL,
    "smape_mape": _SMAPE_SQL,
    "column_profile": "SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS \"column\", unnest([avg((doc_id IS NULL)::INTEGER::DOUBLE), avg((text IS NULL)::INTEGER::DOUBLE), avg((lang IS NULL)::INTEGER::DOUBLE), avg((source IS NULL)::INTEGER::DOUBLE), avg((n_chars IS NULL)::INTEGER::DOUBLE)]) AS null_share FROM documents",
    "event_props": "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(DISTINCT json_extract_string(props, '$.k')) AS kinds FROM events GROUP BY 1",
    "ledger_union": "SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name, '' AS n_name FROM region UNION ALL SELECT CAST(n_nationkey AS VARCHAR), '', n_name FROM nation",
    "indel_ratio": _INDEL_SQL,
    "token_set_ratio": _TOKEN_SET_SQL,
    "em_prior": _EM_SQL,
    "bootstrap_ci": _BOOT_SQL,
    "pseudo_labels": f"{_P} SELECT s, q, p >= 0.9::DOUBLE AS label FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY p DESC, s) AS k FROM pairs) WHERE (p >= 0.9::DOUBLE AND k = 1) OR p <= 0.05::DOUBLE",
    "error_mining": _MINING_SQL,
    "recall_gap": _GAPS_SQL,
    "data_profile": f"{_P} SELECT coalesce(country, 'ALL') AS country, count(*) AS n, round(avg((t = 0)::INTEGER::DOUBLE), 6) AS singleton_share, round(avg(t), 6) AS mean_t, max(t) AS max_t FROM ents GROUP BY ROLLUP (country)",
    "script_shares": r"SELECT lang, 0.0::DOUBLE AS indic, 0.0::DOUBLE AS other_script, round(avg(regexp_matches(coalesce(text, ''), '[^\x00-\x7F]')::INTEGER::DOUBLE), 6) AS non_ascii FROM documents GROUP BY 1",
    "shift_ratio": _SHIFT_SQL,
    "uncertain_band": f"{_P}, b AS (SELECT *, p BETWEEN 0.2::DOUBLE AND 0.8::DOUBLE AS in_band, {_EASY} AS place FROM pairs) SELECT s, q, in_band FROM b WHERE in_band OR place < 200",
    "first_rows": "SELECT p_partkey, p_name, p_type, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_type ORDER BY p_retailprice, p_partkey) AS k FROM part) WHERE k = 1",
    "validated_join": f"{_P} SELECT s, t, o_orderstatus FROM ents JOIN orders ON o_orderkey = s",
    "stacked_scores": f"{_P} SELECT s, q, p AS high, p AS labelled, p AS every FROM pairs WHERE p >= 0.3::DOUBLE AND label",
    "review_sample": f"WITH {V.RECORDS} SELECT country, rid, n, place FROM (SELECT country, rid, len(tokens) AS n, row_number() OVER (PARTITION BY country ORDER BY len(tokens) DESC, rid) AS place FROM rec) WHERE place <= 5",
}
