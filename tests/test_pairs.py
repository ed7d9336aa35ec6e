import numpy as np
import pytest
from pyspark.sql import functions as F

from rowkin.operators import blocking as B
from rowkin.operators import context as C
from rowkin.operators import decode as D
from rowkin.operators import features, learn, learner
from rowkin.operators import metrics as M
from rowkin.operators import resample as R
from rowkin.operators import submissions as S
from rowkin.sources import tables
from rowkin.streaming.incremental import match_arrivals


def df(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def test_f05(spark):
    rows = [(0, 0, 0, 1.0), (0, 2, 0, 0.0), (3, 0, 0, 0.0), (3, 2, 0, 0.0), (2, 2, 2, 1.0), (2, 3, 2, 0.7142857)]
    for x in df(spark, "t int, k int, tp int, f double", rows).withColumn("got", M.f05(F.col("t"), F.col("k"), F.col("tp"))).collect():
        assert x.got == pytest.approx(x.f, abs=1e-6)


def test_reports_and_the_parts_of_a_loss(spark):
    entities = df(spark, "s string, country string, t int", [("a", "US", 2), ("b", "US", 0), ("c", "India", 1)])
    pairs = df(spark, "s string, q string, label boolean, p double", [("a", "1", True, 0.9), ("a", "2", False, 0.8), ("b", "3", False, 0.1), ("b", "4", False, 0.7), ("c", "5", False, 0.2)])
    counts = M.entity_counts(entities, pairs.withColumn("pred", F.col("p") >= 0.5))
    for x in M.decomposition(counts).collect():
        assert x.blocking_loss + x.singleton_false_merge + x.fp_on_matched + x.missed_retrieved == pytest.approx(1 - x.actual)
    report = {x.country: x for x in M.report(counts).collect()}
    assert set(report) == {"ALL", "US", "India"} and report["US"].singleton_false_merge == 1 and report["ALL"].n == 3
    curve = D.threshold_curve(pairs.withColumn("keep", F.lit(True)), entities, (0.75, 0.8, 0.85, 0.9, 0.95))
    assert D.best_parameter(curve).first().threshold == 0.9 and D.best_parameter(curve, stricter=False).first().threshold == 0.85


def test_expected_f(spark):
    rows = [(1, 1, 0.95), (1, 2, 0.9), (1, 3, 0.1), (2, 4, 0.05), (2, 5, 0.02)]
    pairs = df(spark, "s long, q long, p double", rows).withColumn("keep", F.lit(True))
    got = lambda alpha: [x.pred for x in D.expected_f(pairs, alpha).orderBy("q").collect()]
    assert got(1.0) == [True, True, False, False, False] and got(1e6) == [False] * 5


def test_owners_margins_and_mutual_best(spark):
    rows = [(1, 10, 0.4), (1, 11, 0.6), (2, 12, 0.5), (2, 13, 0.3), (3, 14, 0.7), (3, 15, 0.7)]
    pairs = df(spark, "q long, s long, p double", rows)
    assert [x.keep for x in C.one_owner(pairs).orderBy("s").collect()] == [False, True, True, False, True, False]
    second = pairs.withColumn("b", C.second_best("q", "p")).orderBy("s").collect()
    assert [x.b for x in second] == [0.4, 0.4, 0.3, 0.3, 0.7, 0.7]


def test_channels_and_context(spark):
    hit = "q long, s long, score float, rank int"
    out = B.union_channels({"n": df(spark, hit, [(1, 7, 0.9, 0), (1, 8, 0.5, 1)]), "b": df(spark, hit, [(1, 8, 0.8, 0)])}).orderBy("s")
    rows = out.collect()
    assert [(x.s, x.b_rank, x.b_score) for x in rows] == [(7, 99, 0), (8, 0, pytest.approx(0.8))]
    context = {x.s: x for x in C.add_context(out, ["n", "b"]).collect()}
    assert context[8].q_best == pytest.approx(0.9) and context[8].margin == pytest.approx(-0.1) and context[7].s_first == 1


def test_cutoffs(spark):
    pairs = df(spark, "p double, country string", [(0.05, "US"), (0.05, "India"), (0.05, "France"), (0.001, "France")])
    cuts = df(spark, "country string, cut double", [("US", 0.1), ("India", 0.01)])
    assert sorted((x.country, x.p, x.keep) for x in D.apply_cutoffs(pairs, cuts).collect()) == [("France", 0.001, False), ("France", 0.05, True), ("India", 0.05, True), ("US", 0.05, False)]


def test_crowds(spark):
    rec = df(spark, "rid long, source int, country string, name_core string, addr string, street string", [(0, 1, "US", "acme", "1 a st", "a st"), (1, 1, "US", "acme", "2 a st", "a st"), (2, 1, "US", "zeta", "1 a st", "a st"), (3, 2, "US", "acme", "9 z rd", "")])
    pairs = df(spark, "q long, s long, p double", [(3, 0, 0.9), (3, 1, 0.6), (3, 2, 0.5)])
    rows = C.crowd(pairs, rec).orderBy("s").collect()
    assert [x.name_dup_country for x in rows] == [2, 2, 1] and [x.crowd_rank for x in rows] == [1, 2, 1]
    assert [round(x.crowd_margin, 6) for x in rows] == [0.3, -0.3, 1.0] and [x.addr_dup_country for x in rows] == [2, 1, 2]
    assert [x.street_dup_country for x in rows] == [3, 3, 3] and [x.q_addr_dup_country for x in rows] == [0, 0, 0] and [x.q_core_equal for x in rows] == [1, 1, 0]


def test_siblings(spark):
    from rowkin.functions.similarity import token_set_ratio

    rec = df(spark, "rid long, name_core string, addr string, house_num string, postcode string, source int", [(10, "acme tools", "5 main st", "5", "", 2), (11, "acme tool", "5 main st", "5", "", 3), (12, "zeta foods", "9 oak rd", "9", "", 2)])
    pairs = df(spark, "q long, s long, p double", [(10, 0, 0.9), (11, 0, 0.3), (12, 0, 0.2)])
    rows = {x.q: x for x in C.siblings(pairs, rec, token_set_ratio).collect()}
    assert rows[11].sib_support_name > 0.8 and rows[12].sib_support_name < 0.55 and rows[11].sib_house == pytest.approx(0.9)
    assert rows[11].sib_strong_addr == 1 and rows[10].s_p_count == 1 and all(x.q_is_argmax for x in rows.values())


def test_token_index_and_ranking(spark):
    docs = df(spark, "id string, tokens array<string>", [(f"d{i}", ["common", f"unique{i}"]) for i in range(100)])
    stats = {x.token: x for x in B.token_stats(docs, "id", "tokens", 0.5).collect()}
    assert "common" not in stats and stats["unique3"].idf == pytest.approx(np.log(101))
    index = df(spark, "token string, q string, idf double", [("acme", "A", 1.0), ("acme", "B", 1.0), ("acme", "C", 1.0), ("corp", "A", 1.0), ("corp", "B", 1.0), ("widgets", "A", 1.0)])
    queries = df(spark, "s long, token string", [(1, "acme"), (1, "corp"), (1, "widgets")])
    rank = lambda **o: [x.q for x in B.token_candidates(queries, index, **o).orderBy("rank").collect()]
    assert rank() == ["A", "B", "C"] and rank(least=2) == ["A", "B"] and rank(k=1) == ["A"]
    index = df(spark, "token string, q string, idf double", [("vision", "V", 5.0), ("no", "N", 1.0), ("city", "N", 1.0)])
    queries = df(spark, "s long, token string", [(1, "vision"), (1, "no"), (1, "city")])
    assert rank()[0] == "V" and rank(weighted=False)[0] == "N"


def test_priors_recover_a_changed_mix(spark):
    r = np.random.RandomState(0)

    def scores(n, share):
        y = r.rand(n) < share
        return np.where(y, r.beta(5, 2, n), r.beta(2, 5, n)), y

    p, y = scores(200_000, 0.4)
    edges = np.quantile(p, np.linspace(0, 1, 51)[1:-1])
    means = np.array([y[np.digitize(p, edges) == k].mean() for k in range(50)])
    for share in (0.1, 0.4):
        q, _ = scores(20_000, share)
        calibrated = means[np.digitize(q, edges)]
        assert D.em_rate(calibrated, 0.4) == pytest.approx(share, abs=0.02)
        pairs = df(spark, "country string, rel string, p double", [("US", "near", float(x)) for x in calibrated])
        row = D.em_shifts(pairs, df(spark, "country string, rel string, rate double", [("US", "near", 0.4)])).first()
        assert row.em_rate == pytest.approx(share, abs=0.02)
    assert D.em_shifts(pairs.limit(10), df(spark, "country string, rel string, rate double", [("US", "near", 0.4)])).first()["shift"] == 0


def test_cross_fitting_never_scores_what_a_model_saw(spark):
    rows = df(spark, "s long, x double, label boolean, train boolean", [(i, float(i % 7), i % 3 == 0, i % 5 != 0) for i in range(200)])
    seen = []

    def fit(part, g):
        seen.append({x.s for x in part.select("s").collect()})
        return learner.fit_gbt(part, rounds=1, depth=1)

    out = learner.cross_fit(learner.assembled(rows, ["x"]), 3, fit).select("s", "train", "xgroup", "p").collect()
    assert len(seen) == 3 and all(0 <= x.p <= 1 for x in out)
    assert all(x.s not in seen[x.xgroup] for x in out) and all(not x.train for x in out if all(x.s not in g for g in seen))


def test_learners(spark):
    rows = df(spark, "s long, q long, p double, label boolean", [(i, i, (i % 100) / 100, (i % 100) > 50) for i in range(400)])
    calibrated = {x.p: x.p_cal for x in learner.calibrate(rows, rows).collect()}
    assert calibrated[0.1] == 0 and calibrated[0.9] == 1
    assert learner.training_rows(rows, 5).where("label").count() == rows.where("label").count() and learner.training_rows(rows, 50).where("NOT label").count() in range(20, 90)
    assert {(x.p >= 0.98, x.label) for x in learner.pseudo_labels(rows).collect()} == {(True, True), (False, False)}
    assert "p_blend" in learner.blend(rows, rows.withColumn("p2", F.col("p")), ["p"]).columns
    assert learner.stack(rows.withColumn("y", F.col("p") * 2), rows, ["p"], "y", l2=0.0).where("abs(stacked - 2 * p) > 0.01").count() == 0


def test_rewrites(spark):
    pairs = df(spark, "country string, a array<string>, b array<string>", [("US", ["north", "road"], ["nrth", "road"])] * 6 + [("US", ["south", "road"], ["nrth", "road"])])
    got = learn.learn_rewrites(pairs, "a", "b", ["country"], support=5, precision=0.8).collect()
    assert [(x.form, x.target, x.n, x.total) for x in got] == [("nrth", "north", 6, 7)]
    rel = lambda x, y: df(spark, "x string, y string", [(x, y)]).select(learn.related(F.col("x"), F.col("y"))).first()[0]
    assert rel("mgmt", "management") and rel("nyc", "new york city") and rel("krishna", "krshna") and rel("street", "streat") and rel("mah", "maharashtra")
    assert not rel("12", "123") and not rel("same", "same") and not rel("", "x") and not rel("delhi", "mumbai")
    words = learn.learn_dictionary(df(spark, "country string, q array<string>, s array<string>", [("India", ["sistms", "hari"], ["systems", "hari"])] * 30), "q", "s", ["country"]).collect()
    assert [(x.form, x.target) for x in words] == [("sistms", "systems")]


def test_answer_lists(spark):
    ids = lambda raw: df(spark, "r string", [(raw,)]).select(S.parse_ids(F.col("r"))).first()[0]
    assert ids("") == ids(None) == [] and ids("S2-00047,S2-00193 ") == ["S2-00047", "S2-00193"]
    entities = df(spark, "s long, country string", [(1, "US"), (2, "India"), (3, "US")])
    lists = S.id_lists(entities, df(spark, "s long, q long", [(1, 20), (1, 10), (3, 5)])).orderBy("s")
    assert [x.ids for x in lists.collect()] == ["10,20", "", "5"]
    base, other = df(spark, "s long, ids string", [(1, "a,b"), (2, "c"), (3, "d")]), df(spark, "s long, ids string", [(1, "b,x"), (2, "y"), (3, "")])
    said = lambda out: [x.ids for x in out.orderBy("s").collect()]
    assert said(S.splice(base, other, entities, ["US"])) == ["b,x", "c", ""]
    assert said(S.intersect(base, other, entities, ["US"])) == ["b", "c", ""]
    assert said(S.vote([base, other], 2, base, entities, ["US", "India"])) == ["b", "", ""]
    rules = {x.rule: x.n for x in S.violations(entities.select("s"), df(spark, "s long, ids string", [(1, "10,10,99"), (2, "")]), df(spark, "s long, ids string", [(1, "10")]), df(spark, "q long", [(10,)])).collect()}
    assert rules == {"entity_without_row": 1, "unknown_entity": 0, "repeated_row": 0, "repeated_id": 1, "match_not_candidate": 1, "unknown_id": 1, "entity_as_match": 0}


def test_splits_and_bootstrap(spark):
    pool = df(spark, "s string, country string", [(f"e{i}", "US" if i % 5 < 3 else "India") for i in range(2000)])
    out = R.stratified_split(pool, (("train", 0.6), ("tune", 0.1), ("val", 0.3)))
    sizes = {(x.country, x.fold): x.n for x in out.groupBy("country", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes[("US", "train")] == 720 and sizes[("India", "tune")] == 80 and sum(sizes.values()) == 2000
    sure = R.paired_bootstrap(df(spark, "s long, delta double", [(i, 0.1 + 0.01 * (i % 3)) for i in range(200)])).first()
    even = R.paired_bootstrap(df(spark, "s long, delta double", [(i, 0.1 if i % 2 else -0.1) for i in range(200)])).first()
    assert sure.significant and sure.ci_low < sure.delta < sure.ci_high and not even.significant
    assert (R.keep_rule(0.01, 0.001), R.keep_rule(0.01, -0.1), R.keep_rule(0.001, 0.0001)) == ("keep", "reject", "repeat")
    draws = [x.w for x in spark.range(5000).select(R.poisson(R.drawn_from(F.col("id"), F.lit(1)), 3).alias("w")).collect()]
    assert np.mean(draws) == pytest.approx(1, abs=0.06)


def test_snap_and_lookalikes(spark):
    out = R.snap(df(spark, "id long, v double", [(1, 11.0), (2, 24.0), (3, 15.0), (4, -5.0), (5, 99.0)]), df(spark, "v double", [(10.0,), (20.0,), (30.0,)]))
    assert sorted((x.id, x.snapped) for x in out.collect()) == [(1, 10.0), (2, 20.0), (3, 10.0), (4, 10.0), (5, 30.0)]
    rec = df(spark, "rid long, name string, house_num string, owner long", [(i, "acme", str(100 + i), i) for i in range(50)] + [(99, "x", "", 1), (98, "x", "7", -1)])
    rows = R.lookalikes(rec).collect()
    assert len(rows) == 50 and all(x.owner == -1 and len(x.house_num) == 3 and x.house_num != str(100 + x.rid) for x in rows)


def test_scores(spark):
    rows = df(spark, "tv double, tu string, pv double, pu string", [(1.0, "kg", 1.0, "kg"), (1.0, "kg", 2.0, "kg"), (1.0, "kg", None, None), (None, None, 1.0, "kg")])
    x = M.extraction_f1(rows).first()
    assert (x.tp, x.fp, x.fn) == (1, 2, 2) and x.f1 == pytest.approx(1 / 3)
    x = M.regression_scores(df(spark, "a double, b double", [(100.0, 110.0), (50.0, 50.0)]), "a", "b").first()
    assert x.smape == pytest.approx(100 * (10 / 105) / 2) and x.mape_score == pytest.approx(95)
    per = df(spark, "country string, f_val double, f_loco double", [("US", 0.8, 0.7), ("India", 0.6, 0.5)])
    assert M.s_score(per).first()["s"] == pytest.approx(0.383 * 0.8 + 0.468 * 0.6 + 0.150 * 0.6)


def test_feature_vectors(spark):
    rec = df(spark, "rid long, name string, name_alias string, name_core string, name_legal_class string, name_skeleton string, addr string, addr_parts string, addr_landmark string, house_num string, postcode string, num_tokens string, source int, non_latin boolean", [(1, "acme tools llc", "", "acme tools", "llc", "akm tls", "5 main st", "5 main st", "", "5", "12345", "", 2, False), (2, "acme tools", "at", "acme tools", "none", "akm tls", "5 main st", "5 main st", "", "5", "12345", "", 1, False), (3, "", "", "", "none", "", "", "", "", "", "", "", 3, True)])
    pairs = features.lookup(df(spark, "q long, s long", [(1, 2), (3, 2), (4, 2)]), rec, [c for c in rec.columns if c != "rid"])
    assert [x.rid for x in features.unknown_ids(df(spark, "q long, s long", [(1, 2), (4, 2)]), rec).collect()] == [4]
    rows = {x.q: x for x in features.full_features(pairs.where("q < 4")).collect()}
    assert rows[1].core_ratio == 1 and rows[1].house_state == 0 and rows[1].legal_state == 2 and rows[1].street_house_state == 0 and rows[1].alias_best >= 0
    assert rows[3].addr_jaccard == 0 and rows[3].q_addr_empty == 1 and rows[3].house_state == 3 and rows[3].postcode_state == 2 and rows[3].q_is_s3 == 1
    basics = pairs.select(*[c.alias(k) for k, c in features.basic_features(F.col("q_name"), F.col("q_addr"), F.col("s_name"), F.col("s_addr"), F.lit(True)).items()])
    assert tuple(basics.columns) == features.BASIC


def test_files(spark, tmp_path):
    raw = tmp_path / "in.tsv"
    raw.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA, Inc\t"5, Main"\tUS\nS1-2\t\t\t\n')
    rows = tables.read_tsv(spark, str(raw)).orderBy("entity_id").collect()
    assert tuple(rows[0]) == ("S1-1", "NA, Inc", "5, Main", "US") and tuple(rows[1]) == ("S1-2", "", "", "")
    out = df(spark, "s string, ids string", [("b", "2,3"), ("a", "")])
    tables.write_tsv(out, str(tmp_path / "out"))
    assert [tuple(x) for x in tables.read_tsv(spark, str(tmp_path / "out"), tables.TRUTH).collect()] == [("a", ""), ("b", "2,3")]
    built = []
    make = lambda: built.append(1) or out
    for _ in range(2):
        assert tables.cached_stage(spark, str(tmp_path), "stage", "abc", make).count() == 2
    assert len(built) == 1
    tables.write_stage(out.withColumn("country", F.lit("US")), str(tmp_path / "st"))
    assert tables.read_stage(spark, str(tmp_path / "st"), ["s", "country"], df(spark, "s string", [("a",)]), "s").count() == 1
    assert {x.column: x.null_share for x in tables.null_profile(df(spark, "a int, b int", [(1, None), (2, 3)])).collect()} == {"a": 0, "b": 0.5}
    lines = tmp_path / "p.json"
    lines.write_text('{"item_id": "1", "item_name": [{"language_tag": "fr_FR", "value": "pomme"}, {"language_tag": "en_US", "value": "apple"}], "bullet_point": [{"language_tag": "en", "value": "x"}]}\n')
    assert tuple(tables.read_products(spark, str(lines)).first()) == ("1", "apple", "", "x")


def test_arrivals_are_matched(spark, tmp_path):
    index = df(spark, "token string, q long, idf double", [("acme", 1, 2.0), ("zeta", 2, 1.0)])
    df(spark, "s long, tokens array<string>", [(5, ["acme", "new"]), (6, ["none"])]).write.parquet(str(tmp_path / "in"))
    arrivals, got = spark.readStream.schema("s long, tokens array<string>").parquet(str(tmp_path / "in")), []
    query = match_arrivals(arrivals, index, lambda rows, n: got.extend((x.s, x.q) for x in rows.collect()), str(tmp_path / "ck"))
    query.awaitTermination(60)
    assert got == [(5, 1)]


def test_the_whole_way_finds_what_belongs_together(spark):
    import random

    from rowkin.functions.similarity import token_set_ratio
    from rowkin.plans.matching import Plan, match

    r = random.Random(1)
    names = [f"{a} {b}" for a in ("acme", "zeta", "nova", "orbit", "delta", "sigma") for b in ("tools", "foods", "media", "paper", "steel", "glass", "wood", "light", "stone", "water")]
    rec = [(i, n, "5 main st", "5", "1", 1) for i, n in enumerate(names)] + [(1000 + i, names[i % 60], "5 main st", "5", "1", 2 + i % 2) for i in range(240)]
    pairs = []
    for q in range(1000, 1240):
        own = (q - 1000) % 60
        for s in {own, *(r.randrange(60) for _ in range(6))}:
            pairs.append((q, s, round(0.4 + 0.5 * r.random(), 3), s == own, 1.0 if s == own else round(0.6 * r.random(), 3)))
    entities = df(spark, "s long, country string, t long", [(i, "US" if i % 2 else "India", 4) for i in range(60)])
    out = match(df(spark, "q long, s long, p double, label boolean, sim double", pairs), df(spark, "rid long, name_core string, addr string, house_num string, postcode string, source int", rec), entities, ["sim"], token_set_ratio, Plan(rounds=2, depth=2))
    assert {x.country: x for x in out.report.collect()}["ALL"].macro_f05 > 0.9  # what is lost is lost by pruning on a random first score
    assert out.lists.count() == 60 and out.pairs.where("pred").groupBy("q").count().where("count > 1").count() == 0


def test_every_pair_is_scored(spark):
    """No pair goes by its first score or its entity's number of pairs: FINDINGS_r03 F5."""
    from rowkin.plans.matching import Plan, match

    pairs = [(1000 + 30 * s + i, s, round(0.02 + 0.03 * i, 2), i % 3 == 0, float(i % 3 == 0)) for s in range(40) for i in range(30)]
    rec = [(i, "acme tools" if i % 3 else "zeta foods", "5 main st", "5", "1", 1 + i % 2) for i in (*range(40), *range(1000, 2200))]
    entities = df(spark, "s long, country string, t long", [(s, "US", 10) for s in range(40)])
    out = match(df(spark, "q long, s long, p double, label boolean, sim double", pairs), df(spark, "rid long, name_core string, addr string, house_num string, postcode string, source int", rec), entities, ["sim"], lambda a, b: (a == b).cast("double"), Plan(rounds=1, depth=1))
    assert {(x.q, x.s) for x in out.pairs.collect()} == {(q, s) for q, s, *_ in pairs}


def test_error_costs_and_gaps(spark):
    from rowkin.operators import diagnostics as G

    counts = df(spark, "s long, t long, k long, tp long", [(1, 2, 2, 1)])
    pairs = df(spark, "s long, q long, p double, label boolean, pred boolean", [(1, 10, 0.9, True, True), (1, 11, 0.8, False, True), (1, 12, 0.1, True, False)])
    got = {x.kind: x for x in G.error_costs(counts, pairs).collect()}
    assert got["wrong_accept"].gain == pytest.approx(1.25 / 1.5 - 0.5) and got["missed"].gain == pytest.approx(2.5 / 3.5 - 0.5) and got["missed"].p_bin == 2
    words = lambda key, rows: df(spark, f"{key} long, token string", rows)
    gaps = G.recall_gap(df(spark, "s long, q long", [(1, 1), (1, 2), (1, 3), (1, 4)]), words("s", [(1, "rare"), (1, "often")]), words("q", [(1, "rare"), (2, "often"), (3, "other"), (4, "rare")]), df(spark, "token string", [("rare",)]), df(spark, "s long, q long", [(1, 4)]))
    assert {x.q: x.cause for x in gaps.collect()} == {1: "ranked_out", 2: "purged", 3: "zero_overlap"}
    w = {x.guess: x.weight for x in G.blend_weights(df(spark, "a double, b double, y double", [(1.0, 3.0, 2.0), (2.0, 6.0, 4.0)]), ["a", "b"], "y").collect()}
    assert w == {"a": 0.5, "b": 0.5}
    with pytest.raises(ValueError):
        G.text_of(counts, "other")


def test_checked_joins(spark):
    from rowkin.operators import relational as L

    a, b = df(spark, "k long, x string", [(1, "a"), (2, "b")]), df(spark, "k long, y string", [(1, "c"), (2, "d")])
    assert sorted(map(tuple, L.one_to_one(a, b, ["k"]).collect())) == [(1, "a", "c"), (2, "b", "d")]
    for bad in (b.where("k = 1"), b.unionByName(b)):
        with pytest.raises(Exception, match="one to one"):
            L.one_to_one(a, bad, ["k"]).collect()
    rec = df(spark, "name string, rid long", [("x", 2), ("x", 1), ("y", 3)])
    got = L.back_reference(df(spark, "name string, edit int", [("x", 1), ("z", 2)]), rec, ["name"], ["rid"], [F.col("rid")])
    assert sorted((x.name, x.rid) for x in got.collect()) == [("x", 1), ("z", None)]
    assert [x.name for x in L.by_length(df(spark, "name string", [("ccc",), ("a",), ("bb",)]).coalesce(1), "name").collect()] == ["a", "bb", "ccc"]
    assert L.implied_share(0.9, {"a": (0.5, 1.0), "b": (0.3, 1.0)}, 0.2) == pytest.approx(0.5)
    rows = df(spark, "id long, x double, y double", [(i, float(i % 10), float(i % 10) * 2) for i in range(100)])
    out, models = learner.cv_regression(rows, ["x"], "y", 2, rounds=3)
    assert out.count() == 100 and len(models) == 2 and out.where("abs(oof - y) > 4").count() == 0


def test_shifts_misses_and_order(spark):
    from rowkin.plans import matching
    from rowkin.plans.matching import Plan

    rows = df(spark, "q long, s long, country string, p double, rel string", [(1, 1, "US", 0.8, "equal"), (2, 1, "US", 0.8, "different"), (3, 2, "France", 0.8, "equal"), (4, 2, "France", 0.8, "different")])
    z = lambda p: np.log(p / (1 - p))
    got = {x.q: x.p for x in matching.corrected(rows.withColumn("p2", F.lit(0.6)), Plan(lookalike_shift=1.0, unseen_shift=0.5), ["US"], F.col("rel") == "different", "p2").collect()}
    want = {}
    for q, unseen, differs in ((1, 0, 0), (2, 0, 1), (3, 1, 0), (4, 1, 1)):
        p = (1 / (1 + np.exp(-(z(0.8) - differs))) + 0.6) / 2
        want[q] = 1 / (1 + np.exp(-(z(p) - 0.5 * unseen)))
    assert got == pytest.approx(want, abs=1e-9)
    entities = df(spark, "s long, t long", [(1, 3), (2, 1), (3, 0)])
    assert D.blocking_misses(entities, df(spark, "s long, q long, label boolean", [(1, 5, True), (1, 6, False), (2, 7, True)])).first()["misses"] == pytest.approx(2 / 3)
    assert D.blocking_misses(entities.limit(0), df(spark, "s long, label boolean", [(1, True)])).first()["misses"] == 0
    assert matching.offset_of_parameters({"a": 0.6, "b": 0.5}, {"a": 0.4, "b": 0.45}) == pytest.approx(0.125) and matching.offset_of_parameters({"a": 0.6, "b": 0.4}, {"a": 0.4, "b": 0.45}) == 0
    cells = df(spark, "country string, rel string, p double, p_raw double", [("US", r, 0.3, 0.2) for r in ("equal", "different") for _ in range(60)])
    priors = df(spark, "country string, rel string, rate double", [("US", "equal", 0.5), ("US", "different", 0.5)])
    moved = {x.rel: x.p for x in matching.rebased(cells, priors, Plan(em_cells="known_different", least_cell=50)).collect()}
    assert moved["equal"] == pytest.approx(0.3) and moved["different"] < 0.3
    scored = df(spark, "q long, s long, country string, p double, p_raw double, label boolean", [(1, 1, "US", 0.5, 0.4, True), (1, 2, "US", 0.5, 0.6, False), (2, 3, "France", 0.6, 0.6, True)])
    chosen = {(x.q, x.s): x.pred for x in matching.decided(scored, 0.5, 0.0, ["US"], 100.0).collect()}
    assert chosen == {(1, 1): False, (1, 2): True, (2, 3): False}


def test_totals_keep_null_groups_apart(spark):
    rows = df(spark, "s long, country string, t long, k long, tp long, r long", [(1, None, 1, 1, 1, 1), (2, "US", 2, 0, 0, 1)])
    assert sorted((x.country is None, x.country or "", x.n) for x in M.report(rows).collect()) == [(False, "ALL", 2), (False, "US", 1), (True, "", 1)]
    priors = D.train_priors(df(spark, "country string, rel string, label boolean", [(None, "a", True), ("US", "a", False)])).collect()
    assert sorted((x.country or "", x.rate) for x in priors) == [("", 1.0), ("*", 0.5), ("US", 0.0)]


def test_pseudo_refit_and_bands(spark):
    from rowkin.plans import matching

    rows = df(spark, "q long, s long, p double, p_raw double, x double, ce double, label boolean, train boolean, fold string", [(i, i, (i % 100) / 100, (i % 100) / 100, float(i % 100), min(max((i % 100) / 100, 0.01), 0.99), i % 100 > 50, i < 200, "tune" if i % 2 else "train") for i in range(400)])
    out = matching.refit_on_sure(rows, ["x"], lambda part, g: learner.fit_gbt(part, rounds=2, depth=2))
    assert out.count() == 400 and out.where("x > 90 AND p_refit < 0.5 OR x < 10 AND p_refit > 0.5").count() == 0
    banded = {x.q: x for x in matching.band_scores(rows, ["ce"], 0.2, 0.8).collect()}
    assert banded[5].p == 0.05 and banded[95].p == 0.95 and banded[30].p < 0.3 and banded[95].p_raw == pytest.approx(0.95 + 0.95e-9)


def test_lists_of_features(spark):
    columns = ["q", "s", "n_score", "n_rank", "b_score", "x"]
    assert features.channel_names(columns) == ["n"] and features.without_groups(columns, {"n": ["n_score", "n_rank"]}, ["n"]) == ["q", "s", "b_score", "x"]
    with pytest.raises(ValueError, match="unknown"):
        features.without_groups(columns, {"n": []}, ["z"])
    a = df(spark, "q long, s long, x int", [(1, 1, 1), (2, 1, 2)])
    with pytest.raises(Exception, match="one to one"):
        features.add_on(a, df(spark, "q long, s long, y int", [(1, 1, 1)])).collect()


def test_calibration_equals_pooled_neighbours(spark):
    """Isotonic regression against pool-adjacent-violators in plain Python."""
    import random

    r = random.Random(5)
    points = [(i, round(r.random(), 3), r.random()) for i in range(300)]
    rows = df(spark, "q long, s long, p double, label boolean", [(i, i, p, u < p * p) for i, p, u in points])
    by = {}
    for _, p, u in points:
        n, hits = by.get(p, (0, 0))
        by[p] = (n + 1, hits + (u < p * p))
    blocks = []
    for p in sorted(by):
        n, hits = by[p]
        blocks.append([hits, n, [p]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            hits, n, ps = blocks.pop()
            blocks[-1] = [blocks[-1][0] + hits, blocks[-1][1] + n, blocks[-1][2] + ps]
    want = {p: hits / n for hits, n, ps in blocks for p in ps}
    got = {x.p: x.p_cal for x in learner.calibrate(rows, rows).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_long_lists_are_dealt_in_parts(spark):
    """One token in half of the records: its list is dealt, nothing is lost, and no part holds more than its share."""
    rec = df(spark, "id long, tokens array<string>", [(i, [f"t{i % 40}", "all"] if i % 2 else [f"t{i % 40}"]) for i in range(3000)])
    stats = B.token_stats(rec, "id", "tokens", 0.9)
    whole, dealt = (B.postings(rec, "id", "tokens", stats, most=n) for n in (10**6, 100))
    assert dealt.where("token = 'all'").select("parts").distinct().first()[0] == 15 and whole.where("parts > 1").count() == 0
    q = lambda posts: posts.where("id < 60").select(F.col("id").alias("s"), "token", "parts")
    x = lambda posts: posts.where("id >= 60").select(F.col("id").alias("q"), "token", "idf", "parts")
    rows = lambda posts: sorted((y.s, y.q, round(y.score, 9), y.shared) for y in B.token_candidates(q(posts), x(posts), k=5000).collect())
    assert rows(whole) == rows(dealt) and len(rows(whole)) > 40_000
    load = x(dealt).withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts").cast("long"))).groupBy("token", "part").count().agg(F.max("count")).first()[0]
    assert load < 150


def test_snap_reads_no_frame_to_the_end_for_each_row(spark):
    """Time in proportion to a band's rows: FINDINGS_r02 F11."""
    import bisect
    import random

    from rowkin.operators import resample

    draw = random.Random(5)
    values, known = [(i, float(draw.randint(-50, 5000))) for i in range(3000)], sorted({float(draw.randint(0, 4900)) for _ in range(200)})
    out = resample.snap(df(spark, "id long, v double", values), df(spark, "v double", [(x,) for x in known]))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert not any("unboundedfollowing" in x.lower() and "rangeframe" in x.lower() for x in plan.split("\n"))
    near = lambda v: min((x for x in known[max(0, bisect.bisect_left(known, v) - 1) : bisect.bisect_left(known, v) + 1]), key=lambda x: (abs(x - v), x))
    assert {r.id: r.snapped for r in out.collect()} == {i: near(v) for i, v in values}


def test_label_free_routes_broadcast_no_table_of_records(spark):
    """Keys of records are shuffled, whatever their size as files: FINDINGS_r02 F3."""
    from rowkin.plans import blocking_queries as BQ

    plan = BQ.label_free_routes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan  # the check of one row is a BroadcastNestedLoopJoin


def test_sibling_support_broadcasts_no_records(spark):
    """Records and pairs are small as files and large in a driver's memory: FINDINGS_r02 F9."""
    from rowkin.plans import pair_queries as P

    plan = P.sibling_support(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
