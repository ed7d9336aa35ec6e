"""Queries run with the operators' full settings."""


def test_resampling_and_cross_fitting_use_full_settings(spark, monkeypatch):
    from rowkin.plans import pair_queries as P

    asked, real = [], P.R.paired_bootstrap
    monkeypatch.setattr(P.R, "paired_bootstrap", lambda delta, replicates=200: asked.append(replicates) or real(delta, 8))
    P.bootstrap_ci(spark, "/root/testdata/sf0.001")
    assert asked == [1000]
    said = []
    monkeypatch.setattr(P.learner, "fit_gbt", lambda rows, seed, **options: said.append(options))
    monkeypatch.setattr(P.learner, "cross_fit", lambda rows, k, fit: fit(rows, 0) or rows.selectExpr("s", "q", "label", "p0 AS p", "train"))
    P.gbt_crossfit(spark, "/root/testdata/sf0.001")
    assert said == [{}]
