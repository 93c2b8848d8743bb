"""K-operators: folds, naive chain, selection tie-breaks, Gram OLS/ridge vs numpy."""

import numpy as np
from pyspark.sql import functions as F

from salesmart.operators import forecast as K


def frame(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g in ("A", "B"):
        for i in range(72):
            y, m = 1995 + i // 12, i % 12 + 1
            x1, x2 = float(rng.normal(10, 2)), float(rng.normal(5, 1))
            v = 100 + 3 * x1 - 2 * x2 + (20 if g == "B" else 0) + float(rng.normal(0, 0.5))
            rows.append((g, y, m, v, x1, x2))
    return spark.createDataFrame(rows, "canonical_group string, report_year int, report_month int, y double, "
                                       "x1 double, x2 double")


def test_explode_folds_roles(spark):
    f = K.explode_folds(frame(spark))
    c = {(r.fold, r.role): r.n for r in f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert c[("val_1998", "train")] == 2 * 36 and c[("val_1998", "eval")] == 24
    assert c[("test_2000", "train")] == 2 * 60 and c[("test_2000", "eval")] == 24


def test_gram_ols_and_ridge_match_numpy(spark):
    folded = K.explode_folds(frame(spark))
    des = K.design(folded, ["x1", "x2"])
    coefs = {(r.canonical_group, r.fold, r.alpha): (r.intercept, r.coef)
             for r in K.fit_linear(des, 2, alphas=(0.0, 10.0)).collect()}
    pdf = folded.filter((F.col("role") == "train") & (F.col("fold") == "test_2000")
                        & (F.col("canonical_group") == "A")).toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    beta = np.linalg.lstsq(X, pdf.y, rcond=None)[0]
    b0, b = coefs[("A", "test_2000", 0.0)]
    assert np.allclose([b0, *b], beta, rtol=1e-8, atol=1e-8)
    xc = np.column_stack([pdf.x1 - pdf.x1.mean(), pdf.x2 - pdf.x2.mean()])
    rb = np.linalg.solve(xc.T @ xc + 10 * np.eye(2), xc.T @ (pdf.y - pdf.y.mean()))
    assert np.allclose(coefs[("A", "test_2000", 10.0)][1], rb, rtol=1e-8)


def test_choose_best_ties_earliest(spark):
    cands = spark.createDataFrame([("g", "b", 5.0, 1.0, 1), ("g", "a", 5.0, 2.0, 0), ("g", "c", None, 0.1, 2)],
                                  "canonical_group string, candidate string, val_mape double, test_mape double, "
                                  "cand_order int")
    r = K.choose_best(cands).first()
    assert (r.best_candidate, r.test_mape) == ("a", 2.0)


def test_mape_skips_zero_targets(spark):
    p = spark.createDataFrame([("g", "c", "f", "validation", 0.0, 5.0), ("g", "c", "f", "validation", 10.0, 12.0)],
                              "canonical_group string, candidate string, fold string, fold_kind string, "
                              "y double, pred double")
    assert abs(K.fold_scores(p).first().mape - 20.0) < 1e-12


def test_holt_winters_runs(spark):
    f = K.explode_folds(frame(spark).withColumn("y", F.col("y") + 10 * F.sin(F.col("report_month"))))
    out = K.holt_winters(f)
    assert out.count() == 2 * 36 and out.filter(F.col("pred") < 0).count() == 0


def test_elastic_net_l1_zero_equals_ridge(spark):
    folded = K.explode_folds(frame(spark))
    des = K.design(folded, ["x1", "x2"])
    n_train = {(r.canonical_group, r.fold): r.n for r in des.filter(F.col("role") == "train")
               .groupBy("canonical_group", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    alpha = 0.5
    pdf = K.gram(des, 2).toPandas()
    en = K._enet_rows(pdf, 2, alpha, 0.0, max_iter=20000, tol=1e-14)
    ridge = K._solve_rows(pdf, 2, [alpha * n for n in sorted(set(n_train.values()))])
    for _, r in en.iterrows():
        n = n_train[(r["canonical_group"], r["fold"])]
        rr = ridge[(ridge.canonical_group == r["canonical_group"]) & (ridge.fold == r["fold"])
                   & (ridge.alpha == alpha * n)].iloc[0]
        assert np.allclose(r["coef"], rr["coef"], rtol=1e-6, atol=1e-8)


def test_folds_follow_the_data(spark):
    """The newest year is the test year, whatever it is; no row is left out."""
    late = frame(spark).withColumn("report_year", F.col("report_year") + 30)
    assert K.fold_specs(late) == [("val_2028", 2028, "validation"), ("val_2029", 2029, "validation"), ("test_2030", 2030, "test")]
    assert K.fold_specs(late, calibration=True)[0] == ("calib_2027", 2027, "calibration")
    f = K.explode_folds(late)
    assert f.select("canonical_group", "report_year", "report_month").distinct().count() == late.count()
    assert f.where("fold = 'test_2030' AND role = 'eval'").count() == 24
    w = {r.report_year: r.w for r in f.withColumn("canonical_group", F.lit("GIFT_LOW"))
         .select("report_year", K.regime_weight().alias("w")).distinct().collect()}
    assert w == {2025: 1.0, 2026: 1.0, 2027: 1.0, 2028: 2.0, 2029: 4.0, 2030: 1.0}
    none = frame(spark).limit(0)
    assert K.fold_specs(none) == [] and K.explode_folds(none).count() == 0


def test_masked_fits_equal_separate_fits(spark):
    """One Gram pass, each series its own features; an absent column is left out."""
    folded = K.explode_folds(frame(spark))
    feats = ["x1", "nowhere", "x2"]
    mask = K.feature_mask(feats, folded.columns, {"B": ("x1",)})
    des = K.design(folded, feats)
    ridge = {(r.canonical_group, r.fold, r.alpha): r for r in K.fit_linear(des, 3, alphas=(0.0, 7.0), mask=mask).collect()}
    net = {(r.canonical_group, r.fold): r for r in K.fit_elastic_net(des, 3, 0.1, 0.5, mask=mask).collect()}
    pdf = folded.filter("role = 'train'").toPandas()
    for (g, fold), rows in pdf.groupby(["canonical_group", "fold"]):
        own = ["x1", "x2"] if g == "A" else ["x2"]
        x, y = rows[own].to_numpy(), rows.y.to_numpy()
        xc, yc = x - x.mean(0), y - y.mean()
        for alpha in (0.0, 7.0):
            beta = np.linalg.solve(xc.T @ xc + alpha * np.eye(len(own)), xc.T @ yc)
            got = ridge[(g, fold, alpha)]
            assert np.allclose([got.coef[feats.index(c)] for c in own], beta) and got.coef[1] == 0.0
            assert np.isclose(got.intercept, y.mean() - x.mean(0) @ beta) and (g == "A" or got.coef[0] == 0.0)
        assert net[(g, fold)].coef[1] == 0.0 and (g == "A" or net[(g, fold)].coef[0] == 0.0)


def _predictions(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in ("GIFT_LOW", "GIFT_HIGH", "GIFT_COMBINED", "OTHER"):
        for year, kind in ((2000, "calibration"), (2001, "validation"), (2002, "validation"), (2003, "test")):
            for m in range(1, 13):
                y = 100.0 + 10 * m if g != "OTHER" else (0.0 if m == 3 else 50.0)
                for c, skill in (("naive", 0.3), ("m1", 0.1), ("m2", 0.2), ("m3", 0.25), ("m4", 0.6)):
                    bias = 0.5 if g == "GIFT_LOW" and m < 7 else 1.0           # a steady error by month: calibration helps
                    rows.append((g, f"f{year}", kind, year, m, y, c, float(y * bias * (1 + skill * rng.normal() * 0.1))))
    return spark.createDataFrame(rows, "canonical_group string, fold string, fold_kind string, report_year int, report_month int, "
                                       "y double, candidate string, pred double")


def test_strategies_equal_a_plain_version_and_factors_come_from_the_year_before(spark):
    preds = _predictions(spark)
    cands = K.candidate_table(K.fold_scores(preds), {c: i for i, c in enumerate(("naive", "m1", "m2", "m3", "m4"))})
    strategies = K.strategy_predictions(preds, cands, exclude=("naive",))
    got = {(r.canonical_group, r.candidate, r.report_year, r.report_month): r.pred for r in strategies.collect()}
    rows = preds.collect()
    at = {(r.canonical_group, r.candidate, r.report_year, r.report_month): r for r in rows}

    def mape(series):
        use = [(y, p) for y, p in series if y != 0]
        return sum(abs(y - p) / abs(y) * 100 for y, p in use) / len(use)
    names, want = ("naive", "m1", "m2", "m3", "m4"), {}
    best = {}
    for g in ("GIFT_LOW", "GIFT_HIGH", "GIFT_COMBINED", "OTHER"):
        score = {c: np.mean([mape([(at[g, c, y, m].y, at[g, c, y, m].pred) for m in range(1, 13)]) for y in (2001, 2002)]) for c in names}
        best[g] = min(names, key=lambda c: (score[c], names.index(c)))
        top = sorted((c for c in names if c != "naive"), key=lambda c: score[c])[:3]
        for y in range(2000, 2004):
            for m in range(1, 13):
                direct = at[g, best[g], y, m].pred
                want[g, "direct", y, m] = direct
                want[g, "ensemble", y, m] = np.mean([at[g, c, y, m].pred for c in top])
                old = at.get((g, best[g], y - 1, m))
                want[g, "calibrated", y, m] = direct * (min(2.5, max(0.4, old.y / old.pred)) if old and old.pred else 1.0)
    for y in range(2000, 2004):
        for m in range(1, 13):
            want["GIFT_COMBINED", "bottom_up", y, m] = want["GIFT_LOW", "direct", y, m] + want["GIFT_HIGH", "direct", y, m]
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
    chosen = {r.canonical_group: r for r in K.choose_strategy(strategies).collect()}
    for g in best:
        score = {s: np.mean([mape([(at[g, best[g], y, m].y, want[g, s, y, m]) for m in range(1, 13)]) for y in (2001, 2002)])
                 for s in K.STRATEGIES if (g, s, 2001, 1) in want}
        assert np.isclose(chosen[g].val_mape, min(score.values())) and np.isclose(score[chosen[g].best_candidate], chosen[g].val_mape)
    assert chosen["GIFT_LOW"].best_candidate == "calibrated"


def test_t_distribution_against_known_values():
    """Two-sided tails and quantiles of Student's distribution (printed tables)."""
    from salesmart.operators.forecast import t_quantile, t_two_sided
    assert abs(t_two_sided(2.228139, 10) - 0.05) < 1e-6 and abs(t_two_sided(1.0, 1) - 0.5) < 1e-12
    assert abs(t_two_sided(-3.169273, 10) - 0.01) < 1e-6 and abs(t_two_sided(1.959964, 1e7) - 0.05) < 1e-5
    assert abs(t_quantile(0.05, 4) - 2.776445) < 1e-5 and t_two_sided(0.0, 5) == 1.0
