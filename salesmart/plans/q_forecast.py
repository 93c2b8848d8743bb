"""Forecast queries.

Naive candidates, their scores and everything chosen from them are checked
against SQL, and so are the strategies over one-regressor models; fitted models
(OLS with inference, ridge grid, elastic net, Holt-Winters, trees) are checked by
facts that right fits show and, for 1 and 2 regressors, by SQL's closed forms.
Folds come from the years of the data: the newest is the test year.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators import features as FE
from salesmart.operators import forecast as K
from salesmart.operators import trees as T
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_features import FEAT_LOCAL
from salesmart.plans.q_marts import DATASET_NEEDS, group_dataset_df
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir

G = K.SERIES
NAIVE = ["seasonal_naive_v1", "seasonal_naive_v2", "trend_naive"]
NAIVE_ORDER = {n: i for i, n in enumerate(NAIVE)}
_ORDER_SQL = "CASE candidate " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in NAIVE_ORDER.items()) + " END"

SQL_LOCAL = {
    **FEAT_LOCAL,
    "spans": """
SELECT CASE last - y WHEN 0 THEN 'test_' WHEN 3 THEN 'calib_' ELSE 'val_' END || y AS fold, CAST(y AS INTEGER) AS eval_year,
       CASE last - y WHEN 0 THEN 'test' WHEN 3 THEN 'calibration' ELSE 'validation' END AS fold_kind
FROM (SELECT last, unnest(range(last - 3, last + 1)) AS y FROM (SELECT max(report_year) AS last FROM features))""",
    "all_folded": """
SELECT f.*, s.fold, s.eval_year, s.fold_kind,
       CASE WHEN f.report_year < s.eval_year THEN 'train' ELSE 'eval' END AS role, CAST(f.sales_result AS DOUBLE) AS y
FROM features f JOIN spans s ON f.report_year <= s.eval_year""",
    "folded": "SELECT * FROM all_folded WHERE fold_kind <> 'calibration'",
    "tstats": f"""
SELECT {G}, fold, median(y) AS train_median, avg(y) AS train_mean,
       CASE WHEN l12 / (p12 + 1e-9) IS NOT NULL THEN greatest(0.8, least(1.3, l12 / (p12 + 1e-9))) END AS trend_factor
FROM (SELECT {G}, fold, median(y) AS m, y, rk FROM (
        SELECT *, row_number() OVER (PARTITION BY {G}, fold ORDER BY report_year DESC, report_month DESC) AS rk
        FROM folded WHERE role = 'train') GROUP BY ALL) x
JOIN (SELECT {G} AS g2, fold AS f2, avg(CASE WHEN rk <= 12 THEN y END) AS l12,
             avg(CASE WHEN rk > 12 AND rk <= 24 THEN y END) AS p12
      FROM (SELECT *, row_number() OVER (PARTITION BY {G}, fold ORDER BY report_year DESC, report_month DESC) AS rk
            FROM folded WHERE role = 'train') GROUP BY 1, 2) t ON t.g2 = x.{G} AND t.f2 = x.fold
GROUP BY {G}, fold, l12, p12""",
    "ev": f"SELECT e.*, t.train_median, t.trend_factor FROM folded e LEFT JOIN tstats t USING ({G}, fold) WHERE role = 'eval'",
    "preds": f"""
SELECT {G}, fold, fold_kind, report_year, report_month, y, 'seasonal_naive_v1' AS candidate,
       greatest(COALESCE(sales_lag_12m, sales_lag_3m, sales_lag_1m, train_median), 0) AS pred FROM ev
UNION ALL
SELECT {G}, fold, fold_kind, report_year, report_month, y, 'seasonal_naive_v2',
       greatest(COALESCE(sales_lag_12m, sales_rolling_6m_mean, train_median), 0) FROM ev
UNION ALL
SELECT {G}, fold, fold_kind, report_year, report_month, y, 'trend_naive',
       greatest(COALESCE(sales_lag_12m, train_median) * trend_factor, 0) FROM ev""",
    "scores": f"""
SELECT {G}, candidate, fold, fold_kind,
       avg(CASE WHEN y <> 0 AND pred IS NOT NULL AND NOT isnan(pred) THEN abs(y - pred) / abs(y) * 100.0 END) AS mape,
       COUNT(*) AS n
FROM preds GROUP BY 1, 2, 3, 4""",
    "cands": f"""
SELECT {G}, candidate, avg(CASE WHEN fold_kind = 'validation' THEN mape END) AS val_mape,
       max(CASE WHEN fold_kind = 'test' THEN mape END) AS test_mape, {_ORDER_SQL} AS cand_order
FROM scores GROUP BY 1, 2""",
    "best": f"""
SELECT {G}, candidate AS best_candidate, val_mape, test_mape FROM (
  SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY val_mape, cand_order) AS rn
  FROM cands WHERE val_mape IS NOT NULL) WHERE rn = 1""",
    "best_preds": f"""
SELECT p.* FROM preds p JOIN best b ON b.{G} = p.{G} AND b.best_candidate = p.candidate""",
}


def _sql(body):
    return with_ctes(body, *DATASET_NEEDS, local=SQL_LOCAL)


def _folded(spark, sf, calibration=False):
    feat = FE.build_features(group_dataset_df(spark, sf)).withColumn("y", F.col("sales_result").cast("double"))
    return K.explode_folds(feat, calibration=calibration)


def _naive(spark, sf):
    folded = _folded(spark, sf)
    checkpoint_dir(spark)
    preds = K.naive_predictions(folded).checkpoint(eager=True)   # choice, members and total all read it
    scores = K.fold_scores(preds)
    cands = K.candidate_table(scores, NAIVE_ORDER)
    return folded, preds, scores, cands


def _r6(c):
    return F.round(c, 6).alias(c)


@query("naive_scores", _sql(f"""
SELECT {G}, candidate, fold, fold_kind, ROUND(mape, 6) AS mape, n FROM scores WHERE candidate LIKE 'seasonal%'"""))
def q_naive_scores(spark, sf):
    """Seasonal-naive chains scored per walk-forward fold."""
    _, _, scores, _ = _naive(spark, sf)
    return scores.filter(F.col("candidate").startswith("seasonal")).select(
        G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


@query("trend_naive_scores", _sql(f"""
SELECT s.{G}, s.fold, ROUND(t.trend_factor, 9) AS trend_factor, ROUND(s.mape, 6) AS mape, s.n
FROM scores s JOIN tstats t ON t.{G} = s.{G} AND t.fold = s.fold WHERE s.candidate = 'trend_naive'"""))
def q_trend_naive_scores(spark, sf):
    """lag12 x clipped trailing-12 / prior-12 trend factor, scored per fold."""
    folded, _, scores, _ = _naive(spark, sf)
    st = K.train_stats(folded)
    return (scores.filter(F.col("candidate") == "trend_naive").join(st, [G, "fold"])
            .select(G, "fold", F.round("trend_factor", 9).alias("trend_factor"), _r6("mape"), "n"))


@query("model_choice", _sql(f"""
SELECT {G}, best_candidate, ROUND(val_mape, 6) AS val_mape, ROUND(test_mape, 6) AS test_mape FROM best"""))
def q_model_choice(spark, sf):
    """Lowest mean validation MAPE (earliest on ties); test scored after."""
    _, _, _, cands = _naive(spark, sf)
    return K.choose_best(cands).select(G, "best_candidate", _r6("val_mape"), _r6("test_mape"))


@query("ensemble", _sql(f"""
SELECT {G}, fold, fold_kind, ROUND(avg(CASE WHEN y <> 0 AND pred IS NOT NULL AND NOT isnan(pred)
                                          THEN abs(y - pred) / abs(y) * 100.0 END), 6) AS mape, COUNT(*) AS n
FROM (SELECT {G}, fold, fold_kind, report_year, report_month, first(y) AS y, avg(pred) AS pred
      FROM preds WHERE (({G}, candidate) IN (SELECT ({G}, candidate) FROM (
            SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY val_mape, cand_order) AS rk
            FROM cands WHERE val_mape IS NOT NULL) WHERE rk <= 3))
      GROUP BY 1, 2, 3, 4, 5)
GROUP BY 1, 2, 3"""))
def q_ensemble(spark, sf):
    """Mean of the top-3 candidates by validation MAPE, scored per fold."""
    _, preds, _, cands = _naive(spark, sf)
    ens = K.ensemble(preds, K.top_k(cands, 3))
    return K.fold_scores(ens).select(G, "fold", "fold_kind", _r6("mape"), "n")


@query("bottom_up", _sql(f"""
SELECT fold, fold_kind, ROUND(bu_mape, 6) AS bottom_up_mape, ROUND(direct_mape, 6) AS direct_mape FROM (
  SELECT s.fold, s.fold_kind,
         avg(CASE WHEN s.y <> 0 THEN abs(s.y - s.pred) / abs(s.y) * 100.0 END) AS bu_mape,
         avg(CASE WHEN s.y <> 0 THEN abs(s.y - d.pred) / abs(s.y) * 100.0 END) AS direct_mape
  FROM (SELECT m.fold, m.fold_kind, m.report_year, m.report_month, c.y, sum(m.pred) AS pred
        FROM best_preds m JOIN best_preds c ON c.fold = m.fold AND c.report_year = m.report_year
         AND c.report_month = m.report_month AND c.{G} = 'GIFT_COMBINED'
        WHERE m.{G} IN ('GIFT_LOW', 'GIFT_HIGH') GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) = 2) s
  JOIN best_preds d ON d.fold = s.fold AND d.report_year = s.report_year AND d.report_month = s.report_month
   AND d.{G} = 'GIFT_COMBINED'
  GROUP BY 1, 2)"""))
def q_bottom_up(spark, sf):
    """LOW + HIGH chosen predictions vs the direct COMBINED model, per fold
    (pick the hierarchy on the validation folds, not on test)."""
    _, preds, _, cands = _naive(spark, sf)
    best = K.choose_best(cands)
    bp = preds.join(best.select(G, F.col("best_candidate").alias("candidate")), [G, "candidate"], "left_semi")
    bu = K.bottom_up(bp)
    direct = bp.filter(F.col(G) == "GIFT_COMBINED").select("fold", "report_year", "report_month",
                                                            F.col("pred").alias("direct_pred"))
    j = bu.join(direct, ["fold", "report_year", "report_month"])
    ok = F.col("y") != 0
    return j.groupBy("fold", "fold_kind").agg(
        F.round(F.avg(F.when(ok, F.abs(F.col("y") - F.col("pred")) / F.abs("y") * 100.0)), 6).alias("bottom_up_mape"),
        F.round(F.avg(F.when(ok, F.abs(F.col("y") - F.col("direct_pred")) / F.abs("y") * 100.0)), 6)
        .alias("direct_mape"))


@query("month_bias", _sql(f"""
SELECT {G}, report_month, ROUND(COALESCE(CASE WHEN y / NULLIF(pred, 0) IS NOT NULL
                                               THEN greatest(0.4, least(2.5, y / NULLIF(pred, 0))) END, 1.0), 9) AS bias_factor
FROM best_preds WHERE report_year + 1 = (SELECT max(report_year) FROM features)"""))
def q_month_bias(spark, sf):
    """Per-month calibration factors of the chosen model from the last validation year."""
    folded, preds, _, cands = _naive(spark, sf)
    best = K.choose_best(cands)
    bp = preds.join(best.select(G, F.col("best_candidate").alias("candidate")), [G, "candidate"], "left_semi")
    test_year = K.fold_specs(folded)[-1][1]
    return K.month_bias(bp.filter(F.col("report_year") == test_year - 1)).select(
        G, "report_month", F.round("bias_factor", 9).alias("bias_factor"))


@query("scorecard", _sql(f"""
SELECT {G}, best_candidate, ROUND(test_mape, 6) AS test_mape, target_mape,
       CASE WHEN test_mape <= target_mape THEN 'OK' WHEN target_mape IS NOT NULL THEN 'NG' END AS status
FROM (SELECT b.*, CAST(CASE {G} {" ".join(f"WHEN '{g}' THEN {v}" for g, v in K.MAPE_TARGETS.items())} END AS DOUBLE) AS target_mape
      FROM best b)"""))
def q_scorecard(spark, sf):
    """Chosen model's test MAPE against the group's target."""
    _, _, _, cands = _naive(spark, sf)
    sc = K.scorecard(K.choose_best(cands))
    return sc.select(G, "best_candidate", _r6("test_mape"), "target_mape", "status")


@query("peak_hit_rate", _sql(f"""
SELECT {G}, fold, COUNT(*) FILTER (WHERE ra <= 3 AND rp <= 3) AS hits,
       ROUND(COUNT(*) FILTER (WHERE ra <= 3 AND rp <= 3) / 3, 6) AS hit_rate
FROM (SELECT *, row_number() OVER (PARTITION BY {G}, fold ORDER BY y DESC, report_month) AS ra,
             row_number() OVER (PARTITION BY {G}, fold ORDER BY pred DESC, report_month) AS rp
      FROM best_preds) GROUP BY 1, 2"""))
def q_peak_hit_rate(spark, sf):
    """Overlap of predicted and actual top-3 months of the chosen model."""
    _, preds, _, cands = _naive(spark, sf)
    best = K.choose_best(cands)
    bp = preds.join(best.select(G, F.col("best_candidate").alias("candidate")), [G, "candidate"], "left_semi")
    return K.peak_hit_rate(bp)


@query("month_errors", _sql(f"""
SELECT {G}, report_year, report_month, y, ROUND(pred, 4) AS pred,
       ROUND(abs(y - pred) / greatest(abs(y), 1.0) * 100, 4) AS error_pct
FROM best_preds WHERE fold_kind = 'test'"""))
def q_month_errors(spark, sf):
    """Per-month error table of the chosen model on the test year."""
    _, preds, _, cands = _naive(spark, sf)
    best = K.choose_best(cands)
    bp = preds.join(best.select(G, F.col("best_candidate").alias("candidate")), [G, "candidate"], "left_semi")
    return K.month_errors(bp.filter(F.col("fold_kind") == "test")).select(
        G, "report_year", "report_month", "y", F.round("pred", 4).alias("pred"), "error_pct")


# --- fitted models ---------------------------------------------------------------
def _design(spark, sf, features, mode="raw", weighted=False):
    return K.design(_folded(spark, sf), features, mode, weighted)


@query("ols_simple", _sql(f"""
SELECT {G}, fold, ROUND(regr_slope(y, x), 6) AS slope, ROUND(regr_intercept(y, x), 1) AS intercept,
       COUNT(*) AS n
FROM (SELECT {G}, fold, y, COALESCE(sales_lag_12m, 0) AS x FROM folded WHERE role = 'train') GROUP BY 1, 2"""))
def q_ols_simple(spark, sf):
    """K6 with one regressor (sales ~ lag12) via the Gram aggregation."""
    des = _design(spark, sf, ["sales_lag_12m"])
    c = K.fit_linear(des, 1, alphas=(0.0,))
    n = des.filter(F.col("role") == "train").groupBy(G, "fold").agg(F.count(F.lit(1)).alias("n"))
    return c.join(n, [G, "fold"]).select(G, "fold", F.round(F.col("coef")[0], 6).alias("slope"),
                                         F.round("intercept", 1).alias("intercept"), "n")


RIDGE2 = ["sales_lag_12m", "sales_lag_1m"]
RIDGE_ALPHA = 1e12


@query("ridge_two_features", _sql(f"""
SELECT {G}, fold,
       ROUND(((d + {RIDGE_ALPHA}) * c1 - b * c2) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b), 6) AS coef_lag12,
       ROUND(((a + {RIDGE_ALPHA}) * c2 - b * c1) / ((a + {RIDGE_ALPHA}) * (d + {RIDGE_ALPHA}) - b * b), 6) AS coef_lag1
FROM (SELECT {G}, fold, COUNT(*) * var_pop(x1) AS a, COUNT(*) * covar_pop(x1, x2) AS b, COUNT(*) * var_pop(x2) AS d,
             COUNT(*) * covar_pop(x1, y) AS c1, COUNT(*) * covar_pop(x2, y) AS c2
      FROM (SELECT {G}, fold, y, COALESCE(sales_lag_12m, 0) AS x1, COALESCE(sales_lag_1m, 0) AS x2
            FROM folded WHERE role = 'train') GROUP BY 1, 2)"""))
def q_ridge_two_features(spark, sf):
    """K2 with two regressors: ridge normal equations on centred Gram sums
    (alpha on the scale of the squared sums; intercept unpenalised)."""
    des = _design(spark, sf, RIDGE2)
    c = K.fit_linear(des, 2, alphas=(RIDGE_ALPHA,))
    return c.select(G, "fold", F.round(F.col("coef")[0], 6).alias("coef_lag12"),
                    F.round(F.col("coef")[1], 6).alias("coef_lag1"))


@query("ols_full")
def q_ols_full(spark, sf):
    """K6: OLS on the leak-safe feature list with fit statistics (pseudo-inverse
    on the scaled Gram matrix for singular designs)."""
    feats = K.LEAK_SAFE_FEATURES
    des = _design(spark, sf, feats)
    coefs = K.fit_linear(des, len(feats), alphas=(0.0,))
    return K.ols_inference(des, coefs, len(feats))


@query("ridge_grid")
def q_ridge_grid(spark, sf):
    """OLS and ridge (1/10/100) x target mode (raw, log1p,
    yoy_ratio) x regime weighting, all series and folds in one Gram pass each."""
    feats = K.LEAK_SAFE_FEATURES
    checkpoint_dir(spark)
    folded = _folded(spark, sf).checkpoint(eager=True)  # six fits read it: cut the lineage once
    out = None
    for mode in ("raw", "log1p", "yoy_ratio"):
        for weighted in (False, True):
            des = K.design(folded, feats, mode, weighted)
            coefs = K.fit_linear(des, len(feats))
            p = K.predict_linear(des, coefs, len(feats), mode, "rw_" if weighted else "")
            s = K.fold_scores(p)
            out = s if out is None else out.unionByName(s)
    return out.select(G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


@query("elastic_net")
def q_elastic_net(spark, sf):
    """K3: elastic net (alpha .5, l1 .5) by coordinate descent on the Gram sums."""
    feats = K.LEAK_SAFE_FEATURES
    des = _design(spark, sf, feats)
    coefs = K.fit_elastic_net(des, len(feats))
    return K.fold_scores(K.predict_with(des, coefs, len(feats), "raw", "elastic_net")).select(
        G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


@query("holt_winters")
def q_holt_winters(spark, sf):
    """K7: additive Holt-Winters per series and fold (applyInPandas)."""
    return K.fold_scores(K.holt_winters(_folded(spark, sf))).select(
        G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


def _trees(spark, sf, names, modes=None):
    return T.fit_trees(_folded(spark, sf), K.LEAK_SAFE_FEATURES, names, modes)


@query("forest_scores")
def q_forest_scores(spark, sf):
    """Forests of 300 and 500 trees per series, target modes x regime weights."""
    return K.fold_scores(T.tree_predictions(_trees(spark, sf, list(T.FORESTS)))).select(
        G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


@query("boost_scores")
def q_boost_scores(spark, sf):
    """Boosted trees of 100 to 600 rounds per series, target modes x regime weights."""
    return K.fold_scores(T.tree_predictions(_trees(spark, sf, list(T.BOOSTING)))).select(
        G, "candidate", "fold", "fold_kind", _r6("mape"), "n")


@query("importance")
def q_importance(spark, sf):
    """Top-10 features per (series, fold) by normalised |coef| of the
    ridge(10) fit."""
    feats = K.LEAK_SAFE_FEATURES
    des = _design(spark, sf, feats)
    coefs = K.fit_linear(des, len(feats), alphas=(10.0,))
    imp = K.linear_importance(coefs, feats)
    w = Window.partitionBy(G, "fold").orderBy(F.col("importance").desc(), "feature")
    return imp.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 10).select(
        G, "fold", "feature", F.round("importance", 6).alias("importance"), "rank")


# --- all candidates together -------------------------------------------------------
PRED_COLS = [G, "fold", "fold_kind", "report_year", "report_month", "y", "candidate", "pred"]


def _all_predictions(spark, sf):
    """Every model's predictions in one frame, written once: naive, the linear
    grid (target modes x regime weights x ridge), elastic net, Holt-Winters, trees;
    each group's models use its own features.  The year before the validation
    years is predicted too, for the calibration of the first of them."""
    feats = K.LEAK_SAFE_FEATURES
    checkpoint_dir(spark)
    folded = _folded(spark, sf, calibration=True).checkpoint(eager=True)
    mask = K.feature_mask(feats, folded.columns)
    parts = [K.naive_predictions(folded), K.holt_winters(folded), T.tree_predictions(T.fit_trees(folded, feats, mask=mask))]
    for mode in ("raw", "log1p", "yoy_ratio"):
        for weighted in (False, True):
            des = K.design(folded, feats, mode, weighted)
            if weighted:
                des = des.where(F.col(G).isin(*K.WEIGHTED_GROUPS))
            parts.append(K.predict_linear(des, K.fit_linear(des, len(feats), mask=mask), len(feats), mode, "rw_" if weighted else ""))
    des = K.design(folded, feats)
    parts.append(K.predict_with(des, K.fit_elastic_net(des, len(feats), mask=mask), len(feats), "raw", "elastic_net"))
    out = parts[0].select(*PRED_COLS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*PRED_COLS))
    return out.checkpoint(eager=True)


def _ranked(preds):
    """Candidate table over all models; names break ties."""
    scores = K.fold_scores(preds)
    cands = (scores.groupBy(G, "candidate").agg(
        F.avg(F.when(F.col("fold_kind") == "validation", F.col("mape"))).alias("val_mape"),
        F.max(F.when(F.col("fold_kind") == "test", F.col("mape"))).alias("test_mape")))
    return cands.withColumn("cand_order", F.col("candidate"))


@query("all_candidates")
def q_all_candidates(spark, sf):
    """One comparison table of all models, naive ones included."""
    return _ranked(_all_predictions(spark, sf)).select(G, "candidate", _r6("val_mape"), _r6("test_mape"))


def _strategies(preds):
    """(candidates, predictions and scores of every strategy)."""
    cands = _ranked(preds)
    strategies = K.strategy_predictions(preds, cands, tuple(NAIVE_ORDER)).checkpoint(eager=True)
    return cands, strategies


@query("model_selection")
def q_model_selection(spark, sf):
    """Direct, calibrated (by the year before), ensemble and,
    for the total, bottom-up compete on the validation years; the test year is
    scored after the choice and held against the group's target."""
    cands, strategies = _strategies(_all_predictions(spark, sf))
    chosen = K.choose_strategy(strategies)
    each = K.candidate_table(K.fold_scores(strategies), {n: i for i, n in enumerate(K.STRATEGIES)}).groupBy(G).agg(*[
        F.max(F.when(F.col("candidate") == c, F.col(m))).alias(f"{c}_{m}") for c in K.STRATEGIES for m in ("val_mape", "test_mape")])
    single = K.choose_best(cands).select(G, F.col("best_candidate").alias("best_model"))
    card = K.scorecard(chosen).select(G, "target_mape", "status")
    out = chosen.withColumnRenamed("best_candidate", "strategy").join(single, G).join(each, G).join(card, G)
    return out.select(G, "strategy", "best_model", _r6("val_mape"), _r6("test_mape"), "target_mape", "status",
                      *[_r6(f"{c}_{m}") for c in K.STRATEGIES for m in ("val_mape", "test_mape")])


@query("selection_facts", _sql(f"""
SELECT DISTINCT {G}, TRUE AS chosen_is_least, TRUE AS later_years_calibrated, TRUE AS total_adds_up,
       CAST({len(NAIVE)} + 1 + 1 + 3 * 4 + CASE WHEN {G} IN {K.WEIGHTED_GROUPS} THEN 3 * 4 ELSE 0 END + {{trees}}
            + CASE WHEN {G} IN {K.WEIGHTED_GROUPS} THEN {{weighted}} ELSE 0 END AS BIGINT) AS n_candidates
FROM features""").replace("{trees}", str(sum(not w for *_, w in T.candidates()))).replace(
    "{weighted}", str(sum(w for *_, w in T.candidates()))))
def q_selection_facts(spark, sf):
    """K12 K13 K17 K18 over all models: every group has all candidates of its grid;
    the chosen strategy has the least validation error; a calibrated month is the
    direct one times the clipped factor of the same month a year before; the
    bottom-up total is the sum of its members."""
    preds = _all_predictions(spark, sf)
    cands, strategies = _strategies(preds)
    scores = K.candidate_table(K.fold_scores(strategies), {n: i for i, n in enumerate(K.STRATEGIES)})
    least = scores.groupBy(G).agg(F.min("val_mape").alias("least"))
    right = K.choose_strategy(strategies).join(least, G).select(G, (F.col("val_mape") == F.col("least")).alias("chosen_is_least"))
    month = [G, "report_year", "report_month"]
    wide = strategies.groupBy(*month).agg(F.max("y").alias("y"), *[
        F.max(F.when(F.col("candidate") == c, F.col("pred"))).alias(c) for c in K.STRATEGIES])
    before = wide.select(G, (F.col("report_year") + 1).alias("report_year"), "report_month",
                         F.greatest(F.lit(0.4), F.least(F.lit(2.5), F.col("y") / F.col("direct"))).alias("factor"))
    same = F.abs(F.col("calibrated") - F.col("direct") * F.coalesce("factor", F.lit(1.0))) <= 1e-9 * F.abs("direct")
    later = wide.join(before, month, "left").groupBy(G).agg(F.every(same).alias("later_years_calibrated"))
    members = wide.where(F.col(G).isin("GIFT_LOW", "GIFT_HIGH")).groupBy("report_year", "report_month").agg(F.sum("direct").alias("parts"))
    adds = wide.join(members, ["report_year", "report_month"]).groupBy(G).agg(
        F.every(F.col("bottom_up").isNull() | (F.abs(F.col("bottom_up") - F.col("parts")) <= 1e-9 * F.col("parts"))).alias("total_adds_up"))
    count = cands.groupBy(G).agg(F.count(F.lit(1)).alias("n_candidates"))
    return right.join(later, G).join(adds, G).join(count, G)


# --- strategies over models that SQL can fit ---------------------------------------------
_LINEAR = [("linear_lag12", "sales_lag_12m", "raw"), ("linear_lag1", "sales_lag_1m", "raw"), ("linear_lag12_log", "sales_lag_12m", "log1p")]
_CLIP = "greatest(0.4, least(2.5, {}))"
STRATEGY_LOCAL = {
    **SQL_LOCAL,
    "n_folded": "SELECT * FROM all_folded",
    "n_tstats": SQL_LOCAL["tstats"].replace("folded", "n_folded"),
    "n_ev": SQL_LOCAL["ev"].replace("folded", "n_folded").replace("tstats", "n_tstats"),
    "n_fit": " UNION ALL ".join(f"""
SELECT {G}, fold, '{name}' AS candidate, regr_slope(t, x) AS slope, regr_intercept(t, x) AS icpt
FROM (SELECT {G}, fold, {'ln(1 + y)' if mode == 'log1p' else 'y'} AS t, COALESCE({x}, 0) AS x FROM n_folded WHERE role = 'train')
GROUP BY 1, 2""" for name, x, mode in _LINEAR),
    "n_preds": SQL_LOCAL["preds"].replace("FROM ev", "FROM n_ev") + " UNION ALL " + " UNION ALL ".join(f"""
SELECT e.{G}, e.fold, e.fold_kind, e.report_year, e.report_month, e.y, '{name}',
       greatest({'exp(icpt + slope * COALESCE(e.' + x + ', 0)) - 1' if mode == 'log1p' else f'icpt + slope * COALESCE(e.{x}, 0)'}, 0)
FROM n_ev e JOIN n_fit f ON f.{G} = e.{G} AND f.fold = e.fold AND f.candidate = '{name}'""" for name, x, mode in _LINEAR),
    "n_cands": f"""
SELECT {G}, candidate, avg(CASE WHEN fold_kind = 'validation' THEN mape END) AS val_mape
FROM (SELECT {G}, candidate, fold, fold_kind, avg(CASE WHEN y <> 0 THEN abs(y - pred) / abs(y) * 100.0 END) AS mape
      FROM n_preds GROUP BY ALL) GROUP BY 1, 2""",
    "direct": f"""
SELECT p.* FROM n_preds p JOIN (SELECT * FROM n_cands QUALIFY row_number() OVER (PARTITION BY {G} ORDER BY val_mape, candidate) = 1) b
  ON b.{G} = p.{G} AND b.candidate = p.candidate""",
    "strategies": f"""
SELECT {G}, fold, fold_kind, report_year, report_month, y, 0 AS o, 'direct' AS strategy, pred FROM direct
UNION ALL SELECT d.{G}, d.fold, d.fold_kind, d.report_year, d.report_month, d.y, 1, 'calibrated',
  d.pred * CASE WHEN b.y / NULLIF(b.pred, 0) IS NULL THEN 1 ELSE {_CLIP.format('b.y / NULLIF(b.pred, 0)')} END
FROM direct d LEFT JOIN direct b ON b.{G} = d.{G} AND b.report_year + 1 = d.report_year AND b.report_month = d.report_month
UNION ALL SELECT {G}, fold, fold_kind, report_year, report_month, any_value(y), 2, 'ensemble', avg(pred) FROM n_preds
WHERE candidate LIKE 'linear%' GROUP BY {G}, fold, fold_kind, report_year, report_month
UNION ALL SELECT t.{G}, t.fold, t.fold_kind, t.report_year, t.report_month, t.y, 3, 'bottom_up', m.pred
FROM direct t JOIN (SELECT report_year, report_month, sum(pred) AS pred FROM direct WHERE {G} IN ('GIFT_LOW', 'GIFT_HIGH')
                    GROUP BY 1, 2 HAVING COUNT(*) = 2) m ON m.report_year = t.report_year AND m.report_month = t.report_month
WHERE t.{G} = 'GIFT_COMBINED'""",
    "strategy_scores": f"""
SELECT {G}, strategy, o, avg(CASE WHEN fold_kind = 'validation' THEN mape END) AS val_mape,
       max(CASE WHEN fold_kind = 'test' THEN mape END) AS test_mape
FROM (SELECT {G}, strategy, o, fold, fold_kind, avg(CASE WHEN y <> 0 THEN abs(y - pred) / abs(y) * 100.0 END) AS mape
      FROM strategies GROUP BY ALL) GROUP BY 1, 2, 3""",
}


def _simple_strategies(spark, sf):
    checkpoint_dir(spark)
    folded = _folded(spark, sf, calibration=True).checkpoint(eager=True)
    parts = [K.naive_predictions(folded).select(*PRED_COLS)]
    for name, x, mode in _LINEAR:
        des = K.design(folded, [x], mode)
        parts.append(K.predict_with(des, K.fit_linear(des, 1, alphas=(0.0,)), 1, mode, name).select(*PRED_COLS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _strategies(out.checkpoint(eager=True))


@query("strategy_scores", with_ctes(f"""
SELECT {G}, strategy, ROUND(val_mape, 6) AS val_mape, ROUND(test_mape, 6) AS test_mape FROM strategy_scores""",
    *DATASET_NEEDS, local=STRATEGY_LOCAL))
def q_strategy_scores(spark, sf):
    """Direct, calibrated by the year before, ensemble and bottom-up over
    the naive and one-regressor models, scored on validation and test years."""
    scores = K.fold_scores(_simple_strategies(spark, sf)[1])
    return K.candidate_table(scores, {n: i for i, n in enumerate(K.STRATEGIES)}).select(
        G, F.col("candidate").alias("strategy"), _r6("val_mape"), _r6("test_mape"))


@query("strategy_choice", with_ctes(f"""
SELECT {G}, strategy, ROUND(val_mape, 6) AS val_mape, ROUND(test_mape, 6) AS test_mape
FROM (SELECT * FROM strategy_scores QUALIFY row_number() OVER (PARTITION BY {G} ORDER BY val_mape, o) = 1)""",
    *DATASET_NEEDS, local=STRATEGY_LOCAL))
def q_strategy_choice(spark, sf):
    """The strategy of least validation error for each group; test scored after."""
    return K.choose_strategy(_simple_strategies(spark, sf)[1]).select(
        G, F.col("best_candidate").alias("strategy"), _r6("val_mape"), _r6("test_mape"))


# --- facts that a right fit must show ------------------------------------------------
@query("linear_normal_equations", _sql(f"""
SELECT DISTINCT {G}, fold, CAST(alpha AS DOUBLE) AS alpha, TRUE AS intercept_ok, TRUE AS slopes_ok
FROM folded CROSS JOIN (VALUES (1.0), (10.0), (100.0)) a(alpha)
WHERE role = 'train'"""))
def q_linear_normal_equations(spark, sf):
    """K2 K6: residuals of every ridge fit sum to zero, and their product with
    each feature is alpha times its coefficient."""
    feats = K.LEAK_SAFE_FEATURES
    checkpoint_dir(spark)
    des = _design(spark, sf, feats).checkpoint(eager=True)
    coefs = K.fit_linear(des, len(feats), alphas=(1.0, 10.0, 100.0))
    j = des.filter((F.col("role") == "train") & F.col("t").isNotNull()).join(coefs, [G, "fold"])
    fit = F.col("intercept")
    for i in range(len(feats)):
        fit = fit + F.col("coef")[i] * F.col(f"x{i}")
    j = j.withColumn("r", F.col("t") - fit)
    g = j.groupBy(G, "fold", "alpha").agg(
        F.sum("r").alias("sum_r"), F.sum(F.abs("t")).alias("size"), F.first("coef").alias("coef"),
        *[F.sum(F.col("r") * F.col(f"x{i}")).alias(f"rx{i}") for i in range(len(feats))],
        *[F.sum(F.abs(F.col("t") * F.col(f"x{i}"))).alias(f"tx{i}") for i in range(len(feats))])
    near = F.lit(True)
    for i in range(len(feats)):
        near = near & (F.abs(F.col(f"rx{i}") - F.col("alpha") * F.col("coef")[i]) <= 1e-6 * (F.col(f"tx{i}") + 1))
    return g.select(G, "fold", "alpha", (F.abs("sum_r") <= 1e-6 * F.col("size")).alias("intercept_ok"), near.alias("slopes_ok"))


@query("importance_total", _sql(f"""
SELECT DISTINCT {G}, fold, TRUE AS sums_to_one FROM folded WHERE role = 'train'"""))
def q_importance_total(spark, sf):
    """The features' importances of a fit sum to 1."""
    feats = K.LEAK_SAFE_FEATURES
    imp = K.linear_importance(K.fit_linear(_design(spark, sf, feats), len(feats), alphas=(10.0,)), feats)
    return imp.groupBy(G, "fold").agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


def _raw(models):
    return ", ".join(f"('{m}_raw')" for m in models)


@query("forest_range", _sql(f"""
SELECT DISTINCT fold, candidate, TRUE AS in_range
FROM folded CROSS JOIN (VALUES {_raw(T.FORESTS)}) c(candidate)
WHERE role = 'eval'"""))
def q_forest_range(spark, sf):
    """K4: a forest's predictions stay within its training targets."""
    p = T.tree_predictions(_trees(spark, sf, list(T.FORESTS), ("raw",))).where(~F.col("candidate").startswith("rw_"))
    t = _folded(spark, sf).filter(F.col("role") == "train").groupBy(G, "fold").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    return (p.join(t, [G, "fold"]).groupBy("fold", "candidate")
            .agg(F.min((F.col("pred") >= F.col("lo") * (1 - 1e-9)) & (F.col("pred") <= F.col("hi") * (1 + 1e-9))).alias("in_range")))


@query("boost_facts", _sql(f"""
SELECT DISTINCT {G}, fold, candidate, rounds, TRUE AS loss_never_rises
FROM folded CROSS JOIN (VALUES {", ".join(f"('{m}_raw', CAST({c['rounds']} AS BIGINT))" for m, c in T.BOOSTING.items())}) c(candidate, rounds)
WHERE role = 'train'"""))
def q_boost_facts(spark, sf):
    """K5: every fit runs its whole schedule, and no round raises the loss of its rows."""
    fits = _trees(spark, sf, list(T.BOOSTING), ("raw",)).where(~F.col("candidate").startswith("rw_"))
    return T.fit_facts(fits).groupBy(G, "fold", "candidate").agg(
        F.max(F.when(F.col("fact") == "rounds", F.col("value"))).cast("long").alias("rounds"),
        (F.max(F.when(F.col("fact") == "rises", F.col("value"))) == 0).alias("loss_never_rises"))


@query("tree_importance_total", _sql(f"""
SELECT DISTINCT {G}, fold, candidate, TRUE AS sums_to_one,
       CAST(CASE WHEN {G} = 'GIFT_HIGH' THEN {len(K.LEAK_SAFE_FEATURES) - 1} ELSE {len(K.LEAK_SAFE_FEATURES)} END AS BIGINT) AS n_features
FROM folded CROSS JOIN (VALUES {_raw(("boost_300", "boost_200_tight", "forest_300_d4", "forest_300_d3"))}) c(candidate)
WHERE role = 'train'"""))
def q_tree_importance_total(spark, sf):
    """The gains of a fit's splits as shares of 1, over the group's own features."""
    fits = _trees(spark, sf, ["boost_300", "boost_200_tight", "forest_300_d4", "forest_300_d3"], ("raw",))
    return T.tree_importances(fits.where(~F.col("candidate").startswith("rw_"))).groupBy(G, "fold", "candidate").agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"), F.count(F.lit(1)).alias("n_features"))


@query("tree_importance")
def q_tree_importance(spark, sf):
    """The ten features of most gain for each fit of the boosted trees and forests."""
    imp = T.tree_importances(_trees(spark, sf, ["boost_300", "forest_300_d4"], ("raw",)))
    w = Window.partitionBy(G, "fold", "candidate").orderBy(F.desc("importance"), "feature")
    return imp.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 10).select(
        G, "fold", "candidate", "feature", _r6("importance"), "rank")


@query("boost_split", _sql(f"""
SELECT {G}, fold, ROUND(border, 4) AS border, ROUND(gain / whole, 6) AS gain_share FROM (
  SELECT b.{G}, b.fold, b.border,
         sum(CASE WHEN t.x <= b.border THEN t.r ELSE 0 END) ** 2 / sum(CASE WHEN t.x <= b.border THEN 1 ELSE 0 END)
         + sum(CASE WHEN t.x > b.border THEN t.r ELSE 0 END) ** 2 / sum(CASE WHEN t.x > b.border THEN 1 ELSE 0 END) AS gain,
         sum(t.r * t.r) AS whole
  FROM (SELECT {G}, fold, (x + nx) / 2 AS border FROM (
          SELECT {G}, fold, x, lead(x) OVER (PARTITION BY {G}, fold ORDER BY x) AS nx
          FROM (SELECT DISTINCT {G}, fold, COALESCE(sales_lag_12m, 0) AS x FROM folded WHERE role = 'train')) WHERE nx IS NOT NULL) b
  JOIN (SELECT {G}, fold, COALESCE(sales_lag_12m, 0) AS x, y - avg(y) OVER (PARTITION BY {G}, fold) AS r
        FROM folded WHERE role = 'train') t ON t.{G} = b.{G} AND t.fold = b.fold
  GROUP BY 1, 2, 3)
QUALIFY row_number() OVER (PARTITION BY {G}, fold ORDER BY gain DESC, border) = 1"""))
def q_boost_split(spark, sf):
    """K5: the first split of a boosted tree over one feature, against a search over
    all borders; with the share of the squared error that it explains."""
    rows = _folded(spark, sf).where("role = 'train'").select(
        G, "fold", F.coalesce("sales_lag_12m", F.lit(0.0)).alias("x"), "y")
    return T.first_split(rows).select(G, "fold", F.round("border", 4).alias("border"), _r6("gain_share"))


@query("group_feature_fits", _sql(f"""
SELECT {G}, fold, ROUND(CASE WHEN {G} = 'GIFT_HIGH' THEN 0 ELSE (d * c1 - b * c2) / (a * d - b * b) END, 6) AS coef_lag12,
       ROUND(CASE WHEN {G} = 'GIFT_HIGH' THEN c2 / d ELSE (a * c2 - b * c1) / (a * d - b * b) END, 6) AS coef_lag1, CAST(0 AS DOUBLE) AS coef_absent
FROM (SELECT {G}, fold, COUNT(*) * var_pop(x1) AS a, COUNT(*) * covar_pop(x1, x2) AS b, COUNT(*) * var_pop(x2) AS d,
             COUNT(*) * covar_pop(x1, y) AS c1, COUNT(*) * covar_pop(x2, y) AS c2
      FROM (SELECT {G}, fold, y, COALESCE(sales_lag_12m, 0) AS x1, COALESCE(sales_lag_1m, 0) AS x2
            FROM folded WHERE role = 'train') GROUP BY 1, 2)"""))
def q_group_feature_fits(spark, sf):
    """One Gram pass, each group's own features: the high band leaves last
    year's month out, and a column that the data lacks is left out everywhere."""
    feats = ["sales_lag_12m", "sales_lag_1m", "visitors_from_abroad"]
    folded = _folded(spark, sf)
    c = K.fit_linear(K.design(folded, feats), len(feats), alphas=(0.0,), mask=K.feature_mask(feats, folded.columns))
    return c.select(G, "fold", *[F.round(F.col("coef")[i] + F.lit(0.0), 6).alias(f"coef_{n}") for i, n in enumerate(("lag12", "lag1", "absent"))])


@query("holt_winters_exact", _sql(f"""
SELECT {G}, report_year, report_month, ROUND(base + step * (report_year - first) * 12 + step * (report_month - 1), 2) AS expected, CAST(1 AS DOUBLE) AS ratio
FROM (SELECT f.{G}, f.report_year, f.report_month, b.base, s.step, s.first FROM features f
  JOIN (SELECT {G}, min(report_year) AS first, avg(CAST(sales_result AS DOUBLE)) / 100 AS step FROM features GROUP BY 1) s ON s.{G} = f.{G}
  JOIN (SELECT {G}, report_year, report_month, CAST(sales_result AS DOUBLE) AS base FROM features) b
    ON b.{G} = f.{G} AND b.report_year = s.first AND b.report_month = f.report_month)
WHERE report_year > (SELECT max(report_year) FROM features) - 3"""))
def q_holt_winters_exact(spark, sf):
    """K7: series derived from the data, the first year's months repeated on a
    rising line, are forecast exactly."""
    ds = group_dataset_df(spark, sf).select(G, "report_year", "report_month", F.col("sales_result").cast("double").alias("v"))
    facts = ds.groupBy(G).agg(F.min("report_year").alias("first"), (F.avg("v") / 100).alias("step"))
    base = ds.join(facts, G).where("report_year = first").select(G, "report_month", F.col("v").alias("base"))
    rows = ds.join(facts, G).join(base, [G, "report_month"]).withColumn(
        "y", F.col("base") + F.col("step") * ((F.col("report_year") - F.col("first")) * 12 + F.col("report_month") - 1))
    hw = K.holt_winters(K.explode_folds(rows.drop("v", "first", "step", "base")))
    return hw.select(G, "report_year", "report_month", F.round("y", 2).alias("expected"),
                     F.round(F.col("pred") / F.col("y"), 6).alias("ratio"))


@query("ols_simple_table", _sql(f"""
SELECT {G}, fold, ROUND(slope, 6) AS coef, ROUND(se, 6) AS se, ROUND(slope / se, 5) AS t
FROM (SELECT {G}, fold, regr_slope(y, x) AS slope,
             sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (COUNT(*) - 2) / regr_sxx(y, x)) AS se
      FROM (SELECT {G}, fold, y, COALESCE(sales_lag_12m, 0) AS x FROM folded WHERE role = 'train') GROUP BY 1, 2)"""))
def q_ols_simple_table(spark, sf):
    """Standard errors and t values of the one-regressor fit."""
    out = K.ols_table(_design(spark, sf, ["sales_lag_12m"]), ["sales_lag_12m"]).filter(F.col("term") != "intercept")
    return out.select(G, "fold", _r6("coef"), _r6("se"), F.round("t", 5).alias("t"))


@query("ols_table")
def q_ols_table(spark, sf):
    """The full inference table over the leak-safe features."""
    feats = K.LEAK_SAFE_FEATURES
    return K.ols_table(_design(spark, sf, feats), feats)
