"""Grouped forecasting with honest walk-forward scoring.

Data model: the feature frame (one row per series x month) is exploded into
folds by an array expression (no join): for fold ``v`` rows with year < v
train and rows with year = v are scored.  Every candidate model produces a
long prediction frame (series, fold, candidate, year, month, y, pred); MAPE,
selection, ensembling, hierarchy and calibration are aggregations over it.
Selection uses the validation folds only — the test fold is scored after the
choice (no test-set peeking).

Fitting: naive models are window/aggregate expressions; linear models use a
grouped Gram-matrix aggregation (sums of x_i x_j per series x fold x alpha in
one pass) and a k x k numpy solve per row in ``mapInPandas``; Holt-Winters is
a per-series recursion in ``applyInPandas``; trees are in ``trees``.  Series are bounded (one row per
month), so no group can grow with the fact data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import clip
from salesmart.operators import smoothing

SERIES = "canonical_group"
# MAPE targets per group (percent) for the scorecard
MAPE_TARGETS = {"GIFT_LOW": 20.0, "GIFT_HIGH": 18.0, "GIFT_COMBINED": 15.0, "GIFT_LARGE": 25.0}
# Weights of training rows by how many years they lie before the
# newest year (the test year), default 1, LOW/HIGH only
REGIME_WEIGHTS = {1: 4.0, 2: 2.0}
WEIGHTED_GROUPS = ("GIFT_LOW", "GIFT_HIGH")
# Leak-safe default feature list (no same-month composition or YoY)
LEAK_SAFE_FEATURES = ["sales_lag_1m", "sales_lag_3m", "sales_lag_12m", "sales_rolling_3m_mean",
                      "month_sin", "month_cos", "is_peak_month", "has_lunar_new_year",
                      "lead_1_lunar_new_year", "has_mid_autumn", "lead_1_mid_autumn", "working_days",
                      "year_in_regime"]
# Features that a group's models leave out (B19): everything made from last year's
# month, which a moved threshold makes misleading for the high band
GROUP_EXCLUDES = {"GIFT_HIGH": ("sales_lag_12m", "trend_yoy_adj", "yoy_estimate", "comp_x_lag12")}


# ---------------------------------------------------------------------------
# Folds (K14, B21)
# ---------------------------------------------------------------------------
def fold_specs(feat: DataFrame, validation: int = 2, calibration: bool = False) -> list[tuple[str, int, str]]:
    """(fold, scored year, kind) from the years of the data: the newest year is
    the test fold, the ``validation`` years before it are validation folds and,
    if asked, the year before those is a calibration fold."""
    last = feat.agg(F.max("report_year")).first()[0]
    if last is None:
        return []
    first = last - validation
    return ([(f"calib_{first - 1}", first - 1, "calibration")] if calibration else []) + \
        [(f"val_{y}", y, "validation") for y in range(first, last)] + [(f"test_{last}", last, "test")]


def explode_folds(feat: DataFrame, specs=None, calibration: bool = False) -> DataFrame:
    """Each row joins every fold whose eval year is >= its year: role 'train'
    when year < eval year, 'eval' when equal.  Expression-only (no join); every
    row belongs to a fold, as the newest year is one.  ``last_year`` is that year."""
    specs = specs or fold_specs(feat, calibration=calibration)
    kind = "array<struct<fold: string, eval_year: int, fold_kind: string>>"
    arr = F.array(*[F.struct(F.lit(n).alias("fold"), F.lit(y).alias("eval_year"), F.lit(k).alias("fold_kind"))
                    for n, y, k in specs]) if specs else F.array().cast(kind)
    mine = F.filter(arr, lambda s: s["eval_year"] >= F.col("report_year"))
    return (feat.withColumn("_f", F.explode(mine)).select("*", "_f.*").drop("_f")
            .withColumn("role", F.when(F.col("report_year") < F.col("eval_year"), "train").otherwise("eval"))
            .withColumn("last_year", F.lit(max((y for _, y, _ in specs), default=None)).cast("int")))


def regime_weight() -> Column:
    """A training row's weight by its distance from the newest year."""
    w = F.lit(1.0)
    for years, weight in REGIME_WEIGHTS.items():
        w = F.when(F.col("last_year") - F.col("report_year") == years, F.lit(weight)).otherwise(w)
    return F.when(F.col(SERIES).isin(*WEIGHTED_GROUPS), w).otherwise(F.lit(1.0))


# ---------------------------------------------------------------------------
# Feature lists of groups
# ---------------------------------------------------------------------------
def feature_mask(features, available, excludes=None) -> Column:
    """Which of ``features`` a series' models use, as an array of booleans: those
    that the frame has and the series does not leave out."""
    excludes = GROUP_EXCLUDES if excludes is None else excludes
    def mask(out):
        return F.array(*[F.lit(f in available and f not in out) for f in features])
    expr = mask(())
    for series, out in excludes.items():
        expr = F.when(F.col(SERIES) == series, mask(out)).otherwise(expr)
    return expr


# ---------------------------------------------------------------------------
# Naive baselines
# ---------------------------------------------------------------------------
def train_stats(folded: DataFrame) -> DataFrame:
    """Per (series, fold) over training rows: median (D8) and the trend factor
    D21 = mean(last 12) / (mean(previous 12) + 1e-9), clipped to [0.8, 1.3]."""
    tr = folded.filter(F.col("role") == "train")
    w = Window.partitionBy(SERIES, "fold").orderBy(F.col("report_year").desc(), F.col("report_month").desc())
    tr = tr.withColumn("_rk", F.row_number().over(w))
    y = F.col("y")
    g = tr.groupBy(SERIES, "fold").agg(
        F.median(y).alias("train_median"),
        F.avg(F.when(F.col("_rk") <= 12, y)).alias("_last12"),
        F.avg(F.when((F.col("_rk") > 12) & (F.col("_rk") <= 24), y)).alias("_prev12"),
        F.avg(y).alias("train_mean"))
    return g.select(SERIES, "fold", "train_median", "train_mean",
                    clip(F.col("_last12") / (F.col("_prev12") + 1e-9), 0.8, 1.3).alias("trend_factor"))


def naive_predictions(folded: DataFrame) -> DataFrame:
    """Eval-row predictions of the naive candidates:
    seasonal_naive_v1 = lag12 -> lag3 -> lag1 -> train median;
    seasonal_naive_v2 = lag12 -> rolling 6 -> train median;
    trend_naive = (lag12 -> train median) x trend factor."""
    st = train_stats(folded)
    ev = folded.filter(F.col("role") == "eval").join(st, [SERIES, "fold"], "left")
    preds = {
        "seasonal_naive_v1": F.coalesce("sales_lag_12m", "sales_lag_3m", "sales_lag_1m", "train_median"),
        "seasonal_naive_v2": F.coalesce("sales_lag_12m", "sales_rolling_6m_mean", "train_median"),
        "trend_naive": F.coalesce("sales_lag_12m", "train_median") * F.col("trend_factor"),
    }
    arr = F.array(*[F.struct(F.lit(k).alias("candidate"), v.cast("double").alias("pred")) for k, v in preds.items()])
    return (ev.select(SERIES, "fold", "fold_kind", "report_year", "report_month", "y", F.explode(arr).alias("p"))
            .select(SERIES, "fold", "fold_kind", "report_year", "report_month", "y", "p.candidate",
                    F.greatest(F.col("p.pred"), F.lit(0.0)).alias("pred")))


# ---------------------------------------------------------------------------
# Scoring and selection
# ---------------------------------------------------------------------------
def mape_agg(y="y", p="pred"):
    """D16 (v2): mean |y-p|/|y| x 100 over rows with y != 0 and finite values."""
    ok = (F.col(y) != 0) & F.col(y).isNotNull() & F.col(p).isNotNull() & ~F.isnan(F.col(p))
    return F.avg(F.when(ok, F.abs(F.col(y) - F.col(p)) / F.abs(F.col(y)) * 100.0))


def fold_scores(preds: DataFrame) -> DataFrame:
    """(series, candidate, fold, fold_kind, mape, n) — unrounded; round at output."""
    return (preds.groupBy(SERIES, "candidate", "fold", "fold_kind")
            .agg(mape_agg().alias("mape"), F.count(F.lit(1)).alias("n")))


def candidate_table(scores: DataFrame, order: dict[str, int]) -> DataFrame:
    """Per (series, candidate): mean validation MAPE (NULL/inf when no fold)
    and the test MAPE, with the candidate's grid order for tie-breaks."""
    order_col = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    g = scores.groupBy(SERIES, "candidate").agg(
        F.avg(F.when(F.col("fold_kind") == "validation", F.col("mape"))).alias("val_mape"),
        F.max(F.when(F.col("fold_kind") == "test", F.col("mape"))).alias("test_mape"))
    return g.withColumn("cand_order", order_col[F.col("candidate")])


def choose_best(cands: DataFrame) -> DataFrame:
    """Lowest validation MAPE; the earlier candidate wins ties."""
    ok = cands.filter(F.col("val_mape").isNotNull())
    return (ok.groupBy(SERIES)
            .agg(F.min_by(F.struct("candidate", "val_mape", "test_mape"),
                          F.struct("val_mape", "cand_order")).alias("b"))
            .select(SERIES, F.col("b.candidate").alias("best_candidate"),
                    F.col("b.val_mape").alias("val_mape"), F.col("b.test_mape").alias("test_mape")))


def top_k(cands: DataFrame, k: int = 3, exclude=()) -> DataFrame:
    """best k by validation MAPE per series (excluded names and NULL scores dropped)."""
    w = Window.partitionBy(SERIES).orderBy("val_mape", "cand_order")
    c = cands.filter(F.col("val_mape").isNotNull() & ~F.col("candidate").isin(*exclude)) if exclude else \
        cands.filter(F.col("val_mape").isNotNull())
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def ensemble(preds: DataFrame, top: DataFrame, name: str = "ensemble_top3") -> DataFrame:
    """Mean prediction of the top candidates per (series, fold, month)."""
    j = preds.join(top.select(SERIES, "candidate"), [SERIES, "candidate"], "left_semi")
    return (j.groupBy(SERIES, "fold", "fold_kind", "report_year", "report_month")
            .agg(F.first("y").alias("y"), F.avg("pred").alias("pred"))
            .withColumn("candidate", F.lit(name)))


def bottom_up(best_preds: DataFrame, members=("GIFT_LOW", "GIFT_HIGH"), total="GIFT_COMBINED") -> DataFrame:
    """Sum of the members' chosen predictions as a candidate for the total."""
    m = best_preds.filter(F.col(SERIES).isin(*members))
    t = best_preds.filter(F.col(SERIES) == total).select("fold", "report_year", "report_month", "y")
    s = m.groupBy("fold", "fold_kind", "report_year", "report_month").agg(
        F.sum("pred").alias("pred"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(members)).drop("_n")
    return (s.join(t, ["fold", "report_year", "report_month"])
            .withColumn(SERIES, F.lit(total)).withColumn("candidate", F.lit("bottom_up")))


def month_bias(preds: DataFrame, lo: float = 0.4, hi: float = 2.5) -> DataFrame:
    """Per (series, candidate, scored year, calendar month) the factor actual /
    pred of that year, clipped; 1 where undefined."""
    f = F.try_divide(F.col("y"), F.col("pred"))
    return preds.select(SERIES, "candidate", "report_year", "report_month",
                        F.coalesce(clip(f, lo, hi), F.lit(1.0)).alias("bias_factor"))


def calibrate(preds: DataFrame, lo: float = 0.4, hi: float = 2.5) -> DataFrame:
    """K18, nested: the predictions of a year times the factors of the year before
    it, so that no year's factors come from the year that they are scored on.
    A year without one before it keeps its predictions."""
    bias = month_bias(preds, lo, hi).withColumn("report_year", F.col("report_year") + 1)
    return (preds.join(bias, [SERIES, "candidate", "report_year", "report_month"], "left")
            .withColumn("pred", F.col("pred") * F.coalesce("bias_factor", F.lit(1.0))).drop("bias_factor"))


STRATEGIES = ("direct", "calibrated", "ensemble", "bottom_up")


def strategy_predictions(preds: DataFrame, cands: DataFrame, exclude=(), k: int = 3) -> DataFrame:
    """The predictions of every strategy, named in ``candidate``: the best single
    model, that model calibrated by the year before, the mean of the ``k`` best
    models without baselines, and for the total the sum of the members' best."""
    best = choose_best(cands).select(SERIES, F.col("best_candidate").alias("candidate"))
    direct = preds.join(best, [SERIES, "candidate"], "left_semi")
    cols = [SERIES, "fold", "fold_kind", "report_year", "report_month", "y", "candidate", "pred"]
    parts = [direct, calibrate(direct), ensemble(preds, top_k(cands, k, exclude)), bottom_up(direct)]
    out = None
    for name, p in zip(STRATEGIES, parts):
        p = p.withColumn("candidate", F.lit(name)).select(*cols)
        out = p if out is None else out.unionByName(p)
    return out


def choose_strategy(strategies: DataFrame) -> DataFrame:
    """The strategy of least mean validation error for each series, ties to
    the simpler one; the test error is scored after the choice."""
    return choose_best(candidate_table(fold_scores(strategies), {n: i for i, n in enumerate(STRATEGIES)}))


def month_errors(preds: DataFrame) -> DataFrame:
    """Actual, prediction and |a - p| / max(|a|, 1) x 100 per month."""
    return preds.withColumn("error_pct", F.round(
        F.abs(F.col("y") - F.col("pred")) / F.greatest(F.abs("y"), F.lit(1.0)) * 100, 4))


def peak_hit_rate(preds: DataFrame, k: int = 3) -> DataFrame:
    """|top-k months by prediction  intersect  top-k by actual| / k per (series, fold)."""
    wa = Window.partitionBy(SERIES, "fold").orderBy(F.col("y").desc(), "report_month")
    wp = Window.partitionBy(SERIES, "fold").orderBy(F.col("pred").desc(), "report_month")
    r = preds.withColumn("ra", F.row_number().over(wa)).withColumn("rp", F.row_number().over(wp))
    return (r.groupBy(SERIES, "fold")
            .agg(F.count_if((F.col("ra") <= k) & (F.col("rp") <= k)).alias("hits"))
            .withColumn("hit_rate", F.round(F.col("hits") / k, 6)))


def scorecard(best: DataFrame, targets=MAPE_TARGETS) -> DataFrame:
    """Test MAPE of the chosen model vs the group's target."""
    tgt = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(v))])
    return best.select(SERIES, "best_candidate", "test_mape", tgt[F.col(SERIES)].alias("target_mape")) \
        .withColumn("status", F.when(F.col("test_mape") <= F.col("target_mape"), "OK")
                    .when(F.col("target_mape").isNotNull(), "NG"))


# ---------------------------------------------------------------------------
# Linear models by grouped Gram aggregation
# ---------------------------------------------------------------------------
def design(folded: DataFrame, features, target_mode: str = "raw", weighted: bool = False) -> DataFrame:
    """Rows (series, fold, role, x..., t, w): features imputed with 0 (v2), the
    target transformed (raw | log1p | yoy_ratio, K10) and regime weights (K11).
    A feature that the frame lacks is a column of zeros (B19)."""
    xs = [(F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in folded.columns else F.lit(0.0)).alias(f"x{i}")
          for i, f in enumerate(features)]
    y = F.col("y")
    lag = F.col("sales_lag_12m")
    if target_mode == "raw":
        t = y
    elif target_mode == "log1p":
        t = F.log1p(y)
    elif target_mode == "yoy_ratio":
        # non-positive lag -> training mean (not the evaluation mean, T20)
        t = F.log(F.greatest(y, F.lit(1.0)) / F.col("_safe_lag"))
    else:
        raise ValueError(target_mode)
    w = regime_weight() if weighted else F.lit(1.0)
    base = folded
    if target_mode == "yoy_ratio":
        tm = (folded.filter(F.col("role") == "train").groupBy(SERIES, "fold")
              .agg(F.avg("y").alias("_train_mean")))
        base = folded.join(tm, [SERIES, "fold"], "left").withColumn(
            "_safe_lag", F.when(F.coalesce(lag, F.lit(1.0)) > 0, F.coalesce(lag, F.lit(1.0)))
            .otherwise(F.col("_train_mean")))
    cols = [SERIES, "fold", "fold_kind", "role", "report_year", "report_month", "y", *xs,
            t.alias("t"), w.alias("w")]
    if target_mode == "yoy_ratio":
        cols.append(F.col("_safe_lag").alias("safe_lag"))
    return base.select(*cols)


def gram(des: DataFrame, k: int) -> DataFrame:
    """One aggregation: weighted sums n, Sx_i, Sx_ix_j (i <= j), Sx_i t, St, St^2
    per (series, fold) over training rows that have a target."""
    tr = des.filter((F.col("role") == "train") & F.col("t").isNotNull())
    w = F.col("w")
    aggs = [F.sum(w).alias("sw"), F.count(F.lit(1)).alias("n"), F.sum(w * F.col("t")).alias("st"),
            F.sum(w * F.col("t") * F.col("t")).alias("stt")]
    aggs += [F.sum(w * F.col(f"x{i}")).alias(f"sx{i}") for i in range(k)]
    aggs += [F.sum(w * F.col(f"x{i}") * F.col("t")).alias(f"sxt{i}") for i in range(k)]
    aggs += [F.sum(w * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"sxx{i}_{j}") for i in range(k) for j in range(i, k)]
    return tr.groupBy(SERIES, "fold").agg(*aggs)


def _centred(r, k: int) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray]:
    """(weight, feature means, target mean, centred X'X, centred X't) of a Gram row."""
    sw = r["sw"]
    mx = np.array([r[f"sx{i}"] for i in range(k)]) / sw
    mt = r["st"] / sw
    sxx = np.array([[r[f"sxx{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
    sxt = np.array([r[f"sxt{i}"] for i in range(k)])
    return sw, mx, mt, sxx - sw * np.outer(mx, mx), sxt - sw * mx * mt


def _solve_rows(pdf: pd.DataFrame, k: int, alphas) -> pd.DataFrame:
    """Ridge (alpha > 0) / OLS (alpha = 0, pseudo-inverse) from centred Gram sums;
    the intercept is not penalised (as sklearn Ridge).  Features that the row's
    ``mask`` leaves out have the coefficient 0: the submatrix is solved."""
    out = []
    for _, r in pdf.iterrows():
        sw, mx, mt, cxx, cxt = _centred(r, k)
        on = np.flatnonzero(np.asarray(r["mask"], bool)) if "mask" in r and r["mask"] is not None else np.arange(k)
        sub, rhs = cxx[np.ix_(on, on)], cxt[on]
        for a in alphas:
            beta = np.zeros(k)
            if a > 0:
                beta[on] = np.linalg.solve(sub + a * np.eye(len(on)), rhs)
            elif len(on):
                scale = np.sqrt(np.maximum(np.diag(sub), 1e-300))
                beta[on] = (np.linalg.pinv(sub / np.outer(scale, scale), rcond=1e-10) @ (rhs / scale)) / scale
            out.append({SERIES: r[SERIES], "fold": r["fold"], "alpha": float(a),
                        "intercept": float(mt - mx @ beta), "coef": [float(v) for v in beta]})
    return pd.DataFrame(out, columns=[SERIES, "fold", "alpha", "intercept", "coef"])


def fit_linear(des: DataFrame, k: int, alphas=(0.0, 1.0, 10.0, 100.0), mask: Column | None = None) -> DataFrame:
    """Coefficients per (series, fold, alpha): Gram aggregation in Spark, the
    k x k solve per row in mapInPandas (rows are independent).  ``mask`` (see
    ``feature_mask``) gives each series its own features over the one Gram pass."""
    g = gram(des, k)
    if mask is not None:
        g = g.withColumn("mask", mask)
    schema = f"{SERIES} string, fold string, alpha double, intercept double, coef array<double>"

    def run(it):
        for pdf in it:
            yield _solve_rows(pdf, k, alphas)
    return g.mapInPandas(run, schema)


def predict_linear(des: DataFrame, coefs: DataFrame, k: int, target_mode: str, name_prefix: str) -> DataFrame:
    """Eval-row predictions, inverse-transformed (K10), floored at 0."""
    ev = des.filter(F.col("role") == "eval").join(coefs, [SERIES, "fold"])
    raw = F.col("intercept")
    for i in range(k):
        raw = raw + F.col("coef")[i] * F.col(f"x{i}")
    if target_mode == "raw":
        p = raw
    elif target_mode == "log1p":
        p = F.expm1(raw)
    else:
        p = F.exp(raw) * F.col("safe_lag")
    name = F.concat(F.lit(name_prefix), F.when(F.col("alpha") == 0, F.lit("ols"))
                    .otherwise(F.concat(F.lit("ridge"), F.col("alpha").cast("int").cast("string"))),
                    F.lit("_" + target_mode))
    return ev.select(SERIES, "fold", "fold_kind", "report_year", "report_month", "y", name.alias("candidate"),
                     F.greatest(p, F.lit(0.0)).alias("pred"))


def linear_importance(coefs: DataFrame, features) -> DataFrame:
    """|coef| / sum |coef| per (series, fold, alpha) as (feature, importance) rows."""
    names = F.array(*[F.lit(f) for f in features])
    z = coefs.select(SERIES, "fold", "alpha", F.arrays_zip(names.alias("feature"), F.col("coef").alias("c"))
                     .alias("z"), F.aggregate("coef", F.lit(0.0), lambda acc, x: acc + F.abs(x)).alias("tot"))
    e = z.select(SERIES, "fold", "alpha", "tot", F.explode("z").alias("e"))
    return e.select(SERIES, "fold", "alpha", F.col("e.feature").alias("feature"),
                    F.when(F.col("tot") > 0, F.abs(F.col("e.c")) / F.col("tot")).otherwise(F.lit(0.0))
                    .alias("importance"))


# ---------------------------------------------------------------------------
# OLS with inference (K6)
# ---------------------------------------------------------------------------
def _beta_tail(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(1.0 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, f = 1.0, 0.0, 1.0
    for i in range(400):
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / max(1.0 + num * d, 1e-300) if 1.0 + num * d > 0 else 1.0 / min(1.0 + num * d, -1e-300)
        c = 1.0 + num / c
        f *= c * d
        if abs(1.0 - c * d) < 1e-14:
            break
    return front * (f - 1.0)


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) of Student's distribution."""
    return _beta_tail(df / (df + t * t), df / 2, 0.5)


def t_quantile(p: float, df: float) -> float:
    """The value that |T| exceeds with probability p, by bisection."""
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_two_sided(mid, df) > p else (lo, mid)
    return hi


def ols_table(des: DataFrame, features) -> DataFrame:
    """One row per (series, fold, term): coefficient, standard error, t,
    p, 95 % interval, and the condition number of the scaled design.  Terms of a
    singular design have no error (NULL)."""
    k, names = len(features), ["intercept", *features]

    def run(it):
        for pdf in it:
            out = []
            for _, r in pdf.iterrows():
                n, df = r["sw"], r["sw"] - k - 1
                mx, mt = np.array([r[f"sx{i}"] for i in range(k)]) / n, r["st"] / n
                c = np.array([[r[f"sxx{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) - n * np.outer(mx, mx)
                cxt = np.array([r[f"sxt{i}"] for i in range(k)]) - n * mx * mt
                scale = np.sqrt(np.maximum(np.diag(c), 1e-300))
                z = c / np.outer(scale, scale)
                cond = float(np.sqrt(np.linalg.cond(z)))
                inv = np.linalg.pinv(z, rcond=1e-10) / np.outer(scale, scale)
                beta = inv @ cxt
                s2 = (r["stt"] - n * mt * mt - beta @ cxt) / df if df > 0 else np.nan
                var = np.concatenate([[s2 * (1 / n + mx @ inv @ mx)], s2 * np.diag(inv)])
                sound = df > 0 and np.linalg.matrix_rank(z, tol=1e-10) == k
                crit = t_quantile(0.05, df) if sound else None
                for name, b, v in zip(names, [mt - mx @ beta, *beta], var):
                    se = float(np.sqrt(v)) if sound and v > 0 else None
                    out.append((r[SERIES], r["fold"], name, float(b), se, b / se if se else None,
                                t_two_sided(b / se, df) if se else None, b - crit * se if se else None,
                                b + crit * se if se else None, cond))
            yield pd.DataFrame(out, columns=[SERIES, "fold", "term", "coef", "se", "t", "p", "ci_low", "ci_high", "condition"])
    return gram(des, k).mapInPandas(run, f"{SERIES} string, fold string, term string, coef double, se double, t double, "
                                         "p double, ci_low double, ci_high double, condition double")


def ols_inference(des: DataFrame, coefs: DataFrame, k: int) -> DataFrame:
    """Fit statistics of the alpha = 0 fit on training rows: R2, adj R2, F, AIC,
    BIC (Gaussian log-likelihood), Durbin-Watson (residual order by month) and
    Jarque-Bera — one residual pass with window lag, then one aggregation."""
    c = coefs.filter(F.col("alpha") == 0).drop("alpha")
    tr = des.filter(F.col("role") == "train").join(c, [SERIES, "fold"])
    fit = F.col("intercept")
    for i in range(k):
        fit = fit + F.col("coef")[i] * F.col(f"x{i}")
    r = tr.withColumn("e", F.col("t") - fit)
    w = Window.partitionBy(SERIES, "fold").orderBy("report_year", "report_month")
    r = r.withColumn("de", F.col("e") - F.lag("e", 1).over(w))
    g = r.groupBy(SERIES, "fold").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("e") ** 2).alias("ssr"),
        F.sum(F.col("de") ** 2).alias("sdd"), F.avg("t").alias("mt"),
        F.sum(F.col("t") ** 2).alias("stt"), F.sum(F.col("e") ** 3).alias("s3"), F.sum(F.col("e") ** 4).alias("s4"),
        F.first("coef").alias("coef"))
    n = F.col("n").cast("double")
    sst = F.col("stt") - n * F.col("mt") ** 2
    r2 = 1 - F.try_divide(F.col("ssr"), sst)
    p = F.size(F.filter("coef", lambda x: F.abs(x) > 1e-12)).cast("double")  # effective regressors
    llf = -n / 2 * (F.lit(math.log(2 * math.pi)) + F.log(F.col("ssr") / n) + 1)
    m2 = F.col("ssr") / n
    skew = F.try_divide(F.col("s3") / n, F.pow(m2, 1.5))
    kurt = F.try_divide(F.col("s4") / n, m2 * m2)
    return g.select(
        SERIES, "fold", "n", F.round(r2, 6).alias("r2"),
        F.round(1 - (1 - r2) * F.try_divide(n - 1, n - p - 1), 6).alias("adj_r2"),
        F.round(F.try_divide(r2 / p, (1 - r2) / (n - p - 1)), 4).alias("f_stat"),
        F.round(-2 * llf + 2 * (p + 1), 4).alias("aic"), F.round(-2 * llf + F.log(n) * (p + 1), 4).alias("bic"),
        F.round(F.try_divide(F.col("sdd"), F.col("ssr")), 6).alias("durbin_watson"),
        F.round(n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4), 4).alias("jarque_bera"))


# ---------------------------------------------------------------------------
# Holt-Winters (K7) per series in applyInPandas
# ---------------------------------------------------------------------------
def holt_winters(folded: DataFrame) -> DataFrame:
    """K7: per (series, fold) fit on the training months (smoothing and initial
    states optimised, see ``smoothing``), forecast the eval months; fewer than 24
    training points -> last year's same month.  Months without a value are left out."""
    cols = folded.select(SERIES, "fold", "fold_kind", "role", "report_year", "report_month", "y")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["report_year", "report_month"])
        tr = pdf[pdf.role == "train"]["y"].to_numpy(dtype=float)
        tr = tr[np.isfinite(tr)]
        ev = pdf[pdf.role == "eval"].copy()
        if ev.empty:
            return ev.assign(candidate="holt_winters", pred=0.0)[
                [SERIES, "fold", "fold_kind", "report_year", "report_month", "y", "candidate", "pred"]]
        h = len(ev)
        if len(tr) >= 24:
            pred = smoothing.holt_winters_forecast(tr, h)
        else:
            pred = np.array([tr[len(tr) - 12 + (i % 12)] if 0 <= len(tr) - 12 + (i % 12) < len(tr)
                             else np.nanmean(tr[-12:]) for i in range(h)])
        ev["candidate"] = "holt_winters"
        ev["pred"] = np.maximum(pred, 0.0)
        return ev[[SERIES, "fold", "fold_kind", "report_year", "report_month", "y", "candidate", "pred"]]
    schema = (f"{SERIES} string, fold string, fold_kind string, report_year int, report_month int, "
              "y double, candidate string, pred double")
    return cols.groupBy(SERIES, "fold").applyInPandas(run, schema)


# ---------------------------------------------------------------------------
# Elastic net (K3) by coordinate descent on the same Gram sums
# ---------------------------------------------------------------------------
def _enet_rows(pdf: pd.DataFrame, k: int, alpha: float, l1: float, max_iter: int = 5000,
               tol: float = 1e-10) -> pd.DataFrame:
    """Objective of sklearn ElasticNet: 1/(2n)|y - Xb - c|^2 + alpha*l1*|b|_1
    + alpha*(1-l1)/2*|b|^2, solved by cyclic coordinate descent on the centred
    Gram matrix (features are not standardised)."""
    out = []
    for _, r in pdf.iterrows():
        sw, mx, mt, g, c = _centred(r, k)
        g, c = g / sw, c / sw
        on = np.asarray(r["mask"], bool) if "mask" in r and r["mask"] is not None else np.ones(k, bool)
        b = np.zeros(k)
        lam1, lam2 = alpha * l1, alpha * (1 - l1)
        for _ in range(max_iter):
            delta = 0.0
            for j in range(k):
                if g[j, j] <= 0 or not on[j]:
                    continue
                rho = c[j] - g[j] @ b + g[j, j] * b[j]
                nb = np.sign(rho) * max(abs(rho) - lam1, 0.0) / (g[j, j] + lam2)
                delta = max(delta, abs(nb - b[j]))
                b[j] = nb
            if delta < tol:
                break
        out.append({SERIES: r[SERIES], "fold": r["fold"], "alpha": -1.0,
                    "intercept": float(mt - mx @ b), "coef": [float(v) for v in b]})
    return pd.DataFrame(out, columns=[SERIES, "fold", "alpha", "intercept", "coef"])


def fit_elastic_net(des: DataFrame, k: int, alpha: float = 0.5, l1: float = 0.5, mask: Column | None = None) -> DataFrame:
    g = gram(des, k)
    if mask is not None:
        g = g.withColumn("mask", mask)
    schema = f"{SERIES} string, fold string, alpha double, intercept double, coef array<double>"

    def run(it):
        for pdf in it:
            yield _enet_rows(pdf, k, alpha, l1)
    return g.mapInPandas(run, schema)


def predict_with(des: DataFrame, coefs: DataFrame, k: int, target_mode: str, name: str) -> DataFrame:
    ev = des.filter(F.col("role") == "eval").join(coefs, [SERIES, "fold"])
    raw = F.col("intercept")
    for i in range(k):
        raw = raw + F.col("coef")[i] * F.col(f"x{i}")
    p = raw if target_mode == "raw" else (F.expm1(raw) if target_mode == "log1p" else F.exp(raw) * F.col("safe_lag"))
    return ev.select(SERIES, "fold", "fold_kind", "report_year", "report_month", "y", F.lit(name).alias("candidate"),
                     F.greatest(p, F.lit(0.0)).alias("pred"))
