"""Grouped statistics.

Correlations are computed as one aggregation over a long (series, feature,
x, y) frame — every (series, feature) pair in parallel — rather than a
driver loop per group.  ``corr`` is not used: on a constant column it raises
under ANSI; covariance over the product of standard deviations with
``try_divide`` returns NULL instead.  Aggregates skip rows where either side
is NULL, so pairs are pairwise complete like pandas.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.smoothing import stl

SERIES = "canonical_group"
# Two-sided normal quantiles for the critical t approximation (alpha .05 and .01)
Z_975 = 1.959963984540054
Z_995 = 2.5758293035489


def to_long(df: DataFrame, keys, features, value: str = "sales_result") -> DataFrame:
    """Wide -> (keys..., feature, x, y) with y = value."""
    return df.select(*keys, F.col(value).cast("double").alias("y"),
                     *[F.col(f).cast("double").alias(f) for f in features]) \
        .unpivot([*keys, "y"], list(features), "feature", "x")


def pearson_agg(x: str = "x", y: str = "y") -> list[Column]:
    xm = F.when(F.col(y).isNotNull(), F.col(x))
    ym = F.when(F.col(x).isNotNull(), F.col(y))
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(xm) * F.stddev_pop(ym))
    n = F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull())
    return [r.alias("r"), n.alias("n")]


def t_critical(df_col: Column, z: float) -> Column:
    """Student-t two-sided critical value from the normal quantile
    (Cornish-Fisher expansion in 1/df; error < 1e-3 for df >= 5)."""
    d = df_col.cast("double")
    z3, z5, z7 = z ** 3, z ** 5, z ** 7
    return (F.lit(z) + F.lit((z3 + z) / 4) / d + F.lit((5 * z5 + 16 * z3 + 3 * z) / 96) / (d * d)
            + F.lit((3 * z7 + 19 * z5 + 17 * z3 - 15 * z) / 384) / (d * d * d))


def significance(r: Column, n: Column) -> tuple[Column, Column]:
    """t = r sqrt((n-2)/(1-r^2)) and stars at .05 / .01."""
    t = r * F.sqrt(F.try_divide((n - 2).cast("double"), 1 - r * r))
    dfree = n - 2
    stars = (F.when(dfree < 1, F.lit(None))
             .when(F.abs(t) > t_critical(dfree, Z_995), F.lit("**"))
             .when(F.abs(t) > t_critical(dfree, Z_975), F.lit("*")).otherwise(F.lit("")))
    return t, stars


def pearson(long: DataFrame, keys) -> DataFrame:
    """D9 (+D14): r per keys (e.g. series, feature), pairwise complete."""
    g = long.groupBy(*keys).agg(*pearson_agg())
    t, stars = significance(F.col("r"), F.col("n"))
    return g.select(*keys, F.round("r", 6).alias("pearson"), "n",
                    F.round(t, 4).alias("t_stat"), stars.alias("significance"))


def lagged_long(df: DataFrame, indicators, lags=(0, 1, 2, 3), key: str = SERIES,
                value: str = "sales_result") -> DataFrame:
    """D10 input: (series, indicator, lag, x = indicator lagged k rows, y = value)."""
    w = Window.partitionBy(key).orderBy("report_year", "report_month")
    cols = {f"{i}__{k}": F.lag(F.col(i).cast("double"), k).over(w) for i in indicators for k in lags}
    wide = df.select(key, "report_year", "report_month", F.col(value).cast("double").alias("y"),
                     *[c.alias(n) for n, c in cols.items()])
    long = wide.unpivot([key, "report_year", "report_month", "y"], list(cols), "feature_lag", "x")
    parts = F.split("feature_lag", "__")
    return long.select(key, parts[0].alias("indicator"), parts[1].cast("int").alias("lag"), "x", "y")


def best_lag(corrs: DataFrame, key: str = SERIES) -> DataFrame:
    """Per (series, indicator) the lag with max |r|; smallest lag wins ties."""
    return (corrs.filter(F.col("pearson").isNotNull())
            .groupBy(key, "indicator")
            .agg(F.min_by(F.struct("lag", "pearson"), F.struct(-F.abs("pearson"), F.col("lag"))).alias("b"))
            .select(key, "indicator", F.col("b.lag").alias("best_lag"), F.col("b.pearson").alias("pearson")))


def average_rank(c: str, part) -> Column:
    """Rank with ties averaged (pandas rank method='average')."""
    w = Window.partitionBy(*part).orderBy(F.col(c))
    wt = Window.partitionBy(*part, F.col(c))
    return (F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0).cast("double")


def spearman(long: DataFrame, keys) -> DataFrame:
    """Pearson on average ranks of the pair-complete rows."""
    pc = long.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    ranked = pc.select(*keys, average_rank("x", keys).alias("x"), average_rank("y", keys).alias("y"))
    g = ranked.groupBy(*keys).agg(*pearson_agg())
    return g.select(*keys, F.round("r", 6).alias("spearman"), "n")


def partial_corr(df: DataFrame, features, controls, key: str = SERIES, value: str = "sales_result") -> DataFrame:
    """Partial r of (value, feature) given two controls, by the recursive
    formula on the pairwise r's of the listwise-complete rows."""
    z1, z2 = controls
    base = df.select(key, F.col(value).cast("double").alias("y"),
                     F.col(z1).cast("double").alias("z1"), F.col(z2).cast("double").alias("z2"),
                     *[F.col(f).cast("double").alias(f) for f in features])
    long = base.unpivot([key, "y", "z1", "z2"], list(features), "feature", "x") \
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z1").isNotNull() & F.col("z2").isNotNull())

    def r(a, b):
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    g = long.groupBy(key, "feature").agg(
        r("x", "y").alias("rxy"), r("x", "z1").alias("rx1"), r("y", "z1").alias("ry1"),
        r("x", "z2").alias("rx2"), r("y", "z2").alias("ry2"), r("z1", "z2").alias("r12"),
        F.count(F.lit(1)).alias("n"))

    def pc(rab, rac, rbc):
        return F.try_divide(rab - rac * rbc, F.sqrt((1 - rac * rac) * (1 - rbc * rbc)))
    rxy1 = pc(F.col("rxy"), F.col("rx1"), F.col("ry1"))
    rx21 = pc(F.col("rx2"), F.col("rx1"), F.col("r12"))
    ry21 = pc(F.col("ry2"), F.col("ry1"), F.col("r12"))
    return g.select(key, "feature", F.round(F.col("rxy"), 6).alias("pearson"),
                    F.round(pc(rxy1, rx21, ry21), 6).alias("partial_r"), "n")


def corr_matrix(corrs: DataFrame, groups, key: str = SERIES) -> DataFrame:
    """(feature x group) matrix of r; group list given so no discovery job runs."""
    return corrs.groupBy("feature").pivot(key, list(groups)).agg(F.first("pearson"))


def festival_lift(df: DataFrame, flag: str, key: str = SERIES, value: str = "sales_result") -> DataFrame:
    """Mean of festival months / mean of the other months x 100."""
    f = F.coalesce(F.col(flag).cast("double"), F.lit(0.0)) == 1
    v = F.col(value).cast("double")
    g = df.groupBy(key).agg(F.avg(F.when(f, v)).alias("fest_mean"), F.avg(F.when(~f, v)).alias("other_mean"))
    return g.select(key, F.round("fest_mean", 4).alias("fest_mean"), F.round("other_mean", 4).alias("other_mean"),
                    F.round(F.try_divide(F.col("fest_mean") * 100, F.col("other_mean")), 4).alias("lift_pct"))


def break_effect(df: DataFrame, break_year: int, break_month: int = 1, months: int = 6,
                 key: str = SERIES, value: str = "sales_result", share: str = "composition_curr_pct") -> DataFrame:
    """Mean of the ``months`` months before vs from the break; share delta in points."""
    idx = F.col("report_year") * 12 + F.col("report_month") - 1
    b = break_year * 12 + break_month - 1
    before = (idx >= b - months) & (idx < b)
    after = (idx >= b) & (idx < b + months)
    v = F.col(value).cast("double")
    s = F.col(share).cast("double")
    g = df.groupBy(key).agg(
        F.avg(F.when(before, v)).alias("mean_before"), F.avg(F.when(after, v)).alias("mean_after"),
        F.avg(F.when(before, s)).alias("share_before"), F.avg(F.when(after, s)).alias("share_after"))
    return g.select(key, *[F.round(c, 4).alias(c) for c in ["mean_before", "mean_after"]],
                    F.round(F.try_divide((F.col("mean_after") - F.col("mean_before")) * 100, F.col("mean_before")), 4)
                    .alias("change_pct"),
                    F.round(F.col("share_after") - F.col("share_before"), 4).alias("share_delta_pts"))


def month_rank(df: DataFrame, key: str = SERIES, value: str = "sales_result") -> DataFrame:
    """Calendar-month mean per series, ranked (1 = highest)."""
    g = df.groupBy(key, "report_month").agg(F.avg(F.col(value).cast("double")).alias("mean_sales"))
    w = Window.partitionBy(key).orderBy(F.col("mean_sales").desc(), F.col("report_month"))
    return g.select(key, "report_month", F.round("mean_sales", 4).alias("mean_sales"),
                    F.rank().over(w).alias("month_rank"))


def group_share(df: DataFrame, key: str = SERIES, value: str = "sales_result") -> DataFrame:
    """Annual share of each series in the year's total."""
    a = df.groupBy("report_year", key).agg(F.sum(value).cast("decimal(18,2)").alias("annual_sales"))
    w = Window.partitionBy("report_year")
    return a.withColumn("share_pct", F.round(
        F.try_divide(F.col("annual_sales").cast("double") * 100, F.sum(F.col("annual_sales").cast("double")).over(w)), 4))


def seasonal_parts(df: DataFrame, key: str = SERIES, value: str = "sales_result") -> DataFrame:
    """Classical additive decomposition (not LOESS): trend = centred 2x12
    moving average, seasonal = calendar-month mean of the detrended series
    centred over the 12 months, residual = value - trend - seasonal.

    Computed exactly in integer units of 1/2400 of the money unit (2x12 MA of
    cents = integer / 24); the two means round half-up in integer division.
    Outputs are one division of an exact integer, so they are reproducible."""
    w = Window.partitionBy(key).orderBy("report_year", "report_month")
    yc = (F.col(value) * 100).cast("bigint")
    win = w.rowsBetween(-6, 6)
    d = df.select(key, "report_year", "report_month", yc.alias("yc"))
    n = 2 * F.sum("yc").over(win) - F.lag("yc", 6).over(w) - F.lead("yc", 6).over(w)
    d = d.withColumn("n24", F.when(F.count("yc").over(win) == 13, n))
    d = d.withColumn("dev", F.col("yc") * 24 - F.col("n24"))
    idx = (d.groupBy(key, "report_month")
           .agg(F.expr("(2 * SUM(dev) + COUNT(dev)) div (2 * COUNT(dev))").alias("s_raw")))
    centre = idx.groupBy(key).agg(F.expr("(2 * SUM(s_raw) + COUNT(s_raw)) div (2 * COUNT(s_raw))").alias("centre"))
    idx = idx.join(centre, key).select(key, "report_month", (F.col("s_raw") - F.col("centre")).alias("s_units"))
    d = d.join(idx, [key, "report_month"], "left")
    return d.select(key, "report_year", "report_month", (F.col("yc") / 100.0).alias("sales"),
                    (F.col("n24") / 2400.0).alias("trend"), (F.col("s_units") / 2400.0).alias("seasonal"),
                    ((F.col("dev") - F.col("s_units")) / 2400.0).alias("resid"))


def loess_parts(df: DataFrame, key: str = SERIES, value: str = "sales_result", seasonal: int = 7, outer: int = 15) -> DataFrame:
    """Seasonal decomposition by LOESS with robustness weights, for series of
    at least two years of months (others have no rows; months without a value are
    left out).  value = trend + seasonal + remainder; ``robust`` is the weight
    that the point ended with, 0 for a clear outlier."""
    own = df.select(key, "report_year", "report_month", F.col(value).cast("double").alias("value"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[np.isfinite(pdf["value"])].sort_values(["report_year", "report_month"])
        if len(pdf) < 24:
            pdf = pdf.iloc[:0]
        parts = stl(pdf["value"].to_numpy(), seasonal=seasonal, outer=outer) if len(pdf) else np.zeros((0, 4))
        return pdf.assign(**dict(zip(("trend", "seasonal", "remainder", "robust"), parts.T)))
    return own.groupBy(key).applyInPandas(run, f"{key} string, report_year int, report_month int, value double, trend double, "
                                               "seasonal double, remainder double, robust double")
