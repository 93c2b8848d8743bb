"""Time-series features per group.

Input: the group dataset (one row per canonical_group x month).  Every
feature is a window expression partitioned by the series key, so a series is
one bounded group (its months) and all series run in parallel — the per-row
Python loops of the reference become lag/avg/first/last windows.
pandas semantics are kept explicitly: NULL (never NaN) for missing, full
windows only for rolling means, x/0 = +-inf before clipping.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import clip, interaction
from salesmart.sources.bindings import THRESHOLD_CHANGES

SERIES = "canonical_group"
ORDER = ["report_year", "report_month"]
# Peak gift months
PEAK_MONTHS = [1, 2, 8, 9, 12]
_CHANGES = [year for year, _ in THRESHOLD_CHANGES[1:]]
# groups whose bands move with the threshold; the large gifts' does not
THRESHOLD_CHANGE_YEARS = {g: _CHANGES for g in ("GIFT_LOW", "GIFT_HIGH")} | {"GIFT_LARGE": []}
FIRST_YEAR = 1995           # first year of data: regime default when no change happened yet


def series_window(key: str = SERIES) -> Window:
    return Window.partitionBy(key).orderBy(*ORDER)


def add_lags(df: DataFrame, value: str = "sales_result", lags=(1, 3, 6, 12), key: str = SERIES,
             prefix: str = "sales") -> DataFrame:
    """Row-based lags (run a month spine first if months can be missing)."""
    w = series_window(key)
    v = F.col(value).cast("double")
    return df.withColumns({f"{prefix}_lag_{k}m": F.lag(v, k).over(w) for k in lags})


def rolling_prev_mean(value: str, n: int, key: str = SERIES) -> Column:
    """Mean of the previous n rows, only when all n are present."""
    w = series_window(key).rowsBetween(-n, -1)
    v = F.col(value).cast("double")
    return F.when(F.count(v).over(w) == n, F.avg(v).over(w))


def ratio_clip_inf(num: Column, den: Column, lo: float, hi: float) -> Column:
    """pandas num/den then clip: x/0 is +-inf (clips to hi/lo), 0/0 is missing."""
    return (F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
            .when(den == 0, F.when(num > 0, F.lit(hi)).when(num < 0, F.lit(lo)))
            .otherwise(clip(num / den, lo, hi)))


def year_in_regime(year: Column, group: Column) -> Column:
    """Years since the group's last threshold change (that year = 1);
    groups without changes count from the year before the data starts."""
    expr = year - F.lit(FIRST_YEAR - 1)
    for g, years in THRESHOLD_CHANGE_YEARS.items():
        if not years:
            continue
        e = year - F.lit(FIRST_YEAR) + 1
        for y in sorted(years):
            e = F.when(year >= y, year - F.lit(y) + 1).otherwise(e)
        expr = F.when(group == g, e).otherwise(expr)
    return expr.cast("double")


def festival_prev_year(df: DataFrame, flag: str, value: str = "sales_result", key: str = SERIES) -> DataFrame:
    """C13 + D22: per (series, year) the value of its festival month (the last
    month wins when several are flagged), offered to every row of the next year."""
    fest = (df.filter(F.col(flag).cast("double") == 1)
            .groupBy(key, "report_year")
            .agg(F.max_by(F.col(value).cast("double"), "report_month").alias("_fest"))
            .select(key, (F.col("report_year") + 1).alias("report_year"), "_fest"))
    return fest


def build_features(ds: DataFrame, key: str = SERIES) -> DataFrame:
    """All v2 features on the group dataset."""
    w = series_window(key)
    s = F.col("sales_result").cast("double")
    d = ds.withColumns({
        "has_lunar_new_year": F.coalesce(F.col("has_lunar_new_year").cast("double"), F.lit(0.0)),
        "has_mid_autumn": F.coalesce(F.col("has_mid_autumn").cast("double"), F.lit(0.0)),
        "calendar_days": F.col("calendar_days").cast("double"),
        "working_days": F.col("working_days").cast("double"),
    })
    d = add_lags(d, lags=(1, 3, 6, 12), key=key)
    lag13, lag24 = F.lag(s, 13).over(w), F.lag(s, 24).over(w)
    d = d.withColumns({
        "sales_rolling_3m_mean": rolling_prev_mean("sales_result", 3, key),
        "sales_rolling_6m_mean": rolling_prev_mean("sales_result", 6, key),
        "_lag13": lag13, "_lag24": lag24,
        "month_sin": F.sin(2 * math.pi * F.col("report_month") / 12),
        "month_cos": F.cos(2 * math.pi * F.col("report_month") / 12),
        "is_peak_month": F.col("report_month").isin(*PEAK_MONTHS).cast("double"),
        "lead_1_lunar_new_year": F.coalesce(F.lead("has_lunar_new_year", 1).over(w), F.lit(0.0)),
        "lead_1_mid_autumn": F.coalesce(F.lead("has_mid_autumn", 1).over(w), F.lit(0.0)),
        "_lag12_cny": F.coalesce(F.lag("has_lunar_new_year", 12).over(w), F.lit(0.0)),
        "_lag12_mid": F.coalesce(F.lag("has_mid_autumn", 12).over(w), F.lit(0.0)),
        "lunar_new_year_day": F.coalesce(F.col("lunar_new_year_day").cast("double"), F.lit(0.0)),
        "mid_autumn_day": F.coalesce(F.col("mid_autumn_day").cast("double"), F.lit(0.0)),
        "year_in_regime": year_in_regime(F.col("report_year"), F.col(key)),
    })
    hist = (Window.partitionBy(key, "report_month").orderBy("report_year")
            .rangeBetween(Window.unboundedPreceding, -1))
    d = d.withColumns({
        "trend_yoy_adj": F.col("sales_lag_12m") * ratio_clip_inf(F.col("sales_lag_1m"), F.col("_lag13"), 0.5, 2.0),
        "yoy_estimate": clip(F.col("sales_lag_12m") / F.nullif(F.col("_lag24"), F.lit(0.0)), 0.5, 2.0),
        "comp_x_lag12": interaction("composition_curr_pct", "sales_lag_12m"),
        "cny_shift_signal": F.col("_lag12_cny") - F.col("has_lunar_new_year"),
        "midautumn_shift_signal": F.when(F.col("lead_1_mid_autumn") == 1, F.lit(0.0))
                                   .otherwise(F.col("_lag12_mid") - F.col("has_mid_autumn")),
        "_hist_non_cny": F.avg(F.when(F.col("has_lunar_new_year") == 0, s)).over(hist),
    })
    d = d.withColumn("lag_12m_cny_adj", F.when(
        F.col("cny_shift_signal") > 0, F.coalesce(F.col("_hist_non_cny"), F.col("sales_lag_12m")))
        .otherwise(F.col("sales_lag_12m")))
    ma = festival_prev_year(d, "has_mid_autumn", key=key).withColumnRenamed("_fest", "sales_festival_midautumn_lag1y")
    cny = festival_prev_year(d, "has_lunar_new_year", key=key).withColumnRenamed("_fest", "sales_festival_cny_lag1y")
    d = d.join(ma, [key, "report_year"], "left").join(cny, [key, "report_year"], "left")
    return d.drop("_lag13", "_lag24", "_lag12_cny", "_lag12_mid", "_hist_non_cny")


def fill_gaps(df: DataFrame, col: str, key: str = SERIES) -> Column:
    """E5: forward fill then backward fill within the series."""
    w = series_window(key)
    fwd = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bwd = F.first(col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(fwd, bwd)


def cross_group_ratios(canonical: DataFrame) -> DataFrame:
    """Per month low/(low+high) and large/(low+high+large)."""
    m = canonical.filter(F.col("period_type") == "MONTHLY").groupBy("report_year", "report_month").agg(
        F.sum(F.when(F.col("canonical_group") == "GIFT_LOW", F.col("sales_result"))).cast("double").alias("low"),
        F.sum(F.when(F.col("canonical_group") == "GIFT_HIGH", F.col("sales_result"))).cast("double").alias("high"),
        F.sum(F.when(F.col("canonical_group") == "GIFT_LARGE", F.col("sales_result"))).cast("double").alias("large"))
    return m.select("report_year", "report_month",
                    F.round(F.try_divide(F.col("low"), F.col("low") + F.col("high")), 6).alias("low_high_ratio"),
                    F.round(F.try_divide(F.col("large"), F.col("low") + F.col("high") + F.col("large")), 6)
                    .alias("large_share"))


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def indicator_lags(macro: DataFrame, cols, lags=(1,), yoy_cols=()) -> DataFrame:
    """Calendar-safe lagged indicators and 12-month YoY % over the month
    table, as equi joins on a month index shifted by k (no single-partition
    window; a missing month gives NULL rather than the wrong month)."""
    idx = month_index(F.col("report_year"), F.col("report_month"))
    out = macro.withColumn("_m", idx)
    shifts = sorted(set(lags) | ({12} if yoy_cols else set()))
    for k in shifts:
        keep = [c for c in cols if k in lags] + [c for c in yoy_cols if k == 12]
        if not keep:
            continue
        prev = macro.select((idx + k).alias("_m"),
                            *[F.col(c).cast("double").alias(f"_p{k}_{c}") for c in dict.fromkeys(keep)])
        out = out.join(prev, "_m", "left")
        for c in cols:
            if k in lags:
                out = out.withColumn(f"lag_{c}_{k}m", F.col(f"_p{k}_{c}"))
        for c in yoy_cols:
            if k == 12:
                out = out.withColumn(f"{c}_yoy", F.round(
                    F.try_divide(F.col(c).cast("double") * 100.0, F.col(f"_p12_{c}")), 4))
        out = out.drop(*[f"_p{k}_{c}" for c in dict.fromkeys(keep)])
    return out.drop("_m")


def quarter_fill(monthly_spine: DataFrame, quarterly: DataFrame, value: str) -> DataFrame:
    """A quarterly series repeated on each month of its quarter."""
    q = quarterly.select("report_year", "quarter", value)
    m = monthly_spine.withColumn("quarter", ((F.col("report_month") - 1) / 3).cast("int") + 1)
    return m.join(q, ["report_year", "quarter"], "left")
