"""E2-E9 pandas semantics on small series, D9/D12 statistics edge cases."""

import math

from pyspark.sql import functions as F

from salesmart.operators import features as FE
from salesmart.operators import stats as S


def series(spark, rows):
    return spark.createDataFrame(
        rows, "canonical_group string, report_year int, report_month int, sales_result double, "
              "has_lunar_new_year boolean, has_mid_autumn boolean, composition_curr_pct double, "
              "lunar_new_year_day int, mid_autumn_day int, working_days int, calendar_days int")


def simple(spark, n=30, groups=("A", "B"), zero_at=None, null_at=None, festivals=None):
    rows = []
    for g in groups:
        for i in range(n):
            y, m = 2000 + i // 12, i % 12 + 1
            v = float(100 + i) if g == "A" else float(1000 + 10 * i)
            if zero_at is not None and i == zero_at:
                v = 0.0
            if null_at is not None and i == null_at:
                v = None
            lny = bool(festivals and (y, m) in festivals)
            rows.append((g, y, m, v, lny, False, 10.0, None, None, 21, 30))
    return series(spark, rows)


def feat(df):
    return {(r.canonical_group, r.report_year, r.report_month): r for r in FE.build_features(df).collect()}


def test_lags_and_rolling_full_windows(spark):
    f = feat(simple(spark, null_at=5))
    a = f[("A", 2000, 5)]          # index 4
    assert a.sales_lag_1m == 103.0 and a.sales_lag_3m == 101.0 and a.sales_lag_12m is None
    assert a.sales_rolling_3m_mean == (101 + 102 + 103) / 3
    assert f[("A", 2000, 3)].sales_rolling_3m_mean is None            # only 2 previous rows
    assert f[("A", 2000, 8)].sales_rolling_3m_mean is None            # window holds the NULL month
    assert f[("B", 2000, 1)].sales_lag_1m is None                     # no leakage across groups


def test_trend_ratio_inf_and_nan(spark):
    f = feat(simple(spark, n=30, zero_at=0))
    r = f[("A", 2001, 2)]            # index 13: lag13 = index 0 = 0, lag1 = index 12 > 0 -> inf -> clip 2
    assert r.trend_yoy_adj == r.sales_lag_12m * 2.0
    r24 = f[("A", 2002, 1)]          # index 24: lag24 = 0 -> yoy_estimate missing
    assert r24.yoy_estimate is None


def test_festival_features(spark):
    fest = {(2000, 2), (2001, 1), (2002, 2)}
    f = feat(simple(spark, n=36, festivals=fest))
    feb01 = f[("A", 2001, 2)]         # last year Feb had the festival, this Feb has not
    assert feb01.cny_shift_signal == 1.0
    assert feb01.lag_12m_cny_adj == feb01.sales_lag_12m     # no earlier non-festival Feb -> lag12
    feb02 = f[("A", 2002, 2)]
    assert feb02.cny_shift_signal == -1.0                    # Feb 2001 had none, Feb 2002 has
    jan02 = f[("A", 2002, 1)]
    assert jan02.cny_shift_signal == 1.0 and jan02.lag_12m_cny_adj == f[("A", 2000, 1)].sales_result
    assert f[("A", 2001, 5)].sales_festival_cny_lag1y == f[("A", 2000, 2)].sales_result
    assert f[("A", 2000, 1)].lead_1_lunar_new_year == 1.0


def test_pearson_constant_is_null_not_error(spark):
    df = spark.createDataFrame([("g", float(i), 5.0, float(i) * 2) for i in range(6)],
                               "canonical_group string, sales_result double, const double, lin double")
    out = {r.feature: r.pearson for r in S.pearson(S.to_long(df, ["canonical_group"], ["const", "lin"]),
                                                    ["canonical_group", "feature"]).collect()}
    assert out["const"] is None and math.isclose(out["lin"], 1.0)


def test_spearman_average_ranks(spark):
    df = spark.createDataFrame([("g", "f", x, y) for x, y in [(1.0, 1.0), (2.0, 2.0), (2.0, 3.0), (4.0, 4.0)]],
                               "canonical_group string, feature string, x double, y double")
    r = S.spearman(df, ["canonical_group", "feature"]).first()
    # ranks x = 1, 2.5, 2.5, 4 ; y = 1, 2, 3, 4 -> pandas spearman = 0.948683
    assert abs(r.spearman - 0.948683) < 1e-6


def test_seasonal_parts_exact(spark):
    rows = [("g", 2000 + i // 12, i % 12 + 1, float(100 + (i % 12) * 10)) for i in range(36)]
    df = spark.createDataFrame(rows, "canonical_group string, report_year int, report_month int, sales_result double")
    out = S.seasonal_parts(df).filter(F.col("trend").isNotNull()).collect()
    assert all(abs(r.trend + r.seasonal + r.resid - r.sales) < 1e-9 for r in out)
