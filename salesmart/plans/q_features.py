"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions.calendar import month_spine
from salesmart.operators import features as FE
from salesmart.operators import marts as M
from salesmart.operators.macro import macro_indicators
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_marts import DATASET_LOCAL, DATASET_NEEDS, _canonical, group_dataset_df
from salesmart.plans.registry import query
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

KEY = ["canonical_group", "report_year", "report_month"]
W = "PARTITION BY canonical_group ORDER BY report_year, report_month"

FEATURES_SQL = f"""
SELECT f.*,
       f.sales_lag_12m * CASE WHEN f.sales_lag_1m IS NULL OR f.l13 IS NULL THEN NULL
                              WHEN f.l13 = 0 THEN CASE WHEN f.sales_lag_1m > 0 THEN 2.0 WHEN f.sales_lag_1m < 0 THEN 0.5 END
                              ELSE greatest(0.5, least(2.0, f.sales_lag_1m / f.l13)) END AS trend_yoy_adj,
       CASE WHEN f.sales_lag_12m / NULLIF(f.l24, 0) IS NOT NULL
            THEN greatest(0.5, least(2.0, f.sales_lag_12m / NULLIF(f.l24, 0))) END AS yoy_estimate,
       COALESCE(CAST(f.composition_curr_pct AS DOUBLE), 0) * COALESCE(f.sales_lag_12m, 0) AS comp_x_lag12,
       f.l12_lny - f.f_lny AS cny_shift_signal,
       CASE WHEN f.lead_1_mid_autumn = 1 THEN 0.0 ELSE f.l12_ma - f.f_ma END AS midautumn_shift_signal,
       CASE WHEN f.l12_lny - f.f_lny > 0 THEN COALESCE(f.hist_non_cny, f.sales_lag_12m) ELSE f.sales_lag_12m END AS lag_12m_cny_adj,
       CAST(CASE WHEN f.canonical_group IN ('GIFT_LOW', 'GIFT_HIGH') THEN
                 CASE WHEN f.report_year >= 1998 THEN f.report_year - 1998 + 1
                      WHEN f.report_year >= 1997 THEN f.report_year - 1997 + 1
                      ELSE f.report_year - 1995 + 1 END
            ELSE f.report_year - 1994 END AS DOUBLE) AS year_in_regime,
       fm.v AS sales_festival_midautumn_lag1y, fc.v AS sales_festival_cny_lag1y
FROM (SELECT b.*,
             lag(s, 1) OVER w AS sales_lag_1m, lag(s, 3) OVER w AS sales_lag_3m,
             lag(s, 6) OVER w AS sales_lag_6m, lag(s, 12) OVER w AS sales_lag_12m,
             lag(s, 13) OVER w AS l13, lag(s, 24) OVER w AS l24,
             CASE WHEN COUNT(s) OVER ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
                  THEN AVG(s) OVER ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS sales_rolling_3m_mean,
             CASE WHEN COUNT(s) OVER ({W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) = 6
                  THEN AVG(s) OVER ({W} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) END AS sales_rolling_6m_mean,
             sin(2 * pi() * report_month / 12) AS month_sin, cos(2 * pi() * report_month / 12) AS month_cos,
             CAST(CASE WHEN report_month IN (1, 2, 8, 9, 12) THEN 1 ELSE 0 END AS DOUBLE) AS is_peak_month,
             COALESCE(lead(f_lny, 1) OVER w, 0) AS lead_1_lunar_new_year,
             COALESCE(lead(f_ma, 1) OVER w, 0) AS lead_1_mid_autumn,
             COALESCE(lag(f_lny, 12) OVER w, 0) AS l12_lny, COALESCE(lag(f_ma, 12) OVER w, 0) AS l12_ma,
             AVG(CASE WHEN f_lny = 0 THEN s END) OVER (PARTITION BY canonical_group, report_month ORDER BY report_year
                 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hist_non_cny
      FROM (SELECT *, CAST(sales_result AS DOUBLE) AS s,
                   COALESCE(CAST(has_lunar_new_year AS DOUBLE), 0) AS f_lny,
                   COALESCE(CAST(has_mid_autumn AS DOUBLE), 0) AS f_ma FROM ds) b
      WINDOW w AS ({W})) f
LEFT JOIN (SELECT canonical_group, report_year + 1 AS report_year, arg_max(CAST(sales_result AS DOUBLE), report_month) AS v
           FROM ds WHERE has_mid_autumn GROUP BY 1, 2) fm
       ON fm.canonical_group = f.canonical_group AND fm.report_year = f.report_year
LEFT JOIN (SELECT canonical_group, report_year + 1 AS report_year, arg_max(CAST(sales_result AS DOUBLE), report_month) AS v
           FROM ds WHERE has_lunar_new_year GROUP BY 1, 2) fc
       ON fc.canonical_group = f.canonical_group AND fc.report_year = f.report_year"""
FEAT_LOCAL = {**DATASET_LOCAL, "features": FEATURES_SQL}


def _r(cols, d=4):
    return [F.round(c, d).alias(c) for c in cols]


def _rs(cols, d=4):
    return ", ".join(f"ROUND({c}, {d}) AS {c}" for c in cols)


def _features(spark, sf):
    return FE.build_features(group_dataset_df(spark, sf))


def _feature_query(name, cols, doc, digits=4, extra_sql="", extra_spark=()):
    sql = with_ctes(f"SELECT {', '.join(KEY)}, {_rs(cols, digits)}{extra_sql} FROM features",
                    *DATASET_NEEDS, local=FEAT_LOCAL)

    def fn(spark, sf):
        return _features(spark, sf).select(*KEY, *_r(cols, digits), *[F.round(c, d).alias(c) for c, d in extra_spark])
    fn.__doc__ = doc
    query(name, sql)(fn)


_feature_query("series_lags", ["sales_lag_1m", "sales_lag_3m", "sales_lag_6m", "sales_lag_12m"],
               "E2: row lags 1/3/6/12 per group series.")
_feature_query("rolling_means", ["sales_rolling_3m_mean", "sales_rolling_6m_mean"],
               "E3: mean of the previous 3/6 months, full windows only.")
_feature_query("lead_flags", ["lead_1_lunar_new_year", "lead_1_mid_autumn"],
               "E4: next month has the festival (0 at the series end).")
_feature_query("trend_features", ["trend_yoy_adj", "yoy_estimate", "comp_x_lag12", "is_peak_month"],
               "E6 E7 H18 H19: trend-adjusted lag, long trend, interaction, peak flag.",
               extra_sql=", ROUND(month_sin, 9) AS month_sin, ROUND(month_cos, 9) AS month_cos",
               extra_spark=(("month_sin", 9), ("month_cos", 9)))
_feature_query("festival_features", ["cny_shift_signal", "midautumn_shift_signal", "lag_12m_cny_adj",
                                     "sales_festival_midautumn_lag1y", "sales_festival_cny_lag1y"],
               "E8 E9 C13 D22: festival shift signals, holiday-adjusted lag, prior-year festival sales.")
_feature_query("regime_years", ["year_in_regime"], "E10: years since the group's last threshold change.")


@query("fill_gaps", with_ctes("""
SELECT canonical_group, report_year, report_month, CAST(lunar_new_year_day AS INTEGER) AS lunar_new_year_day,
       CAST(COALESCE(last_value(lunar_new_year_day IGNORE NULLS) OVER (PARTITION BY canonical_group ORDER BY report_year, report_month
                                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value(lunar_new_year_day IGNORE NULLS) OVER (PARTITION BY canonical_group ORDER BY report_year, report_month
                                                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS INTEGER) AS filled
FROM ds""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_fill_gaps(spark, sf):
    """E5: forward then backward fill of a sparse indicator within each series."""
    ds = group_dataset_df(spark, sf)
    return ds.select(*KEY, "lunar_new_year_day",
                     FE.fill_gaps(ds, "lunar_new_year_day").cast("int").alias("filled"))


@query("cross_group_ratios", with_ctes("""
SELECT report_year, report_month,
       ROUND(low / NULLIF(low + high, 0), 6) AS low_high_ratio,
       ROUND(large / NULLIF(low + high + large, 0), 6) AS large_share
FROM (SELECT report_year, report_month,
             CAST(SUM(CASE WHEN canonical_group = 'GIFT_LOW' THEN sales_result END) AS DOUBLE) AS low,
             CAST(SUM(CASE WHEN canonical_group = 'GIFT_HIGH' THEN sales_result END) AS DOUBLE) AS high,
             CAST(SUM(CASE WHEN canonical_group = 'GIFT_LARGE' THEN sales_result END) AS DOUBLE) AS large
      FROM canonical WHERE period_type = 'MONTHLY' GROUP BY 1, 2)""", "category_fact", "gift_mapping",
    local={"canonical": DATASET_LOCAL["canonical"]}))
def q_cross_group_ratios(spark, sf):
    """low/(low+high) and large share per month."""
    return FE.cross_group_ratios(_canonical(spark, sf))


@query("indicator_lags", with_ctes("""
SELECT m.report_year, m.report_month, m.order_count, m.avg_order_price,
       CAST(p1.order_count AS DOUBLE) AS lag_order_count_1m, CAST(p1.avg_order_price AS DOUBLE) AS lag_avg_order_price_1m,
       ROUND(CAST(m.order_count AS DOUBLE) * 100.0 / NULLIF(CAST(p12.order_count AS DOUBLE), 0), 4) AS order_count_yoy
FROM macro m
LEFT JOIN macro p1 ON p1.report_year * 12 + p1.report_month - 1 + 1 = m.report_year * 12 + m.report_month - 1
LEFT JOIN macro p12 ON p12.report_year * 12 + p12.report_month - 1 + 12 = m.report_year * 12 + m.report_month - 1""",
    "macro"))
def q_indicator_lags(spark, sf):
    """One-month lags and 12-month YoY of the order indicators."""
    m = macro_indicators(Tables(spark, sf)).select("report_year", "report_month", "order_count", "avg_order_price")
    return FE.indicator_lags(m, ["order_count", "avg_order_price"], lags=(1,), yoy_cols=["order_count"])


@query("quarter_fill", with_ctes("""
SELECT s.report_year, s.report_month, CAST((s.report_month - 1) // 3 + 1 AS INTEGER) AS quarter, q.quarter_avg_price
FROM month_spine s LEFT JOIN (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS report_year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
         CAST(ROUND(AVG(o_totalprice), 2) AS DECIMAL(18,2)) AS quarter_avg_price
  FROM orders GROUP BY 1, 2) q
  ON q.report_year = s.report_year AND q.quarter = CAST((s.report_month - 1) // 3 + 1 AS INTEGER)""", "month_spine"))
def q_quarter_fill(spark, sf):
    """A quarterly indicator repeated on each month of its quarter."""
    t = Tables(spark, sf)
    q = (t.orders.groupBy(F.year("o_orderdate").alias("report_year"), F.quarter("o_orderdate").alias("quarter"))
         .agg(F.round(F.avg("o_totalprice"), 2).cast("decimal(18,2)").alias("quarter_avg_price")))
    spine = month_spine(t.orders, "o_orderdate").select("report_year", "report_month")
    return FE.quarter_fill(spine, q, "quarter_avg_price")
