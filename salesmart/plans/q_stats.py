"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions.numeric import avg_exact
from salesmart.operators import stats as S
from salesmart.plans import oracle_base as O
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_marts import DATASET_LOCAL, DATASET_NEEDS, group_dataset_df
from salesmart.plans.registry import query

G = "canonical_group"
GROUPS = ["GIFT_LOW", "GIFT_HIGH", "GIFT_LARGE", "GIFT_COMBINED"]
CORR_FEATURES = ["sales_yoy_pct", "composition_curr_pct", "composition_prev_pct", "order_count",
                 "avg_order_price", "distinct_customers", "urgent_share_pct", "working_days", "calendar_days",
                 "weekend_days", "lunar_new_year_day", "mid_autumn_day", "has_lunar_new_year", "has_mid_autumn"]
INDICATORS = ["order_count", "avg_order_price", "distinct_customers", "urgent_share_pct"]
CONTROLS = ("has_lunar_new_year", "has_mid_autumn")
SEGMENT = "CASE WHEN report_year <= 1997 THEN 'before' ELSE 'after' END"


def _f(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _tcrit_sql(d: str, z: float) -> str:
    z3, z5, z7 = z ** 3, z ** 5, z ** 7
    dd = f"CAST({d} AS DOUBLE)"
    return (f"({_f(z)} + {_f((z3 + z) / 4)} / {dd} + {_f((5 * z5 + 16 * z3 + 3 * z) / 96)} / ({dd} * {dd})"
            f" + {_f((3 * z7 + 19 * z5 + 17 * z3 - 15 * z) / 384)} / ({dd} * {dd} * {dd}))")


def _pearson_sql(keys: str, src: str) -> str:
    return f"""
SELECT {keys}, ROUND(r, 6) AS pearson, n,
       ROUND(CASE WHEN n > 2 THEN r * sqrt((n - 2) / NULLIF(1 - r * r, 0)) END, 4) AS t_stat,
       CASE WHEN n - 2 < 1 THEN NULL
            WHEN abs(r * sqrt((n - 2) / NULLIF(1 - r * r, 0))) > {_tcrit_sql('n - 2', S.Z_995)} THEN '**'
            WHEN abs(r * sqrt((n - 2) / NULLIF(1 - r * r, 0))) > {_tcrit_sql('n - 2', S.Z_975)} THEN '*'
            ELSE '' END AS significance
FROM (SELECT {keys},
             covar_pop(x, y) / NULLIF(stddev_pop(CASE WHEN y IS NOT NULL THEN x END)
                                      * stddev_pop(CASE WHEN x IS NOT NULL THEN y END), 0) AS r,
             COUNT(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n
      FROM {src} GROUP BY {keys})"""


def _long_sql(features, extra=""):
    return "\nUNION ALL\n".join(
        f"SELECT {G}{extra}, '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CAST(sales_result AS DOUBLE) AS y FROM ds"
        for f in features)


LONG_LOCAL = {**DATASET_LOCAL, "long": _long_sql(CORR_FEATURES)}
_LAGGED = "\nUNION ALL\n".join(
    f"SELECT {G}, '{i}' AS indicator, {k} AS lag, "
    f"CAST(lag(CAST({i} AS DOUBLE), {k}) OVER (PARTITION BY {G} ORDER BY report_year, report_month) AS DOUBLE) AS x, "
    f"CAST(sales_result AS DOUBLE) AS y FROM ds" for i in INDICATORS for k in range(4))
LAG_LOCAL = {**DATASET_LOCAL, "lagged": _LAGGED, "lagcorr": _pearson_sql(f"{G}, indicator, lag", "lagged")}


def _ds(spark, sf):
    return group_dataset_df(spark, sf)


def _long(spark, sf, extra_keys=()):
    ds = _ds(spark, sf)
    if "segment" in extra_keys:
        ds = ds.withColumn("segment", F.when(F.col("report_year") <= 1997, "before").otherwise("after"))
    return S.to_long(ds, [G, *extra_keys], CORR_FEATURES)


@query("pearson", with_ctes(_pearson_sql(f"{G}, feature", "long"), *DATASET_NEEDS, local=LONG_LOCAL))
def q_pearson(spark, sf):
    """D9 + D14 + I6: r of sales vs every feature per group, with t and stars."""
    return S.pearson(_long(spark, sf), [G, "feature"])


@query("corr_matrix", with_ctes("SELECT feature, " + ", ".join(
    f"MAX(CASE WHEN {G} = '{g}' THEN pearson END) AS {g}" for g in GROUPS) + " FROM pc GROUP BY feature",
    *DATASET_NEEDS, local={**LONG_LOCAL, "pc": _pearson_sql(f"{G}, feature", "long")}))
def q_corr_matrix(spark, sf):
    """Correlation long -> feature x group matrix."""
    return S.corr_matrix(S.pearson(_long(spark, sf), [G, "feature"]), GROUPS)


@query("segment_corr", with_ctes(_pearson_sql(f"{G}, segment, feature", "long"), *DATASET_NEEDS,
                                 local={**DATASET_LOCAL, "long": _long_sql(CORR_FEATURES, f", {SEGMENT} AS segment")}))
def q_segment_corr(spark, sf):
    """Correlation before/after the 1998 threshold change."""
    return S.pearson(_long(spark, sf, ("segment",)), [G, "segment", "feature"])


@query("lag_corr", with_ctes("SELECT * FROM lagcorr", *DATASET_NEEDS, local=LAG_LOCAL))
def q_lag_corr(spark, sf):
    """R of sales vs indicators lagged 0-3 months."""
    return S.pearson(S.lagged_long(_ds(spark, sf), INDICATORS), [G, "indicator", "lag"])


@query("best_lag", with_ctes(f"""
SELECT {G}, indicator, lag AS best_lag, pearson FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {G}, indicator ORDER BY abs(pearson) DESC, lag) AS rn
  FROM lagcorr WHERE pearson IS NOT NULL) WHERE rn = 1""", *DATASET_NEEDS, local=LAG_LOCAL))
def q_best_lag(spark, sf):
    """Lag with the largest |r| per (group, indicator); smallest lag on ties."""
    return S.best_lag(S.pearson(S.lagged_long(_ds(spark, sf), INDICATORS), [G, "indicator", "lag"]))


@query("spearman", with_ctes(f"""
SELECT {G}, feature, ROUND(covar_pop(x, y) / NULLIF(stddev_pop(x) * stddev_pop(y), 0), 6) AS spearman, COUNT(*) AS n
FROM (SELECT {G}, feature,
             rank() OVER (PARTITION BY {G}, feature ORDER BY x) + (COUNT(*) OVER (PARTITION BY {G}, feature, x) - 1) / 2.0 AS x,
             rank() OVER (PARTITION BY {G}, feature ORDER BY y) + (COUNT(*) OVER (PARTITION BY {G}, feature, y) - 1) / 2.0 AS y
      FROM long WHERE x IS NOT NULL AND y IS NOT NULL)
GROUP BY {G}, feature""", *DATASET_NEEDS, local=LONG_LOCAL))
def q_spearman(spark, sf):
    """Rank correlation with average ranks for ties."""
    return S.spearman(_long(spark, sf), [G, "feature"])


PARTIAL_FEATURES = ["order_count", "avg_order_price", "distinct_customers", "urgent_share_pct", "working_days"]


def _r_sql(a, b):
    return f"covar_pop({a}, {b}) / NULLIF(stddev_pop({a}) * stddev_pop({b}), 0)"


def _pc_sql(ab, ac, bc):
    return f"(({ab}) - ({ac}) * ({bc})) / NULLIF(sqrt((1 - ({ac}) * ({ac})) * (1 - ({bc}) * ({bc}))), 0)"


_PL = "\nUNION ALL\n".join(
    f"SELECT {G}, '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CAST(sales_result AS DOUBLE) AS y, "
    f"CAST({CONTROLS[0]} AS DOUBLE) AS z1, CAST({CONTROLS[1]} AS DOUBLE) AS z2 FROM ds" for f in PARTIAL_FEATURES)


@query("partial_corr", with_ctes(f"""
SELECT {G}, feature, ROUND(rxy, 6) AS pearson,
       ROUND({_pc_sql(_pc_sql('rxy', 'rx1', 'ry1'), _pc_sql('rx2', 'rx1', 'r12'), _pc_sql('ry2', 'ry1', 'r12'))}, 6) AS partial_r,
       n
FROM (SELECT {G}, feature, {_r_sql('x', 'y')} AS rxy, {_r_sql('x', 'z1')} AS rx1, {_r_sql('y', 'z1')} AS ry1,
             {_r_sql('x', 'z2')} AS rx2, {_r_sql('y', 'z2')} AS ry2, {_r_sql('z1', 'z2')} AS r12, COUNT(*) AS n
      FROM pl WHERE x IS NOT NULL AND y IS NOT NULL AND z1 IS NOT NULL AND z2 IS NOT NULL
      GROUP BY {G}, feature)""", *DATASET_NEEDS, local={**DATASET_LOCAL, "pl": _PL}))
def q_partial_corr(spark, sf):
    """Partial correlation controlling for the two festival flags."""
    return S.partial_corr(_ds(spark, sf), PARTIAL_FEATURES, CONTROLS)


def _lift_sql(flag):
    f = f"COALESCE(CAST({flag} AS DOUBLE), 0) = 1"
    fm = O.avg_exact(f"CASE WHEN {f} THEN sales_result END", 2, 4)
    om = O.avg_exact(f"CASE WHEN NOT ({f}) THEN sales_result END", 2, 4)
    return (f"SELECT {G}, '{flag}' AS festival, fest_mean, other_mean, "
            f"ROUND(fest_mean * 100 / NULLIF(other_mean, 0), 4) AS lift_pct "
            f"FROM (SELECT {G}, {fm} AS fest_mean, {om} AS other_mean FROM ds GROUP BY {G})")


@query("festival_lift", with_ctes(_lift_sql("has_lunar_new_year") + "\nUNION ALL\n" + _lift_sql("has_mid_autumn"),
                                  *DATASET_NEEDS, local=DATASET_LOCAL))
def q_festival_lift(spark, sf):
    """Festival-month mean over other-month mean x 100, per group and festival."""
    ds = _ds(spark, sf)
    out = None
    for flag in CONTROLS:
        f = f"COALESCE(CAST({flag} AS DOUBLE), 0) = 1"
        g = ds.groupBy(G).agg(avg_exact(f"CASE WHEN {f} THEN sales_result END", 2, 4).alias("fest_mean"),
                              avg_exact(f"CASE WHEN NOT ({f}) THEN sales_result END", 2, 4).alias("other_mean"))
        g = g.select(G, F.lit(flag).alias("festival"), "fest_mean", "other_mean",
                     F.round(F.try_divide(F.col("fest_mean") * 100, F.col("other_mean")), 4).alias("lift_pct"))
        out = g if out is None else out.unionByName(g)
    return out


BREAK_IDX = 1998 * 12  # January 1998: last threshold change
_IDX = "(report_year * 12 + report_month - 1)"


@query("break_effect", with_ctes(f"""
SELECT {G}, mean_before, mean_after,
       ROUND((mean_after - mean_before) * 100 / NULLIF(mean_before, 0), 4) AS change_pct,
       ROUND(share_after - share_before, 4) AS share_delta_pts
FROM (SELECT {G},
             {O.avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX - 6} AND {_IDX} < {BREAK_IDX} THEN sales_result END", 2, 4)} AS mean_before,
             {O.avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX} AND {_IDX} < {BREAK_IDX + 6} THEN sales_result END", 2, 4)} AS mean_after,
             {O.avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX - 6} AND {_IDX} < {BREAK_IDX} THEN composition_curr_pct END", 4, 6)} AS share_before,
             {O.avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX} AND {_IDX} < {BREAK_IDX + 6} THEN composition_curr_pct END", 4, 6)} AS share_after
      FROM ds GROUP BY {G})""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_break_effect(spark, sf):
    """Six months before vs after the January 1998 threshold change."""
    ds = _ds(spark, sf)
    g = ds.groupBy(G).agg(
        avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX - 6} AND {_IDX} < {BREAK_IDX} THEN sales_result END", 2, 4)
        .alias("mean_before"),
        avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX} AND {_IDX} < {BREAK_IDX + 6} THEN sales_result END", 2, 4)
        .alias("mean_after"),
        avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX - 6} AND {_IDX} < {BREAK_IDX} THEN composition_curr_pct END", 4, 6)
        .alias("share_before"),
        avg_exact(f"CASE WHEN {_IDX} >= {BREAK_IDX} AND {_IDX} < {BREAK_IDX + 6} THEN composition_curr_pct END", 4, 6)
        .alias("share_after"))
    return g.select(G, "mean_before", "mean_after",
                    F.round(F.try_divide((F.col("mean_after") - F.col("mean_before")) * 100, F.col("mean_before")), 4)
                    .alias("change_pct"),
                    F.round(F.col("share_after") - F.col("share_before"), 4).alias("share_delta_pts"))


@query("month_rank", with_ctes(f"""
SELECT {G}, report_month, mean_sales,
       CAST(rank() OVER (PARTITION BY {G} ORDER BY mean_sales DESC, report_month) AS INTEGER) AS month_rank
FROM (SELECT {G}, report_month, {O.avg_exact('sales_result', 2, 4)} AS mean_sales FROM ds GROUP BY 1, 2)""",
    *DATASET_NEEDS, local=DATASET_LOCAL))
def q_month_rank(spark, sf):
    """Calendar-month mean per group and its rank."""
    ds = _ds(spark, sf)
    g = ds.groupBy(G, "report_month").agg(avg_exact("sales_result", 2, 4).alias("mean_sales"))
    from pyspark.sql import Window
    w = Window.partitionBy(G).orderBy(F.col("mean_sales").desc(), F.col("report_month"))
    return g.withColumn("month_rank", F.rank().over(w))


@query("group_share", with_ctes(f"""
SELECT report_year, {G}, annual_sales,
       ROUND(CAST(annual_sales AS DOUBLE) * 100 / NULLIF(SUM(CAST(annual_sales AS DOUBLE)) OVER (PARTITION BY report_year), 0), 4) AS share_pct
FROM (SELECT report_year, {G}, CAST(SUM(sales_result) AS DECIMAL(18,2)) AS annual_sales FROM ds
      WHERE {G} <> 'GIFT_COMBINED' GROUP BY 1, 2)""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_group_share(spark, sf):
    """Annual share of each group (combined excluded: it double counts)."""
    return S.group_share(_ds(spark, sf).filter(F.col(G) != "GIFT_COMBINED"))


@query("group_median", with_ctes(f"""
SELECT {G}, ROUND(median(CAST(sales_result AS DOUBLE)), 4) AS median_sales, COUNT(*) AS n FROM ds GROUP BY 1""",
    *DATASET_NEEDS, local=DATASET_LOCAL))
def q_group_median(spark, sf):
    """Exact (interpolated) median per group — the imputation/fallback value."""
    return _ds(spark, sf).groupBy(G).agg(
        F.round(F.median(F.col("sales_result").cast("double")), 4).alias("median_sales"),
        F.count(F.lit(1)).alias("n"))


_W = f"PARTITION BY {G} ORDER BY report_year, report_month"


@query("seasonal_parts", with_ctes(f"""
SELECT d.{G}, d.report_year, d.report_month, d.yc / 100.0 AS sales, d.n24 / 2400.0 AS trend,
       i.s_units / 2400.0 AS seasonal, (d.dev - i.s_units) / 2400.0 AS resid
FROM dt d LEFT JOIN (
  SELECT m.{G}, m.report_month, m.s_raw - c.centre AS s_units
  FROM (SELECT {G}, report_month, (2 * SUM(dev) + COUNT(dev)) // (2 * COUNT(dev)) AS s_raw FROM dt GROUP BY 1, 2) m
  JOIN (SELECT {G}, (2 * SUM(s_raw) + COUNT(s_raw)) // (2 * COUNT(s_raw)) AS centre
        FROM (SELECT {G}, report_month, (2 * SUM(dev) + COUNT(dev)) // (2 * COUNT(dev)) AS s_raw FROM dt GROUP BY 1, 2)
        GROUP BY 1) c ON c.{G} = m.{G}) i
  ON i.{G} = d.{G} AND i.report_month = d.report_month""", *DATASET_NEEDS, local={**DATASET_LOCAL, "dt0": f"""
SELECT {G}, report_year, report_month, yc,
       CASE WHEN COUNT(yc) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
            THEN 2 * SUM(yc) OVER ({_W} ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
                 - lag(yc, 6) OVER ({_W}) - lead(yc, 6) OVER ({_W}) END AS n24
FROM (SELECT *, CAST(sales_result * 100 AS BIGINT) AS yc FROM ds)""",
    "dt": "SELECT *, yc * 24 - n24 AS dev FROM dt0"}))
def q_seasonal_parts(spark, sf):
    """Classical decomposition (2x12 MA trend, month indices, residual), exact."""
    return S.seasonal_parts(_ds(spark, sf))


# K22 by LOESS: a series derived from the data with known parts
_PLANT = f"""
SELECT f.{G}, f.report_year, f.report_month, s.mid + s.mid / 200 * t AS trend, s.mid / 10 * sin(2 * pi() * f.report_month / 12) AS season,
       CASE WHEN t = 30 THEN s.mid / 2 ELSE 0.0 END AS shock
FROM (SELECT {G}, report_year, report_month, row_number() OVER (PARTITION BY {G} ORDER BY report_year, report_month) - 1 AS t FROM ds) f
JOIN (SELECT {G}, median(CAST(sales_result AS DOUBLE)) AS mid FROM ds GROUP BY 1) s ON s.{G} = f.{G}"""


@query("loess_planted", with_ctes(f"""
SELECT {G}, report_year, report_month, ROUND(trend / (trend + season), 3) AS trend_share,
       ROUND(season / (trend + season), 3) AS season_share, ROUND(shock / (trend + season), 3) AS shock_share
FROM plant""", *DATASET_NEEDS, local={**DATASET_LOCAL, "plant": _PLANT}))
def q_loess_planted(spark, sf):
    """A planted line, season and single outlier around each group's median are
    told apart by LOESS with robustness weights."""
    from pyspark.sql import Window
    ds = _ds(spark, sf)
    mid = ds.groupBy(G).agg(F.median(F.col("sales_result").cast("double")).alias("mid"))
    w = Window.partitionBy(G).orderBy("report_year", "report_month")
    rows = ds.select(G, "report_year", "report_month", (F.row_number().over(w) - 1).alias("t")).join(mid, G)
    plain = F.col("mid") + F.col("mid") / 200 * F.col("t") + F.col("mid") / 10 * F.sin(2 * F.pi() * F.col("report_month") / 12)
    rows = rows.select(G, "report_year", "report_month", (plain + F.when(F.col("t") == 30, F.col("mid") / 2).otherwise(0.0)).alias("v"))
    parts = S.loess_parts(rows, value="v")
    whole = F.col("trend") + F.col("seasonal")
    return parts.select(G, "report_year", "report_month", F.round(F.col("trend") / whole, 3).alias("trend_share"),
                        (F.round(F.col("seasonal") / whole, 3) + F.lit(0.0)).alias("season_share"),
                        (F.round(F.col("remainder") / whole, 3) + F.lit(0.0)).alias("shock_share"))


@query("loess_parts", with_ctes(f"""
SELECT {G}, report_year, report_month, CAST(sales_result AS DOUBLE) AS sales, TRUE AS adds_up, TRUE AS season_is_small FROM ds""",
    *DATASET_NEEDS, local=DATASET_LOCAL))
def q_loess_parts(spark, sf):
    """Every group's sales as trend, season and remainder, which add up to
    them; a year of seasonal terms nearly cancels against the year's sales."""
    from pyspark.sql import Window
    parts = S.loess_parts(_ds(spark, sf))
    year = Window.partitionBy(G, "report_year")
    total = F.abs(F.sum("seasonal").over(year)) <= 0.2 * F.sum(F.abs("value")).over(year)
    return parts.select(G, "report_year", "report_month", F.col("value").alias("sales"),
                        (F.abs(F.col("trend") + F.col("seasonal") + F.col("remainder") - F.col("value")) <= 1e-9 * F.abs("value")).alias("adds_up"),
                        total.alias("season_is_small"))
