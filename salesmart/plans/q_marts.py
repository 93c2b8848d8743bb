"""Mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import marts as M
from salesmart.operators.macro import macro_indicators
from salesmart.plans.oracle_base import avg_exact, with_ctes
from salesmart.plans.registry import query
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

YM = "CAST(year({d}) AS INTEGER) AS report_year, CAST(month({d}) AS INTEGER) AS report_month"


def ym(d="report_date"):
    return YM.format(d=d)


# --- daily / month-end -------------------------------------------------------
@query("daily_store_sales", with_ctes(f"""
SELECT f.report_date, {ym('f.report_date')}, CAST(day(f.report_date) AS INTEGER) AS report_day,
       dayname(f.report_date) AS weekday_name, d.store_id, d.store_code, d.store_name,
       d.store_short_name, d.store_type, f.customer_count, f.unit_price, f.sales_result,
       f.transfer_amount, f.sales_incl_result
FROM fact_sales f JOIN dim_store d ON d.store_id = f.store_id
WHERE f.record_type = 'DAILY' AND d.store_type IN ('store', 'HQ')""", "fact_sales", "dim_store"))
def q_daily_store_sales(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, grand_mtd=False)
    return M.daily_store_sales(fact, B.dim_store(t))


GT_MONTH_END = """
SELECT f.* FROM fact_sales f JOIN dim_store d ON d.store_id = f.store_id
WHERE d.store_name = 'GRAND TOTAL' AND rtrim(f.record_type) = 'MTD' AND f.report_date = last_day(f.report_date)"""


@query("grand_total_month_end", with_ctes(f"""
SELECT report_date, {ym()}, customer_count, unit_price, sales_result, transfer_amount,
       sales_incl_result, record_type FROM gt""", "fact_sales", "dim_store", local={"gt": GT_MONTH_END}))
def q_grand_total_month_end(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_daily=False, stores_mtd=False, grand_daily_rows=False)
    return M.grand_total_month_end(fact, B.dim_store(t))


# one pass over the months: both sides by conditional aggregation
MONTH_END_RECONCILE_SQL = with_ctes("""
SELECT y AS report_year, mo AS report_month, max(report_date) FILTER (closing) AS month_end_date,
       CAST(max(net) FILTER (closing) AS DECIMAL(18,2)) AS mtd_calc_incl,
       CAST(sum(incl) FILTER (shop_day) AS DECIMAL(18,2)) AS daily_sum_sales_incl,
       CAST(CAST(max(net) FILTER (closing) AS DECIMAL(18,2))
            - CAST(sum(incl) FILTER (shop_day) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS diff
FROM sides GROUP BY y, mo HAVING bool_or(closing)""", "fact_sales", "dim_store", local={"sides": """
SELECT CAST(year(report_date) AS INTEGER) AS y, CAST(month(report_date) AS INTEGER) AS mo, report_date,
       coalesce(sales_result, 0) + coalesce(transfer_amount, 0) AS net, coalesce(sales_incl_result, 0) AS incl,
       record_type = 'MTD' AND store_name = 'GRAND TOTAL' AND report_date = last_day(report_date) AS closing,
       record_type = 'DAILY' AND store_type IN ('store', 'HQ') AS shop_day
FROM fact_sales JOIN dim_store USING (store_id)"""})


def month_end_reconcile_df(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, with_customers=False)
    return M.month_end_reconcile(fact, B.dim_store(t))


query("month_end_reconcile", MONTH_END_RECONCILE_SQL)(month_end_reconcile_df)


@query("mtd_running", with_ctes("""
SELECT report_date, store_id, sales_result,
       CAST(SUM(sales_result) OVER w AS DECIMAL(18,2)) AS mtd_sales,
       CAST(SUM(sales_incl_result) OVER w AS DECIMAL(18,2)) AS mtd_sales_incl
FROM fact_sales f
WHERE record_type = 'DAILY' AND store_id IN (SELECT store_id FROM dim_store WHERE store_type IN ('store', 'HQ'))
WINDOW w AS (PARTITION BY store_id, date_trunc('month', report_date) ORDER BY report_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", "fact_sales", "dim_store"))
def q_mtd_running(spark, sf):
    t = Tables(spark, sf)
    return M.mtd_running(B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, grand_mtd=False,
                                      with_customers=False), B.dim_store(t))


@query("yoy_month", with_ctes("""
SELECT m.report_year, m.report_month, m.sales_result, p.sales_result AS prev_sales_result,
       ROUND(CAST(m.sales_result AS DOUBLE) * 100.0 / NULLIF(CAST(p.sales_result AS DOUBLE), 0), 2) AS yoy_pct
FROM m LEFT JOIN m p ON p.report_year + 1 = m.report_year AND p.report_month = m.report_month""",
    "fact_sales", "dim_store", local={"gt": GT_MONTH_END,
                                      "m": f"SELECT {ym()}, sales_result FROM gt"}))
def q_yoy_month(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_daily=False, stores_mtd=False, grand_daily_rows=False, with_customers=False)
    return M.yoy_month(M.grand_month_end_sales(fact, B.dim_store(t)))


@query("budget_attainment", with_ctes("""
SELECT sm.store_code, sm.report_year, sm.report_month, sm.actual_sales, b.budget_sales,
       ROUND(CAST(sm.actual_sales AS DOUBLE) * 100.0 / NULLIF(CAST(b.budget_sales AS DOUBLE), 0), 2) AS attainment_pct
FROM sm LEFT JOIN b ON b.store_code = sm.store_code AND b.report_year = sm.report_year
                    AND b.report_month = sm.report_month""", "fact_sales", "dim_store", local={
    "sm": f"""
SELECT d.store_code, {ym('f.report_date')}, CAST(SUM(f.sales_result) AS DECIMAL(18,2)) AS actual_sales
FROM fact_sales f JOIN dim_store d ON d.store_id = f.store_id
WHERE f.record_type = 'DAILY' AND d.store_type IN ('store', 'HQ') GROUP BY 1, 2, 3""",
    "b": """
SELECT store_code, report_year + 1 AS report_year, report_month,
       CAST(actual_sales * 1.05 AS DECIMAL(18,2)) AS budget_sales FROM sm"""}))
def q_budget_attainment(spark, sf):
    t = Tables(spark, sf)
    sm = M.store_month_sales(B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, grand_mtd=False,
                                          with_customers=False), B.dim_store(t))
    return M.budget_attainment(sm, M.budget_from_history(sm))


@query("area_rollup", with_ctes("""
SELECT d.area, d.store_type, CAST(SUM(f.sales_result) AS DECIMAL(18,2)) AS sales_result,
       COUNT(*) AS n_rows, CAST(GROUPING(d.area, d.store_type) AS INTEGER) AS grouping_level
FROM fact_sales f JOIN dim_store d ON d.store_id = f.store_id
WHERE f.record_type = 'DAILY' AND d.store_type <> 'grand_total'
GROUP BY ROLLUP (d.area, d.store_type)""", "fact_sales", "dim_store"))
def q_area_rollup(spark, sf):
    t = Tables(spark, sf)
    return M.area_rollup(B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, grand_mtd=False,
                                      with_customers=False), B.dim_store(t))


CAL_SQL = """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month,
       CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INTEGER) AS week_num,
       CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
       CAST(year(d) * 100 + month(d) AS INTEGER) AS yyyymm,
       CAST(year(d) * 100 + (dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INTEGER) AS yyyyww,
       strftime(d, '%a') AS weekday_short
FROM (SELECT unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)),
                                    INTERVAL 1 DAY)) AS d FROM lineitem)"""


@query("date_dimension", with_ctes("SELECT * FROM cal", local={"cal": CAL_SQL}))
def q_date_dimension(spark, sf):
    t = Tables(spark, sf)
    return M.date_dimension(t.lineitem.select(F.col("l_shipdate").cast("date").alias("report_date")))


@query("date_dim_join", with_ctes("""
SELECT c.year, c.week_num, c.yyyyww, CAST(SUM(f.sales_result) AS DECIMAL(18,2)) AS sales_result,
       COUNT(*) AS n_days
FROM fact_sales f JOIN cal c ON c.date = f.report_date
WHERE f.record_type = 'DAILY' AND f.store_id IN (SELECT store_id FROM dim_store WHERE store_name = 'GRAND TOTAL')
GROUP BY 1, 2, 3""", "fact_sales", "dim_store", local={"cal": CAL_SQL}))
def q_date_dim_join(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_daily=False, stores_mtd=False, grand_mtd=False, with_customers=False)
    cal = M.date_dimension(t.lineitem.select(F.col("l_shipdate").cast("date").alias("report_date")))
    return M.date_dim_join(fact, B.dim_store(t), cal)


# --- category / canonical group marts -----------------------------------------
CANON_AGG = f"""CAST(SUM(f.sales_result) AS DECIMAL(18,2)) AS sales_result,
       ROUND(SUM(f.composition_curr_pct), 4) AS composition_curr_pct,
       ROUND(SUM(f.composition_prev_pct), 4) AS composition_prev_pct,
       {avg_exact("f.sales_yoy_pct", 1, 4)} AS sales_yoy_pct"""
CANONICAL_SQL = f"""
SELECT f.report_year, f.report_month, f.period_type, canonical_group, threshold_floor, threshold_ceiling, {CANON_AGG}
FROM category_fact f JOIN gift_mapping ON source_category = f.category
WHERE f.period_type = 'MONTHLY' GROUP BY ALL"""
COMBINED_SQL = """
SELECT * FROM (SELECT report_year, report_month, period_type, 'GIFT_COMBINED' AS canonical_group,
       CAST(SUM(sales_result) FILTER (part) AS DECIMAL(18,2)) AS sales_result,
       ROUND(SUM(composition_curr_pct) FILTER (part), 4) AS composition_curr_pct,
       ROUND(SUM(composition_prev_pct) FILTER (part), 4) AS composition_prev_pct
  FROM (SELECT *, canonical_group <> 'GIFT_LARGE' AS part FROM canonical)
  GROUP BY report_year, report_month, period_type HAVING bool_or(part))"""


def _canonical(spark, sf):
    t = Tables(spark, sf)
    return M.canonical_monthly(B.category_fact(t), B.gift_mapping(spark))


@query("canonical_monthly", with_ctes("SELECT * FROM canonical", "category_fact", "gift_mapping",
                                      local={"canonical": CANONICAL_SQL}))
def q_canonical_monthly(spark, sf):
    return _canonical(spark, sf)


@query("canonical_monthly_by_year", with_ctes(f"""
SELECT f.report_year, f.report_month, f.period_type, m.canonical_group, m.threshold_floor, m.threshold_ceiling,
       {CANON_AGG}
FROM category_fact f JOIN gift_mapping_by_year m
  ON m.raw_category = f.category AND f.report_year BETWEEN m.year_from AND m.year_to
WHERE f.period_type = 'MONTHLY' GROUP BY 1, 2, 3, 4, 5, 6""", "category_fact", "gift_mapping_by_year"))
def q_canonical_monthly_by_year(spark, sf):
    t = Tables(spark, sf)
    return M.canonical_monthly_by_year(B.category_fact(t), B.gift_mapping_by_year(spark))


@query("combined_monthly", with_ctes("SELECT * FROM combined", "category_fact", "gift_mapping",
                                     local={"canonical": CANONICAL_SQL, "combined": COMBINED_SQL}))
def q_combined_monthly(spark, sf):
    return M.combined_monthly(_canonical(spark, sf))


@query("combined_yoy", with_ctes("""
SELECT c.report_year, c.report_month, c.sales_result, p.sales_result AS prev_sales_result,
       ROUND(CAST(c.sales_result AS DOUBLE) * 100.0 / NULLIF(CAST(p.sales_result AS DOUBLE), 0), 2) AS yoy_pct
FROM combined c LEFT JOIN combined p ON p.report_year + 1 = c.report_year AND p.report_month = c.report_month""",
    "category_fact", "gift_mapping", local={"canonical": CANONICAL_SQL, "combined": COMBINED_SQL}))
def q_combined_yoy(spark, sf):
    c = M.combined_monthly(_canonical(spark, sf)).select("report_year", "report_month", "sales_result")
    return M.yoy_month(c)


# every category of a month in one row by conditional aggregation
_CATEGORY_VALUES = [("monthly_total_sales", "sales_result", "= 'TOTAL'"), ("total_yoy_pct", "sales_yoy_pct", "= 'TOTAL'"),
                    ("gift_5000_sales", "sales_result", "= 'GIFT_5000_UP'"),
                    ("gift_5000_yoy_pct", "sales_yoy_pct", "= 'GIFT_5000_UP'"),
                    ("gift_floor_category", "category", "LIKE 'GIFT_%_DOWN'"),
                    ("gift_floor_sales", "sales_result", "LIKE 'GIFT_%_DOWN'"),
                    ("gift_floor_yoy_pct", "sales_yoy_pct", "LIKE 'GIFT_%_DOWN'"),
                    ("gram_cookies_sales", "sales_result", "= 'GRAM_COOKIES'"), ("fb_sales", "sales_result", "= 'FB'"),
                    ("total_composition_curr_pct", "composition_curr_pct", "= 'TOTAL'"),
                    ("gift_5000_composition_curr_pct", "composition_curr_pct", "= 'GIFT_5000_UP'"),
                    ("gift_floor_composition_curr_pct", "composition_curr_pct", "LIKE 'GIFT_%_DOWN'")]
ANALYSIS_SQL = f"""
SELECT * FROM (
  SELECT report_year, report_month, {", ".join(f"max({c}) FILTER (category {p}) AS {n}" for n, c, p in _CATEGORY_VALUES)}
  FROM category_fact WHERE period_type = 'MONTHLY' GROUP BY ALL HAVING bool_or(category = 'TOTAL'))
LEFT JOIN (SELECT report_year, report_month, customer_count, unit_price, avg_daily_sales
           FROM kpi_fact WHERE period_type = 'MONTHLY') USING (report_year, report_month)
LEFT JOIN (SELECT report_year, report_month, {", ".join(M.MACRO_MART_COLS)} FROM macro) USING (report_year, report_month)
LEFT JOIN (SELECT CAST(year(report_date) AS INTEGER) AS report_year, CAST(month(report_date) AS INTEGER) AS report_month,
                  arg_max(sales_result, report_date) AS report_mtd_sales,
                  arg_max(customer_count, report_date) AS report_customers FROM gt GROUP BY ALL)
  USING (report_year, report_month)"""
ANALYSIS_NEEDS = ("category_fact", "kpi_fact", "macro", "fact_sales", "dim_store")


def _analysis_inputs(spark, sf):
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_daily=False, stores_mtd=False, grand_daily_rows=False)
    return B.category_fact(t), B.kpi_fact(t), macro_indicators(t), fact, B.dim_store(t)


@query("analysis_monthly", with_ctes("SELECT * FROM a", *ANALYSIS_NEEDS,
                                     local={"gt": GT_MONTH_END, "a": ANALYSIS_SQL}))
def q_analysis_monthly(spark, sf):
    return M.analysis_monthly(*_analysis_inputs(spark, sf))


@query("analysis_monthly_onepass", with_ctes("SELECT * FROM a", *ANALYSIS_NEEDS,
                                             local={"gt": GT_MONTH_END, "a": ANALYSIS_SQL}))
def q_analysis_monthly_onepass(spark, sf):
    return M.analysis_monthly_onepass(*_analysis_inputs(spark, sf))


@query("prediction_inputs", with_ctes("SELECT " + ", ".join(M.PREDICTION_INPUT_COLS) + " FROM a",
                                      *ANALYSIS_NEEDS, local={"gt": GT_MONTH_END, "a": ANALYSIS_SQL}))
def q_prediction_inputs(spark, sf):
    return M.prediction_inputs(M.analysis_monthly_onepass(*_analysis_inputs(spark, sf)))


@query("category_vs_sales_reconcile", with_ctes("""
SELECT report_year, report_month, monthly_total_sales AS category_total_sales, report_mtd_sales,
       ROUND(abs(t - CAST(report_mtd_sales AS DOUBLE)) * 100.0 / nullif(t, 0), 6) AS diff_pct
FROM (SELECT *, CAST(monthly_total_sales AS DOUBLE) AS t FROM a)""", *ANALYSIS_NEEDS, local={"gt": GT_MONTH_END, "a": ANALYSIS_SQL}))
def q_category_vs_sales_reconcile(spark, sf):
    return M.category_vs_sales_reconcile(M.analysis_monthly_onepass(*_analysis_inputs(spark, sf)))


# the rows of all groups by name, then the month's indicators joined once
DATASET_SQL = """
SELECT * EXCLUDE (period_type)
FROM (FROM canonical UNION ALL BY NAME FROM combined) LEFT JOIN macro USING (report_year, report_month)
WHERE period_type = 'MONTHLY'"""
DATASET_LOCAL = {"canonical": CANONICAL_SQL, "combined": COMBINED_SQL, "ds": DATASET_SQL}
DATASET_NEEDS = ("category_fact", "gift_mapping", "macro")


def group_dataset_df(spark, sf):
    """The group dataset (groups x months) that features, statistics and
    forecasts read many times: materialised once per query."""
    t = Tables(spark, sf)
    return t.memo("group_dataset", lambda: M.group_analysis_dataset(
        M.canonical_monthly(B.category_fact(t), B.gift_mapping(spark)), macro_indicators(t)))


query("group_analysis_dataset", with_ctes("SELECT * FROM ds", *DATASET_NEEDS, local=DATASET_LOCAL))(group_dataset_df)


@query("group_annual_summary", with_ctes(f"""
SELECT report_year, canonical_group, CAST(SUM(sales_result) AS DECIMAL(18,2)) AS annual_sales,
       {avg_exact("sales_yoy_pct", 4, 6)} AS annual_avg_yoy, {avg_exact("order_count", 0, 4)} AS avg_order_count,
       {avg_exact("urgent_share_pct", 4, 6)} AS avg_urgent_share_pct
FROM ds GROUP BY 1, 2""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_group_annual_summary(spark, sf):
    return M.group_annual_summary(group_dataset_df(spark, sf))


@query("peak_calendar", with_ctes("""
SELECT report_year, canonical_group, report_month, sales_result FROM (
  SELECT report_year, canonical_group, report_month, sales_result,
         ROW_NUMBER() OVER (PARTITION BY report_year, canonical_group
                            ORDER BY sales_result DESC NULLS LAST, report_month ASC) AS rn
  FROM ds) WHERE rn <= 3""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_peak_calendar(spark, sf):
    return M.peak_calendar(group_dataset_df(spark, sf))


@query("category_monthly", with_ctes("""
SELECT report_year, report_month, category, sales_result, sales_yoy_pct, composition_curr_pct, composition_prev_pct
FROM category_fact WHERE period_type = 'MONTHLY'""", "category_fact"))
def q_category_monthly(spark, sf):
    return M.category_monthly(B.category_fact(Tables(spark, sf)))


@query("category_annual", with_ctes("""
SELECT c.report_year, c.category, c.sales_result AS annual_sales, c.sales_yoy_pct AS annual_yoy_pct,
       c.composition_curr_pct, k.customer_count AS annual_customers, k.unit_price AS annual_unit_price,
       k.avg_daily_sales
FROM category_fact c LEFT JOIN kpi_fact k ON k.report_year = c.report_year AND k.period_type = 'ANNUAL'
WHERE c.period_type = 'ANNUAL'""", "category_fact", "kpi_fact"))
def q_category_annual(spark, sf):
    t = Tables(spark, sf)
    return M.category_annual(B.category_fact(t), B.kpi_fact(t))


@query("category_half_year", with_ctes("""
SELECT report_year, period_type, category, sales_result, sales_yoy_pct
FROM category_fact WHERE period_type IN ('H1', 'H2')""", "category_fact"))
def q_category_half_year(spark, sf):
    return M.category_half_year(B.category_fact(Tables(spark, sf)))
