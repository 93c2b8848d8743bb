"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import marts as M
from salesmart.operators import quality as Q
from salesmart.operators.macro import macro_indicators
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_marts import CANONICAL_SQL, COMBINED_SQL
from salesmart.plans.registry import query
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables


def _range_sql():
    parts = []
    for c, (lo, hi) in Q.RANGE_CHECKS.items():
        if c not in ("sales_result", "customer_count", "unit_price", "transfer_amount"):
            continue
        nb = f"COUNT(*) FILTER (WHERE {c} < {lo})" if lo is not None else "COUNT(*) FILTER (WHERE FALSE)"
        na = f"COUNT(*) FILTER (WHERE {c} > {hi})" if hi is not None else "COUNT(*) FILTER (WHERE FALSE)"
        parts.append(f"SELECT '{c}' AS column_name, CAST({'NULL' if lo is None else lo} AS DOUBLE) AS lo, "
                     f"CAST({'NULL' if hi is None else hi} AS DOUBLE) AS hi, CAST({nb} AS BIGINT) AS n_below, "
                     f"CAST({na} AS BIGINT) AS n_above FROM fact_sales")
    return "\nUNION ALL\n".join(parts)


@query("range_audit", with_ctes(_range_sql(), "fact_sales"))
def q_range_audit(spark, sf):
    """B7 over the whole fact table (DAILY and MTD, all stores)."""
    return Q.range_audit(B.fact_sales(Tables(spark, sf)))


NULL_COLS = ["order_count", "avg_order_price", "distinct_customers", "urgent_share_pct",
             "lunar_new_year_day", "mid_autumn_day", "working_days", "calendar_days"]


@query("null_audit", with_ctes("SELECT " + ", ".join(
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS miss_{c}" for c in NULL_COLS) + " FROM macro", "macro"))
def q_null_audit(spark, sf):
    """D7 over the monthly indicator table (festival days are NULL in other months)."""
    return Q.null_audit(macro_indicators(Tables(spark, sf)), NULL_COLS)


@query("key_audit", with_ctes("""
SELECT 'fact_sales' AS check_name, CAST(report_date AS VARCHAR) || '|' || CAST(store_id AS VARCHAR) || '|' || record_type AS key_text, COUNT(*) AS n
FROM fact_sales GROUP BY report_date, store_id, record_type HAVING COUNT(*) > 1
UNION ALL
SELECT 'store_name', store_name, COUNT(*) FROM dim_store GROUP BY store_name HAVING COUNT(*) > 1
UNION ALL
SELECT 'store_code', store_code, COUNT(*) FROM dim_store GROUP BY store_code HAVING COUNT(*) > 1
UNION ALL
SELECT 'macro_month', CAST(report_year AS VARCHAR) || '|' || CAST(report_month AS VARCHAR), COUNT(*)
FROM macro GROUP BY report_year, report_month HAVING COUNT(*) > 1
UNION ALL
SELECT 'lineitem_key', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), COUNT(*)
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""", "fact_sales", "dim_store", "macro"))
def q_key_audit(spark, sf):
    """L1: unique keys of the fact, the store dimension, the indicator table
    and the raw lineitem line key (which the driver data duplicates)."""
    t = Tables(spark, sf)
    dim = B.dim_store(t)
    return Q.key_audit({
        "fact_sales": (B.fact_sales(t, with_customers=False), ["report_date", "store_id", "record_type"]),
        "store_name": (dim, ["store_name"]),
        "store_code": (dim, ["store_code"]),
        "macro_month": (macro_indicators(t), ["report_year", "report_month"]),
        "lineitem_key": (t.lineitem, ["l_orderkey", "l_linenumber"]),
    })


@query("enum_audit", with_ctes("""
SELECT 'record_type' AS check_name, record_type AS value, COUNT(*) AS n, record_type IN ('DAILY', 'MTD') AS is_valid
FROM fact_sales GROUP BY record_type
UNION ALL
SELECT 'store_type', store_type, COUNT(*),
       COALESCE(store_type IN ('store', 'HQ', 'Web', 'SR', 'BD', 'subtotal', 'grand_total'), FALSE)
FROM dim_store GROUP BY store_type
UNION ALL
SELECT 'period_type', period_type, COUNT(*), period_type IN ('MONTHLY', 'H1', 'H2', 'ANNUAL')
FROM category_fact GROUP BY period_type
UNION ALL
SELECT 'order_status', o_orderstatus, COUNT(*), COALESCE(o_orderstatus IN ('F', 'O'), FALSE)
FROM orders GROUP BY o_orderstatus""", "fact_sales", "dim_store", "category_fact"))
def q_enum_audit(spark, sf):
    """CHECK-style enumerations with their value distribution."""
    t = Tables(spark, sf)
    return Q.enum_audit({
        "record_type": (B.fact_sales(t, with_customers=False), "record_type", ("DAILY", "MTD")),
        "store_type": (B.dim_store(t), "store_type", ("store", "HQ", "Web", "SR", "BD", "subtotal", "grand_total")),
        "period_type": (B.category_fact(t), "period_type", ("MONTHLY", "H1", "H2", "ANNUAL")),
        "order_status": (t.orders, "o_orderstatus", ("F", "O")),
    })


@query("fk_audit", with_ctes("""
SELECT store_id, COUNT(*) AS n_rows FROM fact_sales
WHERE store_id NOT IN (SELECT store_id FROM dim_store WHERE store_id % 13 <> 0)
GROUP BY store_id""", "fact_sales", "dim_store"))
def q_fk_audit(spark, sf):
    """L2: fact rows whose store is missing from a dimension snapshot that
    predates the stores with id % 13 = 0."""
    t = Tables(spark, sf)
    return Q.fk_audit(B.fact_sales(t, with_customers=False), B.dim_store(t).filter(F.col("store_id") % 13 != 0))


@query("day1_daily_vs_mtd", with_ctes("""
SELECT COALESCE(d.report_date, m.report_date) AS report_date, COALESCE(d.store_id, m.store_id) AS store_id,
       d.sales_result AS daily_sales_result, d.customer_count AS daily_customer_count,
       m.sales_result AS mtd_sales_result, m.customer_count AS mtd_customer_count,
       CASE WHEN m.store_id IS NULL THEN 'daily_only' WHEN d.store_id IS NULL THEN 'mtd_only'
            WHEN d.sales_result IS NOT DISTINCT FROM m.sales_result
             AND d.customer_count IS NOT DISTINCT FROM m.customer_count THEN 'match' ELSE 'mismatch' END AS status
FROM (SELECT * FROM fact_sales WHERE record_type = 'DAILY' AND day(report_date) = 1) d
FULL OUTER JOIN (SELECT * FROM fact_sales WHERE record_type = 'MTD' AND day(report_date) = 1
                   AND store_id % 11 <> 0) m
  ON d.report_date = m.report_date AND d.store_id = m.store_id""", "fact_sales"))
def q_day1_daily_vs_mtd(spark, sf):
    """C12 over the fact, where the MTD lines of stores with id % 11 = 0 are
    missing from the day-1 reports (reported as daily_only, not an error).  The
    first day's MTD is a sum over that day alone, so only its lines are read."""
    t = Tables(spark, sf).only("lineitem", F.dayofmonth(F.col("l_shipdate").cast("date")) == 1)
    f = B.fact_sales(t).filter((F.col("record_type") == "DAILY") | (F.col("store_id") % 11 != 0))
    return Q.day1_daily_vs_mtd(f)


@query("composition_audit", with_ctes("""
SELECT report_year, report_month, ROUND(SUM(composition_curr_pct), 4) AS composition_sum,
       abs(ROUND(SUM(composition_curr_pct), 4) - 100) <= 0.5 AS ok
FROM category_fact WHERE period_type = 'MONTHLY' AND category <> 'TOTAL' GROUP BY 1, 2""", "category_fact"))
def q_composition_audit(spark, sf):
    return Q.composition_audit(B.category_fact(Tables(spark, sf)))


@query("total_audit", with_ctes("""
SELECT report_year, period_type, report_month, total_sales, category_sum,
       abs(total_sales - category_sum) <= abs(total_sales) * 0.01 AS ok
FROM (SELECT report_year, period_type, report_month,
             CAST(SUM(CASE WHEN category = 'TOTAL' THEN sales_result END) AS DECIMAL(18,2)) AS total_sales,
             CAST(SUM(CASE WHEN category <> 'TOTAL' THEN sales_result END) AS DECIMAL(18,2)) AS category_sum
      FROM category_fact GROUP BY 1, 2, 3)""", "category_fact"))
def q_total_audit(spark, sf):
    return Q.total_audit(B.category_fact(Tables(spark, sf)))


@query("half_year_audit", with_ctes("""
SELECT report_year, category, annual, h1_plus_h2,
       abs(annual - COALESCE(h1_plus_h2, 0)) <= abs(annual) * 0.01 AS ok
FROM (SELECT report_year, category,
             CAST(SUM(CASE WHEN period_type = 'ANNUAL' THEN sales_result END) AS DECIMAL(18,2)) AS annual,
             CAST(SUM(CASE WHEN period_type <> 'ANNUAL' THEN sales_result END) AS DECIMAL(18,2)) AS h1_plus_h2
      FROM category_fact WHERE period_type IN ('H1', 'H2', 'ANNUAL') GROUP BY 1, 2)""", "category_fact"))
def q_half_year_audit(spark, sf):
    return Q.half_year_audit(B.category_fact(Tables(spark, sf)))


@query("completeness_audit", with_ctes("""
SELECT p.report_year, p.category, p.n_periods, p.n_months, c.n_categories, p.n_periods = 15 AS complete
FROM (SELECT report_year, category, COUNT(*) AS n_periods, COUNT(DISTINCT report_month) AS n_months
      FROM category_fact GROUP BY 1, 2) p
JOIN (SELECT report_year, COUNT(DISTINCT category) AS n_categories FROM category_fact GROUP BY 1) c
  ON c.report_year = p.report_year""", "category_fact"))
def q_completeness_audit(spark, sf):
    return Q.completeness_audit(B.category_fact(Tables(spark, sf)))


@query("rule_audit", with_ctes("""
SELECT 'sales_non_negative' AS rule, COUNT(*) FILTER (WHERE sales_result IS NOT NULL) AS n_checked,
       COUNT(*) FILTER (WHERE sales_result < 0) AS n_violations FROM category_fact
UNION ALL
SELECT 'yoy_in_0_500', COUNT(*) FILTER (WHERE sales_yoy_pct IS NOT NULL),
       COUNT(*) FILTER (WHERE sales_yoy_pct <= 0 OR sales_yoy_pct >= 500) FROM category_fact""", "category_fact"))
def q_rule_audit(spark, sf):
    """Rules as rows over the category fact."""
    return Q.rule_audit(B.category_fact(Tables(spark, sf)))


@query("combined_check", with_ctes("""
SELECT c.report_year, c.report_month, c.sales_result AS combined_sales, l.sales_result AS low_sales,
       h.sales_result AS high_sales, CAST(abs(c.sales_result - (l.sales_result + h.sales_result)) AS DECIMAL(18,2)) AS diff,
       abs(c.sales_result - (l.sales_result + h.sales_result)) > 1 AS mismatch
FROM combined c
JOIN canonical l ON l.report_year = c.report_year AND l.report_month = c.report_month
 AND l.canonical_group = 'GIFT_LOW' AND l.period_type = 'MONTHLY'
JOIN canonical h ON h.report_year = c.report_year AND h.report_month = c.report_month
 AND h.canonical_group = 'GIFT_HIGH' AND h.period_type = 'MONTHLY'
WHERE c.period_type = 'MONTHLY'""", "category_fact", "gift_mapping",
    local={"canonical": CANONICAL_SQL, "combined": COMBINED_SQL}))
def q_combined_check(spark, sf):
    """C14: COMBINED = LOW + HIGH within 1 per month."""
    t = Tables(spark, sf)
    can = M.canonical_monthly(B.category_fact(t), B.gift_mapping(spark))
    return Q.combined_check(can, M.combined_monthly(can))
