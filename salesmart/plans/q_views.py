"""The published views (A13): defined over each other, read back through SQL.

Each view has a query of its own, checked against the oracle of the mart that it
publishes.
"""

from __future__ import annotations

from salesmart.operators import marts as M
from salesmart.operators.catalogue import Catalogue
from salesmart.operators.macro import macro_indicators
from salesmart.plans import q_marts  # noqa: F401 - registers the marts' oracles
from salesmart.plans.registry import ORACLES, query
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

CATALOGUE = Catalogue()
for _name in ("fact_sales", "dim_store", "fact_category", "fact_kpi", "dim_gift_mapping", "fact_indicator"):
    CATALOGUE.add(_name, base=True)

_MONTH = "year(report_date) AS report_year, month(report_date) AS report_month"
CATALOGUE.add("vw_store_fact", ["fact_sales", "dim_store"], f"""
SELECT * EXCEPT (record_type), {_MONTH}, rtrim(record_type) AS record_type FROM fact_sales JOIN dim_store USING (store_id)""")
CATALOGUE.add("vw_daily_store_sales", ["vw_store_fact"], """
SELECT * EXCEPT (record_type, area, display_order, is_active), day(report_date) AS report_day,
       date_format(report_date, 'EEEE') AS weekday_name
FROM vw_store_fact WHERE record_type = 'DAILY' AND store_type IN ('store', 'HQ')""")
CATALOGUE.add("vw_daily_grand_total", ["vw_store_fact"], f"""
SELECT report_date, report_year, report_month, record_type, customer_count, unit_price, sales_result, transfer_amount, sales_incl_result
FROM vw_store_fact WHERE store_name = '{M.GRAND_TOTAL}' AND record_type = 'MTD' AND report_date = last_day(report_date)""")
CATALOGUE.add("vw_month_end_reconcile", ["vw_daily_grand_total", "vw_daily_store_sales"], """
SELECT *, CAST(mtd_calc_incl - daily_sum_sales_incl AS DECIMAL(18, 2)) AS diff
FROM (SELECT report_year, report_month, report_date AS month_end_date,
             CAST(ifnull(sales_result, 0) + ifnull(transfer_amount, 0) AS DECIMAL(18, 2)) AS mtd_calc_incl FROM vw_daily_grand_total)
NATURAL LEFT JOIN (SELECT report_year, report_month, CAST(sum(ifnull(sales_incl_result, 0)) AS DECIMAL(18, 2)) AS daily_sum_sales_incl
                   FROM vw_daily_store_sales GROUP BY ALL)""")

CATALOGUE.add("vw_category_monthly", ["fact_category"], """
SELECT report_year, report_month, category, sales_result, sales_yoy_pct, composition_curr_pct, composition_prev_pct
FROM fact_category WHERE period_type = 'MONTHLY'""")
CATALOGUE.add("vw_category_annual", ["fact_category", "fact_kpi"], """
SELECT report_year, category, c.sales_result AS annual_sales, c.sales_yoy_pct AS annual_yoy_pct, c.composition_curr_pct,
       k.customer_count AS annual_customers, k.unit_price AS annual_unit_price, k.avg_daily_sales
FROM fact_category c LEFT JOIN (SELECT * FROM fact_kpi WHERE period_type = 'ANNUAL') k USING (report_year)
WHERE c.period_type = 'ANNUAL'""")
CATALOGUE.add("vw_category_half_year", ["fact_category"], """
SELECT report_year, period_type, category, sales_result, sales_yoy_pct FROM fact_category WHERE period_type IN ('H1', 'H2')""")

CATALOGUE.add("vw_gift_canonical_monthly", ["fact_category", "dim_gift_mapping"], build=M.canonical_monthly)
CATALOGUE.add("vw_gift_combined_monthly", ["vw_gift_canonical_monthly"], """
SELECT report_year, report_month, period_type, 'GIFT_COMBINED' AS canonical_group,
       CAST(sum(sales_result) AS DECIMAL(18, 2)) AS sales_result, round(sum(composition_curr_pct), 4) AS composition_curr_pct,
       round(sum(composition_prev_pct), 4) AS composition_prev_pct
FROM vw_gift_canonical_monthly WHERE canonical_group <> 'GIFT_LARGE' GROUP BY ALL""")
CATALOGUE.add("vw_gift_analysis_dataset", ["vw_gift_canonical_monthly", "fact_indicator"], build=M.group_analysis_dataset)
CATALOGUE.add("vw_gift_monthly_with_macro", ["vw_gift_analysis_dataset"], "FROM vw_gift_analysis_dataset")
CATALOGUE.add("vw_gift_annual_summary", ["vw_gift_analysis_dataset"], build=M.group_annual_summary)
CATALOGUE.add("vw_gift_peak_calendar", ["vw_gift_analysis_dataset"], """
SELECT report_year, canonical_group, report_month, sales_result
FROM (SELECT *, row_number() OVER (PARTITION BY report_year, canonical_group
                                   ORDER BY sales_result DESC NULLS LAST, report_month) AS place FROM vw_gift_analysis_dataset)
WHERE place <= 3""")

CATALOGUE.add("vw_analysis_monthly", ["fact_category", "fact_kpi", "fact_indicator", "fact_sales", "dim_store"],
              build=M.analysis_monthly_onepass)
CATALOGUE.add("vw_prediction_inputs", ["vw_analysis_monthly"], f"SELECT {', '.join(M.PREDICTION_INPUT_COLS)} FROM vw_analysis_monthly")
CATALOGUE.add("vw_category_vs_sales_reconcile", ["vw_analysis_monthly"], """
SELECT report_year, report_month, category_total_sales, report_mtd_sales,
       round(try_divide(abs(total - CAST(report_mtd_sales AS DOUBLE)) * 100, total), 6) AS diff_pct
FROM (SELECT *, monthly_total_sales AS category_total_sales, CAST(monthly_total_sales AS DOUBLE) AS total FROM vw_analysis_monthly)""")

#: view -> the mart whose oracle it must equal
MART_OF = {
    "vw_daily_store_sales": "daily_store_sales", "vw_daily_grand_total": "grand_total_month_end",
    "vw_month_end_reconcile": "month_end_reconcile", "vw_category_monthly": "category_monthly",
    "vw_category_annual": "category_annual", "vw_category_half_year": "category_half_year",
    "vw_gift_canonical_monthly": "canonical_monthly", "vw_gift_combined_monthly": "combined_monthly",
    "vw_gift_analysis_dataset": "group_analysis_dataset", "vw_gift_monthly_with_macro": "group_analysis_dataset",
    "vw_gift_annual_summary": "group_annual_summary", "vw_gift_peak_calendar": "peak_calendar",
    "vw_analysis_monthly": "analysis_monthly", "vw_prediction_inputs": "prediction_inputs",
    "vw_category_vs_sales_reconcile": "category_vs_sales_reconcile",
}


def bases(spark, sf: str) -> dict:
    """Builders of the base views over the driver tables."""
    t = Tables(spark, sf)
    return {"fact_sales": lambda: B.fact_sales(t), "dim_store": lambda: B.dim_store(t), "fact_category": lambda: B.category_fact(t),
            "fact_kpi": lambda: B.kpi_fact(t), "dim_gift_mapping": lambda: B.gift_mapping(spark),
            "fact_indicator": lambda: macro_indicators(t)}


def _register(view: str, mart: str) -> None:
    def run(spark, sf):
        CATALOGUE.publish(spark, bases(spark, sf), [view])
        return spark.sql(f"SELECT * FROM {view}")
    run.__doc__ = f"A13: the view {view}, published with all that it reads and read back by SQL."
    query(view, ORACLES[mart])(run)


for _view, _mart in MART_OF.items():
    _register(_view, _mart)
