"""Indicator-table and calendar queries (A4 A8 A9 I3 C6 B18 H13-H16) and the
category report block (I4 H21 H22)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesmart.functions.calendar import days_in_month, month_spine, weekdays_in_month, working_days_fallback
from salesmart.functions.numeric import pct
from salesmart.functions.text import payload_int
from salesmart.operators import macro as MA
from salesmart.operators import report_grammar as RG
from salesmart.operators import reports_block as RB
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

MACRO_COLS = ["report_year", "report_month", "order_count", "avg_order_price", "distinct_customers",
              "urgent_share_pct", "has_lunar_new_year", "lunar_new_year_day", "has_mid_autumn", "mid_autumn_day",
              "working_days", "calendar_days", "weekend_days"]


@query("metric_pivot", with_ctes("SELECT " + ", ".join(MACRO_COLS) + " FROM macro", "macro"))
def q_metric_pivot(spark, sf):
    """Long metric rows -> wide month table over the spine."""
    return MA.macro_indicators(Tables(spark, sf)).select(*MACRO_COLS)


@query("metric_split", with_ctes("SELECT metric, report_year, report_month, value FROM macro_long", "macro_long"))
def q_metric_split(spark, sf):
    """Metric files written one folder per metric (CSV with header)
    into the shared checkpoint folder, then read back as a directory source."""
    t = Tables(spark, sf)
    path = f"{checkpoint_dir(spark).rstrip('/')}/salesmart-metrics/{uuid.uuid4().hex}"
    MA.write_metric_split(MA.macro_long(t), path, "csv")
    return MA.read_metric_dir(spark, path).select("metric", "report_year", "report_month", "value")


def _odd_metric_files(spark, sf) -> str:
    """Metric files as people send them: columns in another order and case, a
    byte order mark, or (by the length of the metric's name) no value column."""
    long = MA.macro_long(Tables(spark, sf)).select(
        "metric", "report_year", "report_month", F.coalesce("value", F.lit("")).alias("value"))
    kind = F.length("metric") % 3
    y, m, v = F.col("report_year").cast("string"), F.col("report_month").cast("string"), F.col("value")
    line = F.when(kind == 0, F.concat_ws(",", m, y, v)).when(kind == 1, F.concat_ws(",", y, v, m)).otherwise(F.concat_ws(",", y, m))
    head = F.when(kind == 0, "Month,YEAR,Value").when(kind == 1, "\ufeffyear, value ,month").otherwise("year,month")
    content = (long.groupBy("metric", head.alias("head")).agg(F.array_sort(F.collect_list(line)).alias("body"))
               .select("metric", F.concat(F.col("head"), F.lit("\r\n"), F.array_join("body", "\r\n")).alias("value")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/salesmart-metrics/{uuid.uuid4().hex}"
    content.write.partitionBy("metric").text(path)
    return path


@query("metric_headers", with_ctes("""
SELECT metric, report_year, report_month, COALESCE(value, '') AS value FROM macro_long WHERE length(metric) % 3 <> 2""",
    "macro_long"))
def q_metric_headers(spark, sf):
    """Columns found by header name; files without the three are skipped."""
    return MA.read_metric_dir(spark, _odd_metric_files(spark, sf))


@query("metric_rejects", with_ctes("""
SELECT DISTINCT metric, 'year,month' AS header FROM macro_long WHERE length(metric) % 3 = 2""", "macro_long"))
def q_metric_rejects(spark, sf):
    """The skipped metric files."""
    return MA.metric_rejects(spark, _odd_metric_files(spark, sf))


@query("working_days", with_ctes("""
SELECT report_year, report_month, calendar_days, weekday_count,
       CAST(CASE WHEN report_month % 4 = 0 THEN (calendar_days * 5) // 7 ELSE weekday_count END AS INTEGER) AS working_days,
       CAST(calendar_days - CASE WHEN report_month % 4 = 0 THEN (calendar_days * 5) // 7 ELSE weekday_count END AS INTEGER)
         AS weekend_days,
       report_month % 4 = 0 AS used_fallback
FROM (SELECT report_year, report_month, CAST(day(last_day(month_start)) AS INTEGER) AS calendar_days,
             CAST(len(list_filter(generate_series(CAST(month_start AS TIMESTAMP), CAST(last_day(month_start) AS TIMESTAMP),
                                                  INTERVAL 1 DAY), lambda x: isodow(x) <= 5)) AS INTEGER) AS weekday_count
      FROM month_spine)""", "month_spine"))
def q_working_days(spark, sf):
    """Calendar and weekday counts; months whose payload lacks
    the WD part (every 4th month here) fall back to calendar_days * 5 div 7."""
    spine = month_spine(Tables(spark, sf).orders, "o_orderdate")
    cd = days_in_month("month_start")
    wd = weekdays_in_month("month_start")
    payload = F.when(F.col("report_month") % 4 == 0, F.concat(F.lit("CD:"), cd.cast("string"))) \
        .otherwise(F.concat(F.lit("WD:"), wd.cast("string"), F.lit("|CD:"), cd.cast("string")))
    p = spine.select("report_year", "report_month", payload.alias("payload"), wd.alias("weekday_count"))
    cdp = payload_int("payload", "CD")
    work = working_days_fallback(payload_int("payload", "WD"), cdp)
    return p.select("report_year", "report_month", cdp.alias("calendar_days"),
                    F.col("weekday_count").cast("int").alias("weekday_count"),
                    work.cast("int").alias("working_days"), (cdp - work).cast("int").alias("weekend_days"),
                    payload_int("payload", "WD").isNull().alias("used_fallback"))


@query("period_unpivot", with_ctes("""
SELECT report_year, category, period_type, report_month, CAST(sales_result AS DOUBLE) AS sales_result
FROM category_fact""", "category_fact"))
def q_period_unpivot(spark, sf):
    """The 15-column period table (12 months, H1, H2, ANNUAL) per
    (year, category) unpivoted back to (period_type, month) rows."""
    wide = RB.period_wide(B.category_fact(Tables(spark, sf)))
    return RB.period_long(wide)


@query("category_block_long", with_ctes("""
SELECT report_year, report_month, period_type, category, CAST(sales_result AS DOUBLE) AS sales_result,
       sales_yoy_pct, composition_curr_pct, composition_prev_pct
FROM category_fact""", "category_fact"))
def q_category_block_long(spark, sf):
    """The yearly category report rendered as text blocks
    (4 metric rows x 15 period cells per category, wrapped labels) parsed back
    into long category rows."""
    t = Tables(spark, sf)
    return RB.parse_category_blocks(RB.render_category_blocks(B.category_fact(t)))


# --- the whole report by its grammar (I4 H21) -----------------------------------------
# labels as reports have them: plain, broken over lines, small and spaced, with arrows
_DAMAGE = """CASE (report_year + length(item)) % 4 WHEN 1 THEN replace(label, ' ', '\\n')
  WHEN 2 THEN concat('  ', replace(lower(label), ' ', '   '), ' ')
  WHEN 3 THEN replace(replace(label, ' DOWN', '↓'), ' UP', '↑') ELSE label END"""
_KPI_SQL = f"""
SELECT k.report_year, k.report_month, k.period_type, CAST(k.customer_count AS DOUBLE) AS customer_count,
       ROUND(CAST(k.customer_count AS DOUBLE) * 100.0 / NULLIF(CAST(p.customer_count AS DOUBLE), 0), 1) AS customer_yoy_pct,
       CAST(k.unit_price AS DOUBLE) AS unit_price,
       ROUND(CAST(k.unit_price AS DOUBLE) * 100.0 / NULLIF(CAST(p.unit_price AS DOUBLE), 0), 1) AS unit_price_yoy_pct,
       (100 * o.n // k.customer_count) / 100.0 AS turnover_curr, (100 * po.n // p.customer_count) / 100.0 AS turnover_prev,
       CAST(k.day_in_month_curr AS DOUBLE) AS day_in_month_curr, CAST(p.day_in_month_curr AS DOUBLE) AS day_in_month_prev,
       CAST(k.avg_daily_sales AS DOUBLE) AS avg_daily_sales,
       ROUND(CAST(k.avg_daily_sales AS DOUBLE) * 100.0 / NULLIF(CAST(p.avg_daily_sales AS DOUBLE), 0), 1) AS avg_daily_sales_yoy_pct
FROM kpi_fact k
LEFT JOIN kpi_fact p ON p.report_year + 1 = k.report_year AND p.report_month IS NOT DISTINCT FROM k.report_month AND p.period_type = k.period_type
LEFT JOIN n_orders o ON o.report_year = k.report_year AND o.report_month IS NOT DISTINCT FROM k.report_month
LEFT JOIN n_orders po ON po.report_year + 1 = k.report_year AND po.report_month IS NOT DISTINCT FROM k.report_month AND p.report_year IS NOT NULL"""
_N_ORDERS = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS report_year, CAST(month(o_orderdate) AS INTEGER) AS report_month, COUNT(*) AS n FROM orders GROUP BY 1, 2
UNION ALL SELECT CAST(year(o_orderdate) AS INTEGER), CAST(NULL AS INTEGER), COUNT(*) FROM orders GROUP BY 1"""


def _kpi_values(t):
    """All KPI measures of a period with last year's, as the report prints them."""
    month = F.year("o_orderdate").alias("report_year"), F.month("o_orderdate").alias("report_month")
    monthly = t.orders.groupBy(*month).agg(F.count(F.lit(1)).alias("n"))
    both = monthly.unionByName(monthly.groupBy("report_year").agg(F.sum("n").alias("n"), F.lit(None).cast("int").alias("report_month")))
    kpi = B.kpi_fact(t)
    own = kpi.join(both, (kpi.report_year == both.report_year) & kpi.report_month.eqNullSafe(both.report_month), "left").select(
        kpi.report_year, kpi.report_month, "period_type", "customer_count", "unit_price", "avg_daily_sales", "day_in_month_curr",
        (F.expr("(100 * n) div customer_count") / 100.0).alias("turnover_curr"))
    names = {"customer_count": "pc", "unit_price": "pu", "avg_daily_sales": "pa", "day_in_month_curr": "pd", "turnover_curr": "pt"}
    prev = own.select((F.col("report_year") + 1).alias("y"), F.col("report_month").alias("m"), F.col("period_type").alias("t"),
                      *[F.col(c).alias(a) for c, a in names.items()])
    j = own.join(prev, (F.col("report_year") == F.col("y")) & F.col("report_month").eqNullSafe(F.col("m")) & (F.col("period_type") == F.col("t")), "left")
    return j.select("report_year", "report_month", "period_type", *[F.col(c).cast("double").alias(n) for n, c in (
        ("customer_count", "customer_count"), ("unit_price", "unit_price"), ("turnover_curr", "turnover_curr"), ("turnover_prev", "pt"),
        ("day_in_month_curr", "day_in_month_curr"), ("day_in_month_prev", "pd"), ("avg_daily_sales", "avg_daily_sales"))],
        pct("customer_count", "pc", 1).alias("customer_yoy_pct"), pct("unit_price", "pu", 1).alias("unit_price_yoy_pct"),
        pct("avg_daily_sales", "pa", 1).alias("avg_daily_sales_yoy_pct"))


def _report_lines(t):
    """The yearly reports with damaged labels and lines that belong nowhere."""
    key = ["report_year", "report_month", "period_type"]
    cat = B.category_fact(t).select(*key, F.col("category").alias("item"), *[F.col(m).cast("double").alias(m) for m in RB.METRICS])
    values = cat.unpivot([*key, "item"], RB.METRICS, "measure", "value")
    item = F.create_map(*[x for b in RG.KPI_BLOCKS for m, _ in b.lines for x in (F.lit(m), F.lit(b.item))])
    kpi = _kpi_values(t)
    long = kpi.unpivot(key, [c for c in kpi.columns if c not in key], "measure", "value")
    values = values.unionByName(long.select(*key, item[F.col("measure")].alias("item"), "measure", "value"))
    lines = RG.render_report(values.where(F.col("value").isNotNull()), F.expr(_DAMAGE))
    stray = F.array(*[F.struct(F.lit(p).alias("pos"), F.array(F.lit(x), *[F.lit("1")] * 15).alias("cells")) for p, x in (
        (-1, ""), (66, ""), (1000, "Gift  999 sideways"), (1001, ""))])
    years = lines.select("report_year").distinct().select("report_year", F.explode(stray).alias("s")).select("report_year", "s.*")
    return lines.select("report_year", F.col("pos").cast("int").alias("pos"), "cells").unionByName(years)


@query("report_categories", with_ctes("""
SELECT report_year, report_month, period_type, category, CAST(sales_result AS DOUBLE) AS sales_result,
       sales_yoy_pct, composition_curr_pct, composition_prev_pct
FROM category_fact""", "category_fact"))
def q_report_categories(spark, sf):
    """The category blocks of reports with damaged labels."""
    return RG.category_table(RG.parse_report(_report_lines(Tables(spark, sf))))


@query("report_kpi", with_ctes(_KPI_SQL, "kpi_fact", local={"n_orders": _N_ORDERS}))
def q_report_kpi(spark, sf):
    """The KPI blocks below the categories, five blocks of two lines."""
    return RG.kpi_table(RG.parse_report(_report_lines(Tables(spark, sf))))


@query("report_unplaced", with_ctes("""
SELECT DISTINCT report_year, pos, label, reason FROM category_fact
CROSS JOIN (VALUES (-1, CAST(NULL AS VARCHAR), 'no label above'), (66, 'AVERAGE', 'beyond its block'),
                   (1000, 'GIFT 999 SIDEWAYS', 'unknown label'), (1001, 'GIFT 999 SIDEWAYS', 'unknown label')) s(pos, label, reason)""",
    "category_fact"))
def q_report_unplaced(spark, sf):
    """The lines that the report grammar can't place, and why."""
    return RG.unplaced_lines(_report_lines(Tables(spark, sf)))
