"""Scalar text/number/calendar-payload queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.functions.text import date_from_filename, format_amount, normalise_name, parse_amount, parse_int
from salesmart.operators.macro import macro_long
from salesmart.functions.text import payload_int
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.registry import query
from salesmart.sources.tables import Tables


def _dtext(d, pad=False):
    m = F.month(d).cast("string")
    dd = F.dayofmonth(d).cast("string")
    if pad:
        m, dd = F.lpad(m, 2, "0"), F.lpad(dd, 2, "0")
    return F.concat_ws(".", F.year(d).cast("string"), m, dd)


FILE_NAME_SQL = """
SELECT d, CASE dayofyear(d) % 4
  WHEN 0 THEN 'DAYREPORT ' || strftime(d, '%Y') || '.' || CAST(month(d) AS VARCHAR) || '.' || CAST(day(d) AS VARCHAR) || '.pdf'
  WHEN 1 THEN 'DAYREPORT ' || strftime(d, '%Y.%m.%d') || ' copy.pdf'
  WHEN 2 THEN 'old ' || CAST(year(d) - 1 AS VARCHAR) || '.' || CAST(month(d) AS VARCHAR) || '.' || CAST(day(d) AS VARCHAR)
              || ' DAYREPORT ' || CAST(year(d) AS VARCHAR) || '.' || CAST(month(d) AS VARCHAR) || '.' || CAST(day(d) AS VARCHAR) || '.pdf'
  ELSE 'DAYREPORT ' || CAST(year(d) AS VARCHAR) || '.' || CAST(month(d) AS VARCHAR) || '.' || CAST(day(d) AS VARCHAR)
       || ' rev ' || CAST(year(d) AS VARCHAR) || '.13.45.pdf' END AS file_name
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""


@query("filename_dates", with_ctes("""
SELECT d AS source_date, file_name,
       CAST(list_filter(list_transform(regexp_extract_all(file_name, '(\\d{4})\\.(\\d{1,2})\\.(\\d{1,2})'),
                                       lambda x: try_strptime(x, '%Y.%m.%d')),
                        lambda x: x IS NOT NULL)[-1] AS DATE) AS report_date
FROM names""", local={"names": FILE_NAME_SQL}))
def q_filename_dates(spark, sf):
    """H1 over report file names built from order dates: zero-padded dates,
    an earlier date before the real one, an invalid trailing date."""
    t = Tables(spark, sf)
    d = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    k = F.dayofyear("d") % 4
    y = F.year("d").cast("string")
    name = (F.when(k == 0, F.concat(F.lit("DAYREPORT "), _dtext(F.col("d")), F.lit(".pdf")))
            .when(k == 1, F.concat(F.lit("DAYREPORT "), _dtext(F.col("d"), pad=True), F.lit(" copy.pdf")))
            .when(k == 2, F.concat(F.lit("old "), (F.year("d") - 1).cast("string"), F.lit("."),
                                   F.month("d").cast("string"), F.lit("."), F.dayofmonth("d").cast("string"),
                                   F.lit(" DAYREPORT "), _dtext(F.col("d")), F.lit(".pdf")))
            .otherwise(F.concat(F.lit("DAYREPORT "), _dtext(F.col("d")), F.lit(" rev "), y, F.lit(".13.45.pdf"))))
    return d.select(F.col("d").alias("source_date"), name.alias("file_name")) \
        .withColumn("report_date", date_from_filename("file_name"))


@query("parse_amounts", """
SELECT l_orderkey, l_linenumber, l_linenumber % 8 AS variant,
       CASE l_linenumber % 8 WHEN 0 THEN l_extendedprice WHEN 7 THEN l_extendedprice
            WHEN 1 THEN -l_extendedprice WHEN 5 THEN -l_extendedprice END AS value,
       CAST(trunc(CASE l_linenumber % 8 WHEN 0 THEN l_extendedprice WHEN 7 THEN l_extendedprice
            WHEN 1 THEN -l_extendedprice WHEN 5 THEN -l_extendedprice END) AS BIGINT) AS int_value
FROM lineitem""")
def q_parse_amounts(spark, sf):
    """H2/H3 over every lineitem price rendered as a report cell: separators,
    (n) and ( n ) negatives, the NULL tokens, a junk suffix, padding."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    v = F.col("l_extendedprice")
    k = F.col("l_linenumber") % 8
    txt = (F.when(k == 0, format_amount(v, 2))
           .when(k == 1, format_amount(-v, 2))
           .when(k == 2, F.lit("-")).when(k == 3, F.lit("N/A")).when(k == 4, F.lit("#N/A"))
           .when(k == 5, F.concat(F.lit("( "), F.format_number(v, 2), F.lit(" )")))
           .when(k == 6, F.concat(F.format_number(v, 2), F.lit("d")))
           .otherwise(F.concat(F.lit(" "), v.cast("string"), F.lit(" "))))
    return li.select("l_orderkey", "l_linenumber", k.alias("variant"),
                     parse_amount(txt).alias("value"), parse_int(txt).alias("int_value"))


@query("normalise_names", """
SELECT s_suppkey,
       CASE s_suppkey % 6 WHEN 4 THEN 'ALL 18 STORES' WHEN 5 THEN 'Business Development'
            ELSE replace(s_name, '#', '-') END AS store_name
FROM supplier""")
def q_normalise_names(spark, sf):
    """H4 over supplier labels: Unicode hyphens, merged two-line cells,
    padding and the alias table."""
    s = Tables(spark, sf).supplier.select("s_suppkey", F.translate("s_name", "#", "-").alias("n"))
    k = F.col("s_suppkey") % 6
    label = (F.when(k == 1, F.regexp_replace("n", "-", "−"))
             .when(k == 2, F.concat(F.lit("\n  "), F.regexp_replace("n", "-", "–"), F.lit("\r\nALL 19 STORES")))
             .when(k == 3, F.concat(F.lit("   "), F.col("n"), F.lit(" ")))
             .when(k == 4, F.lit("ALL 17 STORES")).when(k == 5, F.lit("BD"))
             .otherwise(F.col("n")))
    return s.select("s_suppkey", normalise_name(label).alias("store_name"))


@query("calendar_payload", with_ctes("""
SELECT s.report_year, s.report_month,
       COUNT(h.festival) FILTER (WHERE h.festival = 'LNY') > 0 AS has_lunar_new_year,
       CAST(MAX(CASE WHEN h.festival = 'LNY' THEN day(h.festival_date) END) AS INTEGER) AS lunar_new_year_day,
       COUNT(h.festival) FILTER (WHERE h.festival = 'MA') > 0 AS has_mid_autumn,
       CAST(MAX(CASE WHEN h.festival = 'MA' THEN day(h.festival_date) END) AS INTEGER) AS mid_autumn_day,
       CAST(len(list_filter(generate_series(CAST(s.month_start AS TIMESTAMP), CAST(last_day(s.month_start) AS TIMESTAMP),
                                            INTERVAL 1 DAY), lambda x: isodow(x) <= 5)) AS INTEGER) AS working_days,
       CAST(day(last_day(s.month_start)) AS INTEGER) AS calendar_days
FROM month_spine s LEFT JOIN holidays h
  ON year(h.festival_date) = s.report_year AND month(h.festival_date) = s.report_month
GROUP BY s.report_year, s.report_month, s.month_start""", "month_spine", "holidays"))
def q_calendar_payload(spark, sf):
    """H7 packing then H5/H6 parsing of the festival and working-day payloads."""
    long = macro_long(Tables(spark, sf))
    p = long.filter(F.col("metric").isin("lunar_calendar", "working_days")) \
        .groupBy("report_year", "report_month").pivot("metric", ["lunar_calendar", "working_days"]) \
        .agg(F.max("value"))
    lunar = F.coalesce(F.col("lunar_calendar"), F.lit(""))
    return p.select("report_year", "report_month",
                    lunar.contains("LNY").alias("has_lunar_new_year"),
                    payload_int(lunar, "LNY").alias("lunar_new_year_day"),
                    lunar.contains("MA").alias("has_mid_autumn"),
                    payload_int(lunar, "MA").alias("mid_autumn_day"),
                    payload_int("working_days", "WD").alias("working_days"),
                    payload_int("working_days", "CD").alias("calendar_days"))
