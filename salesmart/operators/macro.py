"""Monthly indicator table.

The reference compiles ~20 single-metric CSV files (year, month, value) into a
wide month table.  Here the long metric frame is derived by Spark from
``orders`` (so it grows with the data), can be written one folder per metric
(A9) and read back as a directory of CSVs (A4), and is pivoted to the wide
month table over a calendar spine (I3, C6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.calendar import (days_in_month, month_spine, weekdays_in_month,
                                          working_days_fallback, weekend_days)
from salesmart.functions.text import payload_int
from salesmart.sources.bindings import LUNAR_NEW_YEAR, MID_AUTUMN
from salesmart.sources.tables import Tables

# Fixed output column list of the wide table (B18): absent metrics are NULL.
NUMERIC_METRICS = {
    "order_count": "bigint",
    "avg_order_price": "decimal(18,2)",
    "distinct_customers": "bigint",
    "urgent_share_pct": "decimal(9,4)",
}
PAYLOAD_METRICS = ("lunar_calendar", "working_days")
ALL_METRICS = list(NUMERIC_METRICS) + list(PAYLOAD_METRICS)


def holiday_table(spark) -> DataFrame:
    """Festival dates as a lookup table (replaces per-row lunar conversion)."""
    rows = [("LNY", d) for d in LUNAR_NEW_YEAR] + [("MA", d) for d in MID_AUTUMN]
    return spark.createDataFrame(rows, "festival string, day string").select(
        "festival", F.to_date("day").alias("festival_date"))


def order_month_metrics(t: Tables) -> DataFrame:
    o = t.orders
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("bigint")
    n = F.count(F.lit(1)).cast("bigint")
    return (o.groupBy(F.year("o_orderdate").alias("report_year"), F.month("o_orderdate").alias("report_month"))
            .agg(n.alias("order_count"),
                 F.avg("o_totalprice").alias("_avg_price"),
                 F.countDistinct("o_custkey").alias("distinct_customers"),
                 urgent.alias("_urgent"))
            .select("report_year", "report_month", "order_count",
                    F.round("_avg_price", 2).cast("decimal(18,2)").alias("avg_order_price"),
                    "distinct_customers",
                    (F.expr("(_urgent * 2000000 + order_count) div (order_count * 2)").cast("decimal(20,0)")
                     / 10000).cast("decimal(9,4)").alias("urgent_share_pct")))


def macro_long(t: Tables) -> DataFrame:
    """(metric, year, month, value string) — the content of the metric files."""
    spark = t.spark
    spine = month_spine(t.orders, "o_orderdate")
    om = order_month_metrics(t)
    numeric = om.unpivot(["report_year", "report_month"],
                         [F.col(c).cast("string").alias(c) for c in NUMERIC_METRICS],
                         "metric", "value")
    hol = F.broadcast(holiday_table(spark))  # 16 literal rows
    fest = (spine.join(hol, (F.year("festival_date") == spine.report_year)
                       & (F.month("festival_date") == spine.report_month), "left")
            .groupBy("report_year", "report_month")
            .agg(F.max(F.when(F.col("festival") == "LNY", F.dayofmonth("festival_date"))).alias("lny"),
                 F.max(F.when(F.col("festival") == "MA", F.dayofmonth("festival_date"))).alias("ma")))
    lunar = fest.select(  # H7 packing: "LNY:12|MA:21", "" when none
        "report_year", "report_month", F.lit("lunar_calendar").alias("metric"),
        F.concat_ws("|", F.when(F.col("lny").isNotNull(), F.concat(F.lit("LNY:"), F.col("lny").cast("string"))),
                    F.when(F.col("ma").isNotNull(), F.concat(F.lit("MA:"), F.col("ma").cast("string"))))
        .alias("value"))
    wd = spine.select(
        "report_year", "report_month", F.lit("working_days").alias("metric"),
        F.concat(F.lit("WD:"), weekdays_in_month("month_start").cast("string"),
                 F.lit("|CD:"), days_in_month("month_start").cast("string")).alias("value"))
    cols = ["metric", "report_year", "report_month", "value"]
    return numeric.select(*cols).unionByName(lunar.select(*cols)).unionByName(wd.select(*cols))


def macro_wide(long: DataFrame, spine: DataFrame) -> DataFrame:
    """I3 + C6 + H5/H6 + H15/H16: pivot the fixed metric list, parse payloads,
    left-join onto the month spine.  Pivot values are listed so no extra job
    is run to discover them and absent metrics become NULL columns."""
    wide = long.groupBy("report_year", "report_month").pivot("metric", ALL_METRICS).agg(F.max("value"))
    j = spine.select("report_year", "report_month", "month_start").join(wide, ["report_year", "report_month"], "left")
    lunar = F.coalesce(F.col("lunar_calendar"), F.lit(""))
    cd = F.coalesce(payload_int(F.col("working_days"), "CD"), days_in_month("month_start"))
    wdv = working_days_fallback(payload_int(F.col("working_days"), "WD"), cd)
    return j.select(
        "report_year", "report_month",
        *[F.col(c).try_cast(ty).alias(c) for c, ty in NUMERIC_METRICS.items()],
        lunar.contains("LNY").alias("has_lunar_new_year"),
        payload_int(lunar, "LNY").alias("lunar_new_year_day"),
        lunar.contains("MA").alias("has_mid_autumn"),
        payload_int(lunar, "MA").alias("mid_autumn_day"),
        wdv.cast("int").alias("working_days"),
        cd.cast("int").alias("calendar_days"),
        weekend_days(cd, wdv).cast("int").alias("weekend_days"))


def macro_indicators(t: Tables) -> DataFrame:
    """The wide month table (one row per month), materialised once per query."""
    return t.memo("macro", lambda: macro_wide(macro_long(t), month_spine(t.orders, "o_orderdate")))


def write_metric_split(long: DataFrame, path: str, fmt: str = "csv") -> None:
    """One folder per metric (``metric=<name>``), header + year,month,value."""
    w = long.select("metric", F.col("report_year").alias("year"), F.col("report_month").alias("month"), "value") \
        .write.mode("overwrite").partitionBy("metric")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


METRIC_COLUMNS = ("year", "month", "value")


def _metric_files(spark, path: str) -> DataFrame:
    """One row per metric file (a few lines per month, so a file is small):
    metric, its lines, its normalised header (no BOM, blanks or quotes, lower
    case) and the place of each needed column in it (0: missing)."""
    files = spark.read.text(path, wholetext=True)
    clean = F.regexp_replace("value", "^\ufeff", "")
    lines = F.filter(F.split(clean, "\r?\n"), lambda x: F.trim(x) != "")
    files = files.select(F.lower(F.trim("metric")).alias("metric"), lines.alias("lines"))
    header = F.transform(F.split(F.coalesce(F.get("lines", F.lit(0)), F.lit("")), ","),
                         lambda x: F.lower(F.trim(F.regexp_replace(x, '"', ""))))
    return files.withColumn("header", header).withColumns(
        {f"at_{c}": F.array_position("header", c).cast("int") for c in METRIC_COLUMNS})


def _whole_header() -> F.Column:
    return (F.col("at_year") > 0) & (F.col("at_month") > 0) & (F.col("at_value") > 0)


def read_metric_dir(spark, path: str) -> DataFrame:
    """A directory of metric CSVs (one folder per metric) -> long frame.
    Columns are found by the name in each file's own header; files without the
    three columns are skipped (G4: ``metric_rejects`` lists them), lines whose
    year or month is no number are too."""
    rows = (_metric_files(spark, path).filter(_whole_header())
            .select("metric", "at_year", "at_month", "at_value", F.explode(F.slice("lines", F.lit(2), F.size("lines"))).alias("line")))
    cells = F.split("line", ",", -1)

    def cell(c):
        return F.trim(F.regexp_replace(F.coalesce(F.get(cells, F.col(f"at_{c}") - 1), F.lit("")), '"', ""))
    out = rows.select("metric", cell("year").try_cast("int").alias("report_year"),
                      cell("month").try_cast("int").alias("report_month"), cell("value").alias("value"))
    return out.filter(F.col("report_year").isNotNull() & F.col("report_month").isNotNull())


def metric_rejects(spark, path: str) -> DataFrame:
    """Metric files that lack a needed column, with what their header has."""
    return _metric_files(spark, path).filter(~_whole_header()).select(
        "metric", F.array_join("header", ",").alias("header"))
