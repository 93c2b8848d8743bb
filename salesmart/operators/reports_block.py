"""Category report blocks.

The yearly category report is a block per category: four metric rows
(sales, YoY %, composition %, prior-year composition %) by fifteen period
columns (12 months, H1, H2, ANNUAL), the category label wrapped over lines in
the first row.  ``render_category_blocks`` builds that text from the category
fact; ``parse_category_blocks`` turns it back into long rows with
``posexplode`` and a pivot.  A report block is a bounded group (one year,
at most 12 x 4 rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.text import format_amount, parse_amount

# Period columns in report order -> (period_type, month)
PERIODS = [(f"M{m:02d}", "MONTHLY", m) for m in range(1, 13)] + [("H1", "H1", None), ("H2", "H2", None),
                                                                     ("ANNUAL", "ANNUAL", None)]
PERIOD_LABELS = [p for p, _, _ in PERIODS]
# Category order in the report (block index)
CATEGORY_ORDER = ["TOTAL", "GIFT_5000_UP", "GIFT_930_UP", "GIFT_950_UP", "GIFT_970_UP", "GIFT_930_DOWN",
                  "GIFT_950_DOWN", "GIFT_970_DOWN", "GRAM_COOKIES", "FB", "DRY_CAKE", "OTHER"]
METRICS = ["sales_result", "sales_yoy_pct", "composition_curr_pct", "composition_prev_pct"]


def period_label(period_type: Column, month: Column) -> Column:
    return F.when(period_type == "MONTHLY", F.concat(F.lit("M"), F.lpad(month.cast("string"), 2, "0"))) \
        .otherwise(period_type)


def period_of(pos: Column) -> tuple[Column, Column]:
    """0-based period position -> (period_type, report_month)."""
    ptype = F.when(pos < 12, F.lit("MONTHLY")).when(pos == 12, F.lit("H1")).when(pos == 13, F.lit("H2")) \
        .when(pos == 14, F.lit("ANNUAL"))
    month = F.when(pos < 12, (pos + 1).cast("int"))
    return ptype, month


def period_wide(cat: DataFrame, value: str = "sales_result") -> DataFrame:
    """(year, category) x 15 period columns of ``value`` (I3-style pivot, fixed column list)."""
    return (cat.withColumn("period", period_label(F.col("period_type"), F.col("report_month")))
            .groupBy("report_year", "category").pivot("period", PERIOD_LABELS)
            .agg(F.first(F.col(value).cast("double"))))


def period_long(wide: DataFrame) -> DataFrame:
    """I6 + H22: unpivot the period columns back to (period_type, month) rows."""
    long = wide.unpivot(["report_year", "category"], PERIOD_LABELS, "period", "sales_result") \
        .filter(F.col("sales_result").isNotNull())
    pos = F.array_position(F.array(*[F.lit(p) for p in PERIOD_LABELS]), F.col("period")) - 1
    ptype, month = period_of(pos)
    return long.select("report_year", "category", ptype.alias("period_type"), month.alias("report_month"),
                       "sales_result")


def wrap_label(code: Column) -> Column:
    """Report label of a category code: words separated by spaces, the last
    word wrapped onto a new line (e.g. GIFT_930_DOWN -> 'Gift 930\\nDOWN')."""
    words = F.split(code, "_")
    head = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    return F.when(F.size(words) > 1, F.concat(F.initcap(head), F.lit("\n"), F.element_at(words, -1))) \
        .otherwise(code)


def normalise_category(label: Column) -> Column:
    """Label with line breaks/spaces -> category code."""
    return F.upper(F.regexp_replace(F.trim(label), r"\s+", "_"))


def render_category_blocks(cat: DataFrame) -> DataFrame:
    """(report_year, pos, cells): cells = label + 15 formatted period values."""
    c = cat.withColumn("period", period_label(F.col("period_type"), F.col("report_month")))
    aggs = [F.first(F.col(m)).alias(m) for m in METRICS]
    wide = c.groupBy("report_year", "category").pivot("period", PERIOD_LABELS).agg(*aggs)
    order = F.array_position(F.array(*[F.lit(x) for x in CATEGORY_ORDER]), F.col("category")) - 1

    def fmt(metric, p):
        v = F.col(f"{p}_{metric}")
        return format_amount(v, 2) if metric == "sales_result" else \
            F.when(v.isNull(), F.lit("-")).otherwise(F.format_number(v, 1))
    rows = F.array(*[F.struct(F.lit(i).alias("metric_idx"),
                              F.array(F.lit("") if i else wrap_label(F.col("category")),
                                      *[fmt(m, p) for p in PERIOD_LABELS]).alias("cells"))
                     for i, m in enumerate(METRICS)])
    return wide.select("report_year", (order * 4).alias("base"), F.explode(rows).alias("r")).select(
        "report_year", (F.col("base") + F.col("r.metric_idx")).cast("int").alias("pos"), F.col("r.cells").alias("cells"))


def parse_category_blocks(rows: DataFrame) -> DataFrame:
    """Blocks -> (report_year, report_month, period_type, category, 4 metrics)."""
    block = (F.col("pos") / 4).cast("int")
    label = F.when(F.col("pos") % 4 == 0, normalise_category(F.get(F.col("cells"), 0)))
    w = Window.partitionBy("report_year", block)
    r = rows.select("report_year", (F.col("pos") % 4).alias("metric_idx"),
                    F.max(label).over(w).alias("category"),
                    F.posexplode(F.slice("cells", 2, len(PERIODS))).alias("p", "txt"))
    ptype, month = period_of(F.col("p"))
    v = parse_amount(F.col("txt"))
    g = r.groupBy("report_year", "category", ptype.alias("period_type"), month.alias("report_month")).agg(
        *[F.max(F.when(F.col("metric_idx") == i, v)).alias(m) for i, m in enumerate(METRICS)])
    return g.filter(F.col("sales_result").isNotNull()).select(
        "report_year", "report_month", "period_type", "category", *METRICS)
