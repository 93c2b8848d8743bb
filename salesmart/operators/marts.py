"""Reporting marts (the reference's BI views) as DataFrame operators.

Each function takes the star-schema inputs as DataFrames and returns a lazy
DataFrame; composition happens in Catalyst, so nested "views" collapse into
one plan.  Dimension-size tables are broadcast only when their size is fixed
(mapping: 7 rows, macro: one row per month); stores grow with the data and are
left to AQE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import avg_exact, guarded_pct_diff, pct

DEFAULT_STORE_TYPES = ("store", "HQ")
GRAND_TOTAL = "GRAND TOTAL"
MONEY = "decimal(18,2)"


def _ym(c="report_date"):
    return [F.year(c).alias("report_year"), F.month(c).alias("report_month")]


def month_end_filter(c="report_date"):
    """date = EOMONTH(date)."""
    return F.col(c) == F.last_day(F.col(c))


# B1 B2 C1 ------------------------------------------------------------------
def daily_store_sales(fact: DataFrame, dim: DataFrame,
                      store_types=DEFAULT_STORE_TYPES) -> DataFrame:
    d = dim.filter(F.col("store_type").isin(*store_types)).select(
        "store_id", "store_code", "store_name", "store_short_name", "store_type")
    f = fact.filter(F.col("record_type") == "DAILY")
    return f.join(d, "store_id").select(
        "report_date", *_ym(), F.dayofmonth("report_date").alias("report_day"),
        F.date_format("report_date", "EEEE").alias("weekday_name"),
        "store_id", "store_code", "store_name", "store_short_name", "store_type",
        "customer_count", "unit_price", "sales_result", "transfer_amount", "sales_incl_result")


# B3 B4 B5 ------------------------------------------------------------------
def _grand_total_mtd_month_end(fact: DataFrame, dim: DataFrame, total_name: str) -> DataFrame:
    ids = dim.filter(F.col("store_name") == total_name).select("store_id")
    return (fact.filter((F.rtrim("record_type") == "MTD") & month_end_filter())
            .join(ids, "store_id", "left_semi"))


def grand_total_month_end(fact: DataFrame, dim: DataFrame, total_name: str = GRAND_TOTAL) -> DataFrame:
    """vw_daily_grand_total: MTD rows of the grand-total store on month ends."""
    return _grand_total_mtd_month_end(fact, dim, total_name).select(
        "report_date", *_ym(), "customer_count", "unit_price", "sales_result",
        "transfer_amount", "sales_incl_result", "record_type")


# D3 ------------------------------------------------------------------------
def daily_month_sum(fact: DataFrame, dim: DataFrame, store_types=DEFAULT_STORE_TYPES) -> DataFrame:
    ids = dim.filter(F.col("store_type").isin(*store_types)).select("store_id")
    return (fact.filter(F.rtrim("record_type") == "DAILY").join(ids, "store_id", "left_semi")
            .groupBy(*_ym())
            .agg(F.sum(F.coalesce("sales_incl_result", F.lit(0))).cast(MONEY).alias("daily_sum_sales_incl")))


# C15 (flagship) ------------------------------------------------------------
def month_end_reconcile(fact: DataFrame, dim: DataFrame, store_types=DEFAULT_STORE_TYPES,
                        total_name: str = GRAND_TOTAL) -> DataFrame:
    """vw_month_end_reconcile: month-end grand-total MTD (sales + transfer)
    vs the month's summed DAILY incl.-transfer sales of the chosen store types."""
    m = _grand_total_mtd_month_end(fact, dim, total_name).select(
        *_ym(), F.col("report_date").alias("month_end_date"),
        (F.coalesce("sales_result", F.lit(0)) + F.coalesce("transfer_amount", F.lit(0)))
        .cast(MONEY).alias("mtd_calc_incl"))
    d = daily_month_sum(fact, dim, store_types)
    return (m.join(d, ["report_year", "report_month"], "left")
            .select("report_year", "report_month", "month_end_date", "mtd_calc_incl",
                    "daily_sum_sales_incl",
                    (F.col("mtd_calc_incl") - F.col("daily_sum_sales_incl")).cast(MONEY).alias("diff")))


# E11 (as a mart over DAILY rows) --------------------------------------------
def mtd_running(fact: DataFrame, dim: DataFrame, store_types=DEFAULT_STORE_TYPES) -> DataFrame:
    """Month-to-date running sales per store computed from DAILY rows."""
    ids = dim.filter(F.col("store_type").isin(*store_types)).select("store_id")
    w = (Window.partitionBy("store_id", F.trunc("report_date", "month")).orderBy("report_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (fact.filter(F.col("record_type") == "DAILY").join(ids, "store_id", "left_semi")
            .select("report_date", "store_id", "sales_result",
                    F.sum("sales_result").over(w).cast(MONEY).alias("mtd_sales"),
                    F.sum("sales_incl_result").over(w).cast(MONEY).alias("mtd_sales_incl")))


# E12 -----------------------------------------------------------------------
def yoy_month(month_sales: DataFrame, value: str = "sales_result", keys=()) -> DataFrame:
    """Same month last year x 100 by self join on year - 1 (calendar safe)."""
    keys = list(keys)
    prev = month_sales.select(*keys, (F.col("report_year") + 1).alias("report_year"), "report_month",
                              F.col(value).alias("prev_" + value))
    return (month_sales.join(prev, keys + ["report_year", "report_month"], "left")
            .withColumn("yoy_pct", pct(value, "prev_" + value, 2)))


def grand_month_end_sales(fact: DataFrame, dim: DataFrame, total_name: str = GRAND_TOTAL) -> DataFrame:
    return grand_total_month_end(fact, dim, total_name).select(
        "report_year", "report_month", "sales_result")


# C17 B15 -------------------------------------------------------------------
def store_month_sales(fact: DataFrame, dim: DataFrame, store_types=DEFAULT_STORE_TYPES) -> DataFrame:
    d = dim.filter(F.col("store_type").isin(*store_types)).select("store_id", "store_code")
    return (fact.filter(F.col("record_type") == "DAILY").join(d, "store_id")
            .groupBy("store_code", *_ym()).agg(F.sum("sales_result").cast(MONEY).alias("actual_sales")))


def budget_from_history(store_month: DataFrame, growth: float = 1.05) -> DataFrame:
    """Budget table (store_code, year, month, budget): last year's actual x growth.
    Stands in for the spreadsheet budget the BI layer joins."""
    return store_month.select(
        "store_code", (F.col("report_year") + 1).alias("report_year"), "report_month",
        (F.col("actual_sales") * F.lit(Decimal(str(growth)))).cast(MONEY).alias("budget_sales"))


def budget_attainment(store_month: DataFrame, budget: DataFrame) -> DataFrame:
    """C17: actual vs budget on (store_code, year, month); attainment NULL when budget is 0/missing."""
    return (store_month.join(budget, ["store_code", "report_year", "report_month"], "left")
            .withColumn("attainment_pct", pct("actual_sales", "budget_sales", 2)))


# D5 ------------------------------------------------------------------------
def area_rollup(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Subtotals by area and store type plus grand total (BI aggregation)."""
    d = dim.filter(F.col("store_type") != "grand_total").select("store_id", "area", "store_type")
    return (fact.filter(F.col("record_type") == "DAILY").join(d, "store_id")
            .rollup("area", "store_type")
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.grouping_id().cast("int").alias("grouping_level")))


# H20 C18 ------------------------------------------------------------------
def date_dimension(dates: DataFrame, c: str = "report_date") -> DataFrame:
    """Calendar spanning min..max of ``c``: one row per day.

    Week number follows the BI convention (weeks start Sunday, 1 Jan in week 1).
    The spine is built from a one-row min/max aggregate and exploded; its size
    is bounded by the number of days, not by the fact rows."""
    bounds = dates.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    week = ((F.dayofyear("date") + F.dayofweek(F.trunc("date", "year")) - 2) / 7).cast("int") + 1
    return d.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), week.alias("week_num"),
        F.concat(F.year("date").cast("string"), F.lit("Q"), F.quarter("date").cast("string")).alias("year_quarter"),
        (F.year("date") * 100 + F.month("date")).alias("yyyymm"),
        (F.year("date") * 100 + week).alias("yyyyww"),
        F.date_format("date", "EEE").alias("weekday_short"))


def date_dim_join(fact: DataFrame, dim: DataFrame, cal: DataFrame, total_name: str = GRAND_TOTAL) -> DataFrame:
    """Grand-total DAILY sales rolled up by calendar week."""
    ids = dim.filter(F.col("store_name") == total_name).select("store_id")
    f = fact.filter(F.col("record_type") == "DAILY").join(ids, "store_id", "left_semi")
    return (f.join(cal, f.report_date == cal.date)
            .groupBy("year", "week_num", "yyyyww")
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"),
                 F.count(F.lit(1)).alias("n_days")))


# D1 C2 C3 D2 ---------------------------------------------------------------
def canonical_monthly(cat: DataFrame, mapping: DataFrame) -> DataFrame:
    """vw_gift_canonical_monthly (mapping is 7 rows: broadcast is size-proven)."""
    m = F.broadcast(mapping)
    f = cat.filter(F.col("period_type") == "MONTHLY")
    return (f.join(m, f.category == m.source_category)
            .groupBy("report_year", "report_month", "period_type", "canonical_group",
                     "threshold_floor", "threshold_ceiling")
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"),
                 F.round(F.sum("composition_curr_pct"), 4).alias("composition_curr_pct"),
                 F.round(F.sum("composition_prev_pct"), 4).alias("composition_prev_pct"),
                 avg_exact("sales_yoy_pct", 1, 4).alias("sales_yoy_pct")))


def canonical_monthly_by_year(cat: DataFrame, mapping_by_year: DataFrame) -> DataFrame:
    """Year-effective mapping: equi on category plus year BETWEEN range."""
    m = F.broadcast(mapping_by_year)
    f = cat.filter(F.col("period_type") == "MONTHLY")
    j = f.join(m, (f.category == m.raw_category) & f.report_year.between(m.year_from, m.year_to))
    return (j.groupBy("report_year", "report_month", "period_type", "canonical_group",
                      "threshold_floor", "threshold_ceiling")
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"),
                 F.round(F.sum("composition_curr_pct"), 4).alias("composition_curr_pct"),
                 F.round(F.sum("composition_prev_pct"), 4).alias("composition_prev_pct"),
                 avg_exact("sales_yoy_pct", 1, 4).alias("sales_yoy_pct")))


def combined_monthly(canonical: DataFrame) -> DataFrame:
    """Combined group: GIFT_COMBINED = LOW + HIGH."""
    return (canonical.filter(F.col("canonical_group").isin("GIFT_LOW", "GIFT_HIGH"))
            .groupBy("report_year", "report_month", "period_type")
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"),
                 F.round(F.sum("composition_curr_pct"), 4).alias("composition_curr_pct"),
                 F.round(F.sum("composition_prev_pct"), 4).alias("composition_prev_pct"))
            .withColumn("canonical_group", F.lit("GIFT_COMBINED")))


# G1 C4 ---------------------------------------------------------------------
GROUP_DATASET_COLS = ["report_year", "report_month", "canonical_group", "sales_result", "sales_yoy_pct",
                      "composition_curr_pct", "composition_prev_pct", "threshold_floor", "threshold_ceiling"]


def group_analysis_dataset(canonical: DataFrame, macro: DataFrame) -> DataFrame:
    """Group dataset: 3 groups UNION ALL the combined group (NULL
    padded), then the month-level macro table joined once after the union."""
    g = canonical.filter(F.col("period_type") == "MONTHLY")
    c = combined_monthly(canonical).filter(F.col("period_type") == "MONTHLY")
    u = g.select(*GROUP_DATASET_COLS).unionByName(c.select(*[x for x in GROUP_DATASET_COLS if x in c.columns]),
                                                   allowMissingColumns=True)
    return u.join(F.broadcast(macro), ["report_year", "report_month"], "left")


# D4 E1 ---------------------------------------------------------------------
def group_annual_summary(ds: DataFrame, macro_a: str = "order_count", macro_b: str = "urgent_share_pct") -> DataFrame:
    return (ds.groupBy("report_year", "canonical_group")
            .agg(F.sum("sales_result").cast(MONEY).alias("annual_sales"),
                 avg_exact("sales_yoy_pct", 4, 6).alias("annual_avg_yoy"),
                 avg_exact(macro_a, 0, 4).alias("avg_" + macro_a),
                 avg_exact(macro_b, 4, 6).alias("avg_" + macro_b)))


def peak_calendar(ds: DataFrame, k: int = 3) -> DataFrame:
    """Top-k months per (year, group); month breaks ties (deterministic).
    Spark plans this as a WindowGroupLimit below the window."""
    w = Window.partitionBy("report_year", "canonical_group").orderBy(
        F.col("sales_result").desc_nulls_last(), F.col("report_month").asc())
    return (ds.select("report_year", "canonical_group", "report_month", "sales_result",
                      F.row_number().over(w).alias("rn"))
            .filter(F.col("rn") <= k).drop("rn"))


# B22 C7 --------------------------------------------------------------------
def category_monthly(cat: DataFrame) -> DataFrame:
    return cat.filter(F.col("period_type") == "MONTHLY").select(
        "report_year", "report_month", "category", "sales_result", "sales_yoy_pct",
        "composition_curr_pct", "composition_prev_pct")


def category_annual(cat: DataFrame, kpi: DataFrame) -> DataFrame:
    k = kpi.filter(F.col("period_type") == "ANNUAL").select(
        "report_year", F.col("customer_count").alias("annual_customers"),
        F.col("unit_price").alias("annual_unit_price"), "avg_daily_sales")
    c = cat.filter(F.col("period_type") == "ANNUAL")
    return c.join(k, "report_year", "left").select(
        "report_year", "category", F.col("sales_result").alias("annual_sales"),
        F.col("sales_yoy_pct").alias("annual_yoy_pct"), "composition_curr_pct",
        "annual_customers", "annual_unit_price", "avg_daily_sales")


def category_half_year(cat: DataFrame) -> DataFrame:
    return cat.filter(F.col("period_type").isin("H1", "H2")).select(
        "report_year", "period_type", "category", "sales_result", "sales_yoy_pct")


# C5 C4 B13 C16 --------------------------------------------------------------
FLOOR_CATEGORIES = ("GIFT_930_DOWN", "GIFT_950_DOWN", "GIFT_970_DOWN")


def _report_month_end(fact, dim, total_name=GRAND_TOTAL):
    return grand_total_month_end(fact, dim, total_name).select(
        "report_year", "report_month", F.col("sales_result").alias("report_mtd_sales"),
        F.col("customer_count").alias("report_customers"))


def _kpi_monthly(kpi):
    return kpi.filter(F.col("period_type") == "MONTHLY").select(
        "report_year", "report_month", "customer_count", "unit_price", "avg_daily_sales")


def analysis_monthly(cat: DataFrame, kpi: DataFrame, macro: DataFrame, fact: DataFrame, dim: DataFrame,
                     floor_categories=FLOOR_CATEGORIES) -> DataFrame:
    """Monthly mart, join form: the TOTAL row left-joined to four
    category rows of the same month (the floor join is an IN and fans out if
    several floor codes exist), then KPI, macro and month-end sales."""
    m = cat.filter(F.col("period_type") == "MONTHLY")
    key = ["report_year", "report_month"]

    def side(pred, prefix, cols):
        return m.filter(pred).select(*key, *[F.col(c).alias(f"{prefix}{c}") for c in cols])

    total = m.filter(F.col("category") == "TOTAL")
    g5 = side(F.col("category") == "GIFT_5000_UP", "g5_", ["sales_result", "sales_yoy_pct", "composition_curr_pct"])
    gf = side(F.col("category").isin(*floor_categories), "gf_",
              ["category", "sales_result", "sales_yoy_pct", "composition_curr_pct"])
    gr = side(F.col("category") == "GRAM_COOKIES", "gr_", ["sales_result"])
    fb = side(F.col("category") == "FB", "fb_", ["sales_result"])
    j = (total.join(g5, key, "left").join(gf, key, "left").join(gr, key, "left").join(fb, key, "left"))
    return _analysis_finish(j, kpi, macro, fact, dim)


def analysis_monthly_onepass(cat: DataFrame, kpi: DataFrame, macro: DataFrame, fact: DataFrame, dim: DataFrame,
                             floor_categories=FLOOR_CATEGORIES) -> DataFrame:
    """Same result as ``analysis_monthly`` in one aggregation instead of four
    self joins; valid because at most one floor category exists per month."""
    m = cat.filter(F.col("period_type") == "MONTHLY")

    def pick(pred, c):
        return F.max(F.when(pred, F.col(c)))
    is5 = F.col("category") == "GIFT_5000_UP"
    isf = F.col("category").isin(*floor_categories)
    j = (m.groupBy("report_year", "report_month")
         .agg(F.max(F.when(F.col("category") == "TOTAL", 1)).alias("_has_total"),
              pick(F.col("category") == "TOTAL", "sales_result").alias("sales_result"),
              pick(F.col("category") == "TOTAL", "sales_yoy_pct").alias("sales_yoy_pct"),
              pick(F.col("category") == "TOTAL", "composition_curr_pct").alias("composition_curr_pct"),
              pick(is5, "sales_result").alias("g5_sales_result"),
              pick(is5, "sales_yoy_pct").alias("g5_sales_yoy_pct"),
              pick(is5, "composition_curr_pct").alias("g5_composition_curr_pct"),
              pick(isf, "category").alias("gf_category"),
              pick(isf, "sales_result").alias("gf_sales_result"),
              pick(isf, "sales_yoy_pct").alias("gf_sales_yoy_pct"),
              pick(isf, "composition_curr_pct").alias("gf_composition_curr_pct"),
              pick(F.col("category") == "GRAM_COOKIES", "sales_result").alias("gr_sales_result"),
              pick(F.col("category") == "FB", "sales_result").alias("fb_sales_result"))
         .filter(F.col("_has_total") == 1).drop("_has_total"))
    return _analysis_finish(j, kpi, macro, fact, dim)


MACRO_MART_COLS = ["order_count", "avg_order_price", "distinct_customers", "urgent_share_pct",
                   "has_lunar_new_year", "lunar_new_year_day", "has_mid_autumn", "mid_autumn_day",
                   "working_days", "calendar_days", "weekend_days"]


def _analysis_finish(j, kpi, macro, fact, dim):
    key = ["report_year", "report_month"]
    out = (j.join(_kpi_monthly(kpi), key, "left")
           .join(F.broadcast(macro), key, "left")
           .join(_report_month_end(fact, dim), key, "left"))
    return out.select(
        *key,
        F.col("sales_result").alias("monthly_total_sales"),
        F.col("sales_yoy_pct").alias("total_yoy_pct"),
        F.col("g5_sales_result").alias("gift_5000_sales"),
        F.col("g5_sales_yoy_pct").alias("gift_5000_yoy_pct"),
        F.col("gf_category").alias("gift_floor_category"),
        F.col("gf_sales_result").alias("gift_floor_sales"),
        F.col("gf_sales_yoy_pct").alias("gift_floor_yoy_pct"),
        F.col("gr_sales_result").alias("gram_cookies_sales"),
        F.col("fb_sales_result").alias("fb_sales"),
        F.col("composition_curr_pct").alias("total_composition_curr_pct"),
        F.col("g5_composition_curr_pct").alias("gift_5000_composition_curr_pct"),
        F.col("gf_composition_curr_pct").alias("gift_floor_composition_curr_pct"),
        "customer_count", "unit_price", "avg_daily_sales",
        *MACRO_MART_COLS, "report_mtd_sales", "report_customers")


PREDICTION_INPUT_COLS = [
    "report_year", "report_month", "monthly_total_sales", "total_yoy_pct", "gift_5000_sales",
    "gift_5000_yoy_pct", "gift_floor_category", "gift_floor_sales", "gift_floor_yoy_pct",
    "gram_cookies_sales", "fb_sales", "customer_count", "unit_price", "avg_daily_sales",
    *MACRO_MART_COLS, "report_mtd_sales", "report_customers"]


def prediction_inputs(analysis: DataFrame) -> DataFrame:
    """Named projection of the monthly mart."""
    return analysis.select(*PREDICTION_INPUT_COLS)


def category_vs_sales_reconcile(analysis: DataFrame) -> DataFrame:
    """Category TOTAL vs month-end MTD sales, guarded percentage."""
    return analysis.select(
        "report_year", "report_month",
        F.col("monthly_total_sales").alias("category_total_sales"), "report_mtd_sales",
        F.round(guarded_pct_diff("monthly_total_sales", "report_mtd_sales"), 6).alias("diff_pct"))
