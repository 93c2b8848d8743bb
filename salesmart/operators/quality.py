"""Data-quality operators.

Every check is one set-based pass: conditional counts in a single
aggregation, key checks as group-by-having, foreign keys as anti joins.
Checks report; they never drop the rows they inspect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sanity ranges per column, (low, high), None = unchecked
RANGE_CHECKS = {
    "sales_result": (0, None),
    "sales_budget_pct": (0, 100000),
    "sales_yoy_pct": (0, 100000),
    "customer_count": (0, None),
    "unit_price": (0, None),
    "ft_expense": (0, None),
    "pt_expense": (0, None),
    "total_personnel_expense": (0, None),
    "transfer_amount": (None, None),
}
RECORD_TYPES = ("DAILY", "MTD")


def range_audit(df: DataFrame, checks=RANGE_CHECKS) -> DataFrame:
    """One aggregation with below/above counts per checked column, unpivoted
    to (column_name, lo, hi, n_below, n_above).  Columns absent from ``df`` are skipped."""
    cols = [c for c in checks if c in df.columns]
    aggs = []
    for c in cols:
        lo, hi = checks[c]
        aggs.append((F.count_if(F.col(c) < lo) if lo is not None else F.lit(0)).cast("bigint").alias(f"{c}__lo"))
        aggs.append((F.count_if(F.col(c) > hi) if hi is not None else F.lit(0)).cast("bigint").alias(f"{c}__hi"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.lit(checks[c][0]).cast("double").alias("lo"),
                     F.lit(checks[c][1]).cast("double").alias("hi"),
                     F.col(f"{c}__lo").alias("n_below"), F.col(f"{c}__hi").alias("n_above")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_audit(df: DataFrame, cols) -> DataFrame:
    """A single row with the NULL count of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"miss_{c}") for c in cols])


def key_audit(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """L1: for each named (frame, key) the key values occurring more than once:
    (check_name, key_text, n)."""
    out = None
    for name, (df, key) in checks.items():
        g = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
             .select(F.lit(name).alias("check_name"),
                     F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in key])
                     .alias("key_text"), "n"))
        out = g if out is None else out.unionByName(g)
    return out


def enum_audit(checks: dict[str, tuple[DataFrame, str, tuple]]) -> DataFrame:
    """Value distribution of enumerated columns with validity flag:
    (check_name, value, n, is_valid)."""
    out = None
    for name, (df, c, allowed) in checks.items():
        g = (df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("check_name"), F.col("value").cast("string").alias("value"), "n",
                     F.coalesce(F.col("value").isin(*allowed), F.lit(False)).alias("is_valid")))
        out = g if out is None else out.unionByName(g)
    return out


def valid_record_types(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows) by record_type."""
    ok = F.coalesce(F.col("record_type").isin(*RECORD_TYPES), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def fk_audit(fact: DataFrame, dim: DataFrame, key: str = "store_id") -> DataFrame:
    """L2: fact keys without a dimension row, with their row counts."""
    return (fact.join(dim.select(key), key, "left_anti")
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")))


def day1_daily_vs_mtd(fact: DataFrame, cols=("sales_result", "customer_count")) -> DataFrame:
    """On the first day of a month DAILY must equal MTD per store.  Full
    outer join so one-sided rows are reported (status daily_only/mtd_only)
    instead of raising."""
    day1 = fact.filter(F.dayofmonth("report_date") == 1)
    d = day1.filter(F.col("record_type") == "DAILY").select(
        "report_date", "store_id", *[F.col(c).alias(f"daily_{c}") for c in cols])
    m = day1.filter(F.col("record_type") == "MTD").select(
        "report_date", "store_id", *[F.col(c).alias(f"mtd_{c}") for c in cols])
    j = d.join(m, ["report_date", "store_id"], "full")
    same = None
    for c in cols:
        e = F.col(f"daily_{c}").eqNullSafe(F.col(f"mtd_{c}"))
        same = e if same is None else same & e
    has_d = F.col(f"daily_{cols[0]}").isNotNull() | F.col(f"daily_{cols[1]}").isNotNull()
    has_m = F.col(f"mtd_{cols[0]}").isNotNull() | F.col(f"mtd_{cols[1]}").isNotNull()
    status = (F.when(~has_m, "daily_only").when(~has_d, "mtd_only")
              .when(same, "match").otherwise("mismatch"))
    return j.withColumn("status", status)


def composition_audit(cat: DataFrame, tol: float = 0.5) -> DataFrame:
    """MONTHLY composition of the non-TOTAL categories sums to 100 +- tol."""
    s = (cat.filter((F.col("period_type") == "MONTHLY") & (F.col("category") != "TOTAL"))
         .groupBy("report_year", "report_month")
         .agg(F.round(F.sum("composition_curr_pct"), 4).alias("composition_sum")))
    return s.withColumn("ok", F.abs(F.col("composition_sum") - 100) <= tol)


def total_audit(cat: DataFrame, rel_tol: float = 0.01) -> DataFrame:
    """TOTAL sales vs the sum of the categories, within rel_tol, per period."""
    g = cat.groupBy("report_year", "period_type", "report_month").agg(
        F.sum(F.when(F.col("category") == "TOTAL", F.col("sales_result"))).cast("decimal(18,2)").alias("total_sales"),
        F.sum(F.when(F.col("category") != "TOTAL", F.col("sales_result"))).cast("decimal(18,2)").alias("category_sum"))
    return g.withColumn("ok", F.abs(F.col("total_sales") - F.col("category_sum"))
                        <= F.abs(F.col("total_sales")) * F.lit(rel_tol))


def half_year_audit(cat: DataFrame, rel_tol: float = 0.01) -> DataFrame:
    """ANNUAL = H1 + H2 within rel_tol, per (year, category)."""
    g = cat.filter(F.col("period_type").isin("H1", "H2", "ANNUAL")).groupBy("report_year", "category").agg(
        F.sum(F.when(F.col("period_type") == "ANNUAL", F.col("sales_result"))).cast("decimal(18,2)").alias("annual"),
        F.sum(F.when(F.col("period_type") != "ANNUAL", F.col("sales_result"))).cast("decimal(18,2)").alias("h1_plus_h2"))
    return g.withColumn("ok", F.abs(F.col("annual") - F.coalesce("h1_plus_h2", F.lit(0)))
                        <= F.abs(F.col("annual")) * F.lit(rel_tol))


def completeness_audit(cat: DataFrame, periods_expected: int = 15) -> DataFrame:
    """Periods per (year, category) vs the 12 months + H1 + H2 + ANNUAL,
    and distinct categories per year."""
    per = cat.groupBy("report_year", "category").agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.countDistinct("report_month").alias("n_months"))
    cats = cat.groupBy("report_year").agg(F.countDistinct("category").alias("n_categories"))
    return (per.join(cats, "report_year")
            .withColumn("complete", F.col("n_periods") == periods_expected))


def rule_audit(cat: DataFrame) -> DataFrame:
    """Non-negative sales and YoY in (0, 500), rules as rows (rule, n_checked, n_violations)."""
    rules = {
        "sales_non_negative": (F.col("sales_result").isNotNull(), F.col("sales_result") < 0),
        "yoy_in_0_500": (F.col("sales_yoy_pct").isNotNull(),
                         (F.col("sales_yoy_pct") <= 0) | (F.col("sales_yoy_pct") >= 500)),
    }
    aggs = []
    for r, (chk, bad) in rules.items():
        aggs += [F.count_if(chk).alias(f"{r}__n"), F.count_if(chk & bad).alias(f"{r}__bad")]
    one = cat.agg(*aggs)
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(f"{r}__n").alias("n_checked"),
                 F.col(f"{r}__bad").alias("n_violations")) for r in rules])).alias("x")).select("x.*")


def combined_check(canonical: DataFrame, combined: DataFrame, tol: float = 1.0) -> DataFrame:
    """C14: COMBINED vs LOW + HIGH per month, by conditional aggregation of
    the canonical rows (one pass instead of a 3-way self join)."""
    c = canonical.filter(F.col("period_type") == "MONTHLY").groupBy("report_year", "report_month").agg(
        F.sum(F.when(F.col("canonical_group") == "GIFT_LOW", F.col("sales_result"))).alias("low_sales"),
        F.sum(F.when(F.col("canonical_group") == "GIFT_HIGH", F.col("sales_result"))).alias("high_sales"))
    k = combined.filter(F.col("period_type") == "MONTHLY").select(
        "report_year", "report_month", F.col("sales_result").alias("combined_sales"))
    j = k.join(c, ["report_year", "report_month"]).filter(
        F.col("low_sales").isNotNull() & F.col("high_sales").isNotNull())  # inner-join semantics
    diff = F.abs(F.col("combined_sales") - (F.col("low_sales") + F.col("high_sales")))
    return j.select("report_year", "report_month", "combined_sales",
                    F.col("low_sales").cast("decimal(18,2)").alias("low_sales"),
                    F.col("high_sales").cast("decimal(18,2)").alias("high_sales"),
                    diff.cast("decimal(18,2)").alias("diff"), (diff > tol).alias("mismatch"))
