"""Driver tables -> engine inputs.

Every engine input is a lazy DataFrame derived from the given tables, so the
work of each query grows with them.  The heavy steps are one aggregation of
``lineitem`` per (ship date, supplier) and one lineitem-orders-part join per
month; everything downstream runs on those aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import half_up_ratio_2dp, pct
from salesmart.sources.tables import Tables

MONEY = "decimal(18,2)"

# ---------------------------------------------------------------------------
# Fixed values of the binding (our own choices, SURVEY 7.3)
# ---------------------------------------------------------------------------
GRAND_TOTAL_ID = -1
GRAND_TOTAL_NAME = "GRAND TOTAL"
LARGE_ORDER_PRICE = 400000.0
# p_type -> category for the non-gift product lines
TYPE_CATEGORY = {"PROMO": "GRAM_COOKIES", "SMALL": "FB", "ECONOMY": "DRY_CAKE", "MEDIUM": "OTHER"}
# gift price threshold in force per year: <=1996 -> 930, 1997 -> 950, >=1998 -> 970
THRESHOLD_CHANGES = [(1900, 930), (1997, 950), (1998, 970)]
LARGE_GIFT = 5000
# price bands: below and above each threshold there ever was, and large gifts
_BANDS = [("DOWN", "GIFT_LOW", 1), ("UP", "GIFT_HIGH", 2)]
_PERIODS = [(t, start, nxt - 1) for (start, t), (nxt, _) in
            zip(THRESHOLD_CHANGES, [*THRESHOLD_CHANGES[1:], (10_000, None)])]


def _band_rows(shift: int) -> list[tuple]:
    """(category, group, floor, ceiling, order, first year, last year); thresholds move by ``shift``."""
    rows = [(f"GIFT_{t}_{side}", group, *((0, t + shift) if side == "DOWN" else (t + shift, LARGE_GIFT + shift)), order, a, b)
            for side, group, order in _BANDS for t, a, b in _PERIODS]
    return rows + [(f"GIFT_{LARGE_GIFT}_UP", "GIFT_LARGE", LARGE_GIFT + shift, None, len(_BANDS) + 1,
                    THRESHOLD_CHANGES[0][0], _PERIODS[-1][2])]


# category -> (canonical group, floor, ceiling, sort order)
GIFT_MAPPING = [r[:5] for r in _band_rows(0)]
# year-effective variant (C3): raw category, group, floor, ceiling, year_from, year_to
GIFT_MAPPING_BY_YEAR = [(*r[:4], *r[5:]) for r in _band_rows(1)]
# Lunar new year and mid-autumn festival dates (public calendar facts)
LUNAR_NEW_YEAR = ["1995-01-31", "1996-02-19", "1997-02-07", "1998-01-28",
                  "1999-02-16", "2000-02-05", "2001-01-24", "2002-02-12"]
MID_AUTUMN = ["1995-09-09", "1996-09-27", "1997-09-16", "1998-10-05",
              "1999-09-24", "2000-09-12", "2001-10-01", "2002-09-21"]


def threshold_for_year(year_col):
    """Gift price threshold in force in ``year``."""
    expr = None
    for start, t in THRESHOLD_CHANGES:
        expr = F.when(year_col >= start, F.lit(t)) if expr is None else \
            F.when(year_col >= start, F.lit(t)).otherwise(expr)
    return expr


# ---------------------------------------------------------------------------
# Store dimension
# ---------------------------------------------------------------------------
def dim_store(t: Tables) -> DataFrame:
    """Suppliers as stores, plus the GRAND TOTAL pseudo-store.

    nation/region are fixed-size TPC-H dimensions (25/5 rows): broadcast is
    size-proven.  Supplier grows with scale, so it is never force-broadcast.
    """
    nat = F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))
    reg = F.broadcast(t.region.select("r_regionkey", "r_name"))
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    stores = (s.join(nat, s.s_nationkey == nat.n_nationkey, "left")
              .join(reg, F.col("n_regionkey") == reg.r_regionkey, "left")
              .select(
                  F.col("s_suppkey").alias("store_id"),
                  F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("store_code"),
                  F.translate("s_name", "#", "-").alias("store_name"),
                  F.col("n_name").alias("store_short_name"),
                  F.when(F.col("s_suppkey") % 10 == 8, "HQ")
                   .when(F.col("s_suppkey") % 10 == 9, "Web")
                   .otherwise("store").alias("store_type"),
                  F.col("r_name").alias("area"),
                  F.col("s_suppkey").alias("display_order"),
                  F.lit(True).alias("is_active")))
    total = stores.sparkSession.range(1).select(
        F.lit(GRAND_TOTAL_ID).cast("bigint").alias("store_id"),
        F.lit("GRAND").alias("store_code"),
        F.lit(GRAND_TOTAL_NAME).alias("store_name"),
        F.lit(None).cast("string").alias("store_short_name"),
        F.lit("grand_total").alias("store_type"),
        F.lit(None).cast("string").alias("area"),
        F.lit(999999999).cast("bigint").alias("display_order"),
        F.lit(True).alias("is_active"))
    return stores.unionByName(total)


# ---------------------------------------------------------------------------
# Daily fact (DAILY rows) and month-to-date (MTD rows)
# ---------------------------------------------------------------------------
def _lineitem_sales(t: Tables) -> DataFrame:
    li = t.lineitem
    amount = li.l_extendedprice.cast(MONEY)
    return li.select(
        li.l_shipdate.cast("date").alias("report_date"),
        li.l_suppkey.alias("store_id"),
        li.l_orderkey,
        amount.alias("amount"),
        F.when(li.l_returnflag == "R", amount).otherwise(F.lit(0).cast(MONEY)).alias("returned"))


def _finish_daily(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more, "report_date", "store_id",
        F.col("sales_result").cast(MONEY).alias("sales_result"),
        F.col("transfer_amount").cast(MONEY).alias("transfer_amount"),
        (F.col("sales_result") + F.col("transfer_amount")).cast(MONEY).alias("sales_incl_result"),
        F.col("customer_count").cast("bigint").alias("customer_count"),
        half_up_ratio_2dp("sales_result", "customer_count", "decimal(12,2)").alias("unit_price"))


def store_daily(t: Tables, with_customers: bool = True) -> DataFrame:
    """DAILY rows per (ship date, supplier).

    Two plain aggregations instead of sum + count(DISTINCT): lines -> (date,
    store, order) partial sums, then -> (date, store) with count(*) = distinct
    orders.  No Expand, both levels combine map-side, and a hot store spreads
    over the first level's (date, store, order) hash keys.  Without customers
    a single aggregation suffices and the order key is not even read."""
    if not with_customers:
        agg = (_lineitem_sales(t).groupBy("report_date", "store_id")
               .agg(F.sum("amount").alias("sales_result"), (-F.sum("returned")).alias("transfer_amount"))
               .withColumn("customer_count", F.lit(None).cast("bigint")))
        return _finish_daily(agg)
    return _finish_daily(_per_store_day(_lineitem_sales(t)))


def _per_store_day(lines: DataFrame, *more: str) -> DataFrame:
    per_order = (lines.groupBy(*more, "report_date", "store_id", "l_orderkey")
                 .agg(F.sum("amount").alias("amount"), F.sum("returned").alias("returned")))
    return (per_order.groupBy(*more, "report_date", "store_id")
            .agg(F.sum("amount").alias("sales_result"),
                 (-F.sum("returned")).alias("transfer_amount"),
                 F.count(F.lit(1)).alias("customer_count")))


def store_daily_by_month(t: Tables, tasks: int) -> DataFrame:
    """``store_daily`` with its month (``report_month``), of which a task holds
    whole store-months: the lines are moved once, and neither aggregation nor a
    running sum over a store-month moves them again."""
    lines = _lineitem_sales(t).withColumn("report_month", F.trunc("report_date", "month"))
    return _finish_daily(_per_store_day(lines.repartition(tasks, "store_id", "report_month"), "report_month"), "report_month")


def grand_daily(t: Tables, with_customers: bool = True, stores: DataFrame | None = None) -> DataFrame:
    """DAILY rows of the GRAND TOTAL store: one row per date over all suppliers.

    Money is re-aggregated from the per-store aggregate (``stores``, so that a
    plan that has both shares its shuffle), the distinct order count must come
    from the line level and is only computed on demand.
    """
    s = store_daily(t, with_customers=False) if stores is None else stores
    money = s.groupBy("report_date").agg(
        F.sum("sales_result").alias("sales_result"),
        F.sum("transfer_amount").alias("transfer_amount"))
    if with_customers:
        cust = (t.lineitem.select(F.col("l_shipdate").cast("date").alias("report_date"), "l_orderkey")
                .distinct()                                          # distinct (date, order)
                .groupBy("report_date").agg(F.count(F.lit(1)).alias("customer_count")))
        money = money.join(cust, "report_date", "left")
    else:
        money = money.withColumn("customer_count", F.lit(None).cast("bigint"))
    return _finish_daily(money.withColumn("store_id", F.lit(GRAND_TOTAL_ID).cast("bigint")))


def month_to_date(daily: DataFrame) -> DataFrame:
    """MTD rows = running sums of DAILY rows within (store, month).

    Window partitions are one store-month (<= 31 rows), so no partition can
    grow with the data even if one store dominates.
    """
    w = (Window.partitionBy("store_id", F.trunc("report_date", "month"))
         .orderBy("report_date").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = daily.select(
        "report_date", "store_id",
        F.sum("sales_result").over(w).cast(MONEY).alias("sales_result"),
        F.sum("transfer_amount").over(w).cast(MONEY).alias("transfer_amount"),
        F.sum("sales_incl_result").over(w).cast(MONEY).alias("sales_incl_result"),
        F.sum("customer_count").over(w).cast("bigint").alias("customer_count"))
    return run.withColumn("unit_price", half_up_ratio_2dp("sales_result", "customer_count", "decimal(12,2)"))


FACT_COLUMNS = ["report_date", "store_id", "record_type", "sales_result", "transfer_amount",
                "sales_incl_result", "customer_count", "unit_price"]


def fact_sales(t: Tables, stores_daily: bool = True, stores_mtd: bool = True,
               grand_daily_rows: bool = True, grand_mtd: bool = True,
               with_customers: bool = True) -> DataFrame:
    """Fact table keyed (report_date, store_id, record_type).

    Plans may ask for only the parts a mart reads; the mart's own filters are
    unchanged, so the result is identical to running on the full fact.
    """
    parts = []
    sd = store_daily(t, with_customers)
    gd = grand_daily(t, with_customers, sd if stores_daily or stores_mtd else None)
    if stores_daily:
        parts.append(sd.withColumn("record_type", F.lit("DAILY")))
    if grand_daily_rows:
        parts.append(gd.withColumn("record_type", F.lit("DAILY")))
    if stores_mtd:
        parts.append(month_to_date(sd).withColumn("record_type", F.lit("MTD")))
    if grand_mtd:
        parts.append(month_to_date(gd).withColumn("record_type", F.lit("MTD")))
    out = parts[0].select(*FACT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*FACT_COLUMNS))
    return out


# ---------------------------------------------------------------------------
# Category fact (monthly + H1/H2/ANNUAL) and KPI fact
# ---------------------------------------------------------------------------
def category_sales_monthly(t: Tables) -> DataFrame:
    """(report_year, report_month, category, sales_result) from the
    lineitem-orders-part join, classified per SURVEY 7.3.

    Both joins are equi joins on keys that grow with scale; AQE broadcasts a
    side only when its measured size is under the threshold and otherwise
    sort-merges (splitting skewed partitions)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast(MONEY).alias("amount"))
    o = t.orders.select("o_orderkey",
                        F.year("o_orderdate").alias("report_year"),
                        F.month("o_orderdate").alias("report_month"),
                        (F.col("o_totalprice") >= LARGE_ORDER_PRICE).alias("is_large"))
    p = t.part.select("p_partkey", "p_type", "p_retailprice")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(p, F.col("l_partkey") == p.p_partkey))
    thr = threshold_for_year(F.col("report_year"))
    type_cat = None
    for ty, cat in TYPE_CATEGORY.items():
        type_cat = F.when(F.col("p_type") == ty, cat) if type_cat is None else type_cat.when(F.col("p_type") == ty, cat)
    band = F.concat(F.lit("GIFT_"), thr.cast("string"),
                    F.when(F.col("p_retailprice") < thr, F.lit("_DOWN")).otherwise(F.lit("_UP")))
    category = F.when(F.col("is_large"), F.lit("GIFT_5000_UP")).otherwise(F.coalesce(type_cat, band))
    return (j.groupBy("report_year", "report_month", category.alias("category"))
            .agg(F.sum("amount").cast(MONEY).alias("sales_result")))


def category_fact(t: Tables) -> DataFrame:
    """Category fact, computed once per query and materialised (it is small:
    categories x periods, while the join behind it grows with the data)."""
    return t.memo("category_fact", lambda: _category_fact(t))


def kpi_fact(t: Tables) -> DataFrame:
    """KPI fact (MONTHLY and ANNUAL), materialised once per query."""
    return t.memo("kpi_fact", lambda: _kpi_fact(t))


def _category_fact(t: Tables) -> DataFrame:
    """Category fact: grain (report_year, report_month, period_type, category).

    MONTHLY rows per category plus TOTAL; H1/H2/ANNUAL rows (report_month NULL)
    summed from them.  YoY and composition via year-range windows (calendar
    safe: a missing year gives NULL, not the wrong year)."""
    m = category_sales_monthly(t)
    tot = m.groupBy("report_year", "report_month").agg(F.sum("sales_result").cast(MONEY).alias("sales_result")) \
           .withColumn("category", F.lit("TOTAL"))
    monthly = m.unionByName(tot)
    half = (monthly.groupBy("report_year", "category",
                            F.when(F.col("report_month") <= 6, "H1").otherwise("H2").alias("period_type"))
            .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"))
            .withColumn("report_month", F.lit(None).cast("int")))
    annual = (monthly.groupBy("report_year", "category")
              .agg(F.sum("sales_result").cast(MONEY).alias("sales_result"))
              .withColumn("report_month", F.lit(None).cast("int"))
              .withColumn("period_type", F.lit("ANNUAL")))
    allp = monthly.withColumn("period_type", F.lit("MONTHLY")).unionByName(half).unionByName(annual)
    same_period = Window.partitionBy("report_year", "period_type", "report_month")
    with_comp = allp.withColumn(
        "composition_curr_pct",
        pct("sales_result", F.max(F.when(F.col("category") == "TOTAL", F.col("sales_result"))).over(same_period)))
    prev = (Window.partitionBy("category", "period_type", "report_month")
            .orderBy("report_year").rangeBetween(-1, -1))
    return with_comp.select(
        F.col("report_year").cast("int").alias("report_year"),
        F.col("report_month").cast("int").alias("report_month"),
        "period_type", "category", "sales_result",
        pct("sales_result", F.max("sales_result").over(prev)).alias("sales_yoy_pct"),
        "composition_curr_pct",
        F.max("composition_curr_pct").over(prev).alias("composition_prev_pct"))


def _kpi_fact(t: Tables) -> DataFrame:
    """KPI fact (MONTHLY and ANNUAL rows): customers = distinct
    ordering customers, unit price = TOTAL sales / customers, average daily
    sales = TOTAL / days in period."""
    o = t.orders.select(F.year("o_orderdate").alias("report_year"),
                        F.month("o_orderdate").alias("report_month"), "o_custkey")
    cust_m = o.groupBy("report_year", "report_month").agg(F.countDistinct("o_custkey").alias("customer_count"))
    cust_y = o.groupBy("report_year").agg(F.countDistinct("o_custkey").alias("customer_count"))
    cf = category_fact(t).filter(F.col("category") == "TOTAL")
    tm = cf.filter(F.col("period_type") == "MONTHLY").select("report_year", "report_month", "sales_result")
    ty = cf.filter(F.col("period_type") == "ANNUAL").select("report_year", "sales_result")
    monthly = (tm.join(cust_m, ["report_year", "report_month"], "left")
               .withColumn("period_type", F.lit("MONTHLY"))
               .withColumn("days", F.dayofmonth(F.last_day(F.make_date("report_year", "report_month", F.lit(1))))))
    annual = (ty.join(cust_y, "report_year", "left")
              .withColumn("period_type", F.lit("ANNUAL"))
              .withColumn("report_month", F.lit(None).cast("int"))
              .withColumn("days", F.dayofyear(F.make_date("report_year", F.lit(12), F.lit(31)))))
    both = monthly.unionByName(annual)
    return both.select(
        F.col("report_year").cast("int").alias("report_year"),
        F.col("report_month").cast("int").alias("report_month"),
        "period_type",
        F.col("customer_count").cast("int").alias("customer_count"),
        half_up_ratio_2dp("sales_result", "customer_count", "decimal(12,2)").alias("unit_price"),
        half_up_ratio_2dp("sales_result", "days").alias("avg_daily_sales"),
        F.col("days").cast("int").alias("day_in_month_curr"))


def gift_mapping(spark) -> DataFrame:
    """Category mapping."""
    return spark.createDataFrame(
        GIFT_MAPPING,
        "source_category string, canonical_group string, threshold_floor int, "
        "threshold_ceiling int, sort_order int")


def gift_mapping_by_year(spark) -> DataFrame:
    """Year-effective mapping of the design document."""
    return spark.createDataFrame(
        GIFT_MAPPING_BY_YEAR,
        "raw_category string, canonical_group string, threshold_floor int, "
        "threshold_ceiling int, year_from int, year_to int")
