"""Sinks, sources and keyed tables through the shared folder (A5 A8 A10 A11 B8
F1 H8 H17 H26 H27 J2-J4 J12)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesmart.operators import forecast as K
from salesmart.operators import ops as OP
from salesmart.operators import quality as Q
from salesmart.operators import upsert as U
from salesmart.operators.macro import macro_long
from salesmart.plans import q_forecast as QF
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

G = "canonical_group"


def _scratch(spark, what):
    return f"{checkpoint_dir(spark).rstrip('/')}/salesmart-{what}/{uuid.uuid4().hex}"


@query("csv_round_trip", with_ctes("""
SELECT report_date, store_id, sales_result, customer_count FROM store_daily""", "store_daily"))
def q_csv_round_trip(spark, sf):
    """The daily fact as ordered CSV with header and byte order mark,
    read back with an explicit schema."""
    path = _scratch(spark, "csv")
    daily = B.store_daily(Tables(spark, sf)).select("report_date", "store_id", "sales_result", "customer_count")
    OP.write_csv(daily, path, ["report_date", "store_id"], bom=True)
    return OP.read_csv_dataset(spark, path, "report_date date, store_id bigint, sales_result decimal(18,2), customer_count bigint")


@query("audit_log", """
SELECT o_orderpriority AS step, 2 AS n_runs, COUNT(*) AS n_rows, TRUE AS stamped FROM orders GROUP BY 1""")
def q_audit_log(spark, sf):
    """Two runs append their row counts; every row has its run and time."""
    path = _scratch(spark, "log")
    rows = Tables(spark, sf).orders.groupBy(F.col("o_orderpriority").alias("step")).agg(F.count(F.lit(1)).alias("n_rows"))
    for _ in range(2):
        U.append_log(path, rows)
    return (spark.read.parquet(path).groupBy("step")
            .agg(F.countDistinct("run_id").cast("int").alias("n_runs"), F.max("n_rows").alias("n_rows"),
                 F.min((F.col("loaded_at") <= F.current_timestamp()) & F.col("loaded_at").isNotNull()).alias("stamped")))


@query("coefficients_saved", QF._sql(f"""
SELECT {G}, fold, ROUND(regr_slope(y, x), 6) AS slope
FROM (SELECT {G}, fold, y, COALESCE(sales_lag_12m, 0) AS x FROM folded WHERE role = 'train') GROUP BY 1, 2"""))
def q_coefficients_saved(spark, sf):
    """Fitted coefficients saved as a table and read back."""
    path = _scratch(spark, "model")
    OP.save_model_table(K.fit_linear(QF._design(spark, sf, ["sales_lag_12m"]), 1, alphas=(0.0,)), path)
    return spark.read.parquet(path).select(G, "fold", F.round(F.col("coef")[0], 6).alias("slope"))


@query("merge_store_dim", with_ctes("""
SELECT store_id, store_code, CASE WHEN store_id % 3 = 0 OR store_id % 2 <> 0 THEN store_name || ' (new)' ELSE store_name END AS store_name,
       store_type FROM dim_store""", "dim_store"))
def q_merge_store_dim(spark, sf):
    """Store rows merged by id: known ones renamed, unknown ones added.  The
    old table holds the even ids; the batch renames a third of all stores and
    adds every store that the old table lacks, so all stores reach the result."""
    dim = B.dim_store(Tables(spark, sf)).select("store_id", "store_code", "store_name", "store_type")
    known = F.col("store_id") % 2 == 0
    batch = dim.filter((F.col("store_id") % 3 == 0) | ~known).withColumn("store_name", F.concat("store_name", F.lit(" (new)")))
    return U.upsert(dim.filter(known), batch, ["store_id"])


@query("merge_metrics", with_ctes("""
SELECT metric, report_year, report_month,
       CASE WHEN report_month > 6 THEN 'R' || COALESCE(value, '') ELSE COALESCE(value, '') END AS value
FROM macro_long WHERE report_month <= 8 OR report_month > 6""", "macro_long"))
def q_merge_metrics(spark, sf):
    """Metric rows merged by (metric, year, month): a half-year is restated, new months are added."""
    long = macro_long(Tables(spark, sf)).withColumn("value", F.coalesce("value", F.lit("")))
    batch = long.filter(F.col("report_month") > 6).withColumn("value", F.concat(F.lit("R"), "value"))
    return U.upsert(long.filter(F.col("report_month") <= 8), batch, ["metric", "report_year", "report_month"])


@query("merge_mapping", with_ctes("""
SELECT source_category, CASE WHEN threshold_ceiling IS NULL THEN 'GIFT_TOP' ELSE canonical_group END AS canonical_group,
       threshold_floor, threshold_ceiling, sort_order FROM gift_mapping
UNION ALL SELECT 'GIFT_' || p_type || '_EXTRA', 'GIFT_LOW', 0, CAST(COUNT(*) AS INTEGER), 9 FROM part GROUP BY p_type""",
    "gift_mapping"))
def q_merge_mapping(spark, sf):
    """Category mapping rows merged by category, NULL bounds kept, bands of new part types added."""
    own = B.gift_mapping(spark)
    batch = own.filter(F.col("threshold_ceiling").isNull()).withColumn("canonical_group", F.lit("GIFT_TOP"))
    fresh = Tables(spark, sf).part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("GIFT_"), "p_type", F.lit("_EXTRA")).alias("source_category"), F.lit("GIFT_LOW").alias("canonical_group"),
        F.lit(0).alias("threshold_floor"), F.col("n").cast("int").alias("threshold_ceiling"), F.lit(9).alias("sort_order"))
    return U.upsert(own, batch.unionByName(fresh), ["source_category"])


@query("schema_evolution", """
SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(NULL AS VARCHAR) AS priority
FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, CAST(NULL AS DECIMAL(18,2)), o_orderpriority FROM orders WHERE o_orderkey % 2 <> 0""")
def q_schema_evolution(spark, sf):
    """Rows of an old and a new schema in one table; what a side lacks is NULL."""
    o = Tables(spark, sf).orders
    old = o.filter(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    new = o.filter(F.col("o_orderkey") % 2 != 0).select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"))
    return U.evolve_schema(old, new)


_TEXT_AMOUNT = """CASE o_orderkey % 9 WHEN 0 THEN 'n/a' WHEN 1 THEN 'NaN' WHEN 2 THEN NULL WHEN 3 THEN 'Infinity'
  ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS {text}) END"""


@query("amount_rejects", """
SELECT reason, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(38,2)) AS total FROM (
  SELECT CASE o_orderkey % 9 WHEN 0 THEN 'not a number' WHEN 1 THEN 'not finite' WHEN 2 THEN 'missing' WHEN 3 THEN 'not finite'
              ELSE 'accepted' END AS reason,
         CASE WHEN o_orderkey % 9 > 3 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders) GROUP BY reason""")
def q_amount_rejects(spark, sf):
    """Text amounts; bad ones are reported by reason, not raised or lost."""
    rows = Tables(spark, sf).orders.select("o_orderkey", F.expr(_TEXT_AMOUNT.format(text="STRING")).alias("amount_text"))
    good, bad = OP.read_amounts(rows, "amount_text")
    both = good.select(F.lit("accepted").alias("reason"), F.col("amount").cast("decimal(18,2)").alias("amount")).unionByName(
        bad.select("reason", F.lit(None).cast("decimal(18,2)").alias("amount")))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(38,2)").alias("total"))


@query("record_type_filter", """
SELECT o_orderstatus IN ('F', 'O') AS kept, COUNT(*) AS n FROM orders GROUP BY 1""")
def q_record_type_filter(spark, sf):
    """Rows of an unknown record type are set aside."""
    o = Tables(spark, sf).orders
    kind = F.when(F.col("o_orderstatus") == "F", "DAILY").when(F.col("o_orderstatus") == "O", "MTD").otherwise(F.col("o_orderstatus"))
    kept, rejected = Q.valid_record_types(o.select(kind.alias("record_type")))
    return kept.select(F.lit(True).alias("kept")).unionAll(rejected.select(F.lit(False).alias("kept"))).groupBy("kept").agg(
        F.count(F.lit(1)).alias("n"))
