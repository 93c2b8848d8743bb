"""Upsert queries: final state after keyed merges."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from salesmart.operators import upsert as U
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_ingest import _resolved
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables

MONEY = "decimal(18,2)"
FACT_VALUE_COLS = ["sales_result", "transfer_amount", "sales_incl_result", "customer_count"]


@query("upsert_fact", with_ctes("""
SELECT report_date, store_id, record_type,
       CASE WHEN day(report_date) >= 25 THEN CAST(sales_result + 1 AS DECIMAL(18,2))
            WHEN day(report_date) >= 15 THEN CAST(trunc(sales_result) AS DECIMAL(18,2))
            ELSE sales_result END AS sales_result,
       transfer_amount, sales_incl_result, customer_count
FROM (SELECT *, 'DAILY' AS record_type FROM daily_all)""", "daily_all"))
def q_upsert_fact(spark, sf):
    """Initial load = DAILY rows of days 1-20; a re-load batch restates
    days 15-31 (whole units) and, for days 25-31, carries a later second
    version (+1.00) that must win.  Both go into a Parquet table by month in
    the shared folder; the daily fact is built once."""
    t = Tables(spark, sf)
    daily = t.memo("daily_rows", lambda: B.fact_sales(t, stores_mtd=False, grand_mtd=False).select(
        "report_date", "store_id", "record_type", *FACT_VALUE_COLS, F.date_format("report_date", "yyyyMM").alias("ym")))
    dom = F.dayofmonth("report_date")
    initial = daily.filter(dom <= 20)
    restated = daily.filter(dom >= 15).withColumn(
        "sales_result", F.floor("sales_result").cast(MONEY)).withColumn("seq", F.lit(1))
    later = daily.filter(dom >= 25).withColumn(
        "sales_result", (F.col("sales_result") + 1).cast(MONEY)).withColumn("seq", F.lit(2))
    batch = restated.unionByName(later)
    path, keys = f"{checkpoint_dir(spark).rstrip('/')}/salesmart-fact/{uuid.uuid4().hex}", ["report_date", "store_id", "record_type"]
    U.merge_into_path(spark, path, initial, keys, ["ym"])
    U.merge_into_path(spark, path, batch, keys, ["ym"], order_col="seq")
    return spark.read.schema(daily.schema).parquet(path).drop("ym")


NOW0 = dt.datetime(2024, 1, 1)
NOW1 = dt.datetime(2024, 2, 1)


@query("upsert_resolution", with_ctes("""
SELECT COALESCE(s.report_date, t.report_date) AS report_date,
       CASE WHEN s.report_date IS NOT NULL THEN s.chosen_path ELSE t.chosen_path END AS chosen_path,
       CASE WHEN s.report_date IS NOT NULL THEN s.default_source_file ELSE t.default_source_file END AS default_source_file,
       CASE WHEN s.report_date IS NOT NULL THEN s.resolution_note ELSE t.resolution_note END AS resolution_note,
       COALESCE(t.first_loaded_at, CASE WHEN s.report_date IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END) AS first_loaded_at,
       CASE WHEN s.report_date IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.last_loaded_at END AS last_loaded_at
FROM (SELECT report_date, chosen_path, default_source_file, resolution_note,
             TIMESTAMP '2024-01-01 00:00:00' AS first_loaded_at, TIMESTAMP '2024-01-01 00:00:00' AS last_loaded_at
      FROM resolved WHERE status = 'chosen' AND day(report_date) <= 20) t
FULL OUTER JOIN (SELECT report_date, chosen_path, default_source_file, resolution_note
                 FROM resolved WHERE status = 'chosen' AND day(report_date) >= 10) s
  ON s.report_date = t.report_date""", "resolved"))
def q_upsert_resolution(spark, sf):
    """Resolution table upsert keeping first_loaded_at, bumping last_loaded_at."""
    r = _resolved(spark, sf).filter(F.col("status") == "chosen").select(
        "report_date", "chosen_path", "default_source_file", "resolution_note")
    target = (r.filter(F.dayofmonth("report_date") <= 20)
              .withColumn("first_loaded_at", F.lit(NOW0)).withColumn("last_loaded_at", F.lit(NOW0)))
    source = r.filter(F.dayofmonth("report_date") >= 10)
    return U.upsert_with_timestamps(target, source, "report_date", NOW1)
