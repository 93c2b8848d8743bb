"""Streaming query: J6 over ``events`` (availableNow), checked on the final state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.streaming.daily_upsert import day_table, day_totals, run_daily_upsert


@query("stream_daily_upsert", """
SELECT CAST(CAST(ts AS DATE) AS DATE) AS day, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_value, MAX(ts) AS last_ts
FROM events GROUP BY 1, 2""")
def q_stream_daily_upsert(spark, sf):
    """Event files streamed once into per-(day, type) totals, upserted per batch."""
    target = run_daily_upsert(spark, f"{sf}/events.parquet")
    return day_totals(spark, target).select("day", "event_type", "n_events", "total_value", "last_ts")


@query("stream_reload", """
SELECT CAST(CAST(ts AS DATE) AS DATE) AS day, event_type, COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_value, MAX(ts) AS last_ts
FROM events GROUP BY 1, 2""")
def q_stream_reload(spark, sf):
    """All events in two loads by streams that know nothing of each other:
    the second has a fresh checkpoint and sees the first one's files again.  Each
    file counts once, also after the table was compacted between the loads."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/salesmart-stream/{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf}/events.parquet")
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    events.where(~late).write.parquet(f"{base}/events")
    run_daily_upsert(spark, f"{base}/events", target_path=f"{base}/target", checkpoint_path=f"{base}/first", max_files_per_trigger=2)
    day_table(spark, f"{base}/target").compact()
    events.where(late | late.isNull()).write.mode("append").parquet(f"{base}/events")
    run_daily_upsert(spark, f"{base}/events", target_path=f"{base}/target", checkpoint_path=f"{base}/second")
    return day_totals(spark, f"{base}/target").select("day", "event_type", "n_events", "total_value", "last_ts")
