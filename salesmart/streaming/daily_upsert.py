"""J6 as Structured Streaming: new event files -> day totals -> stored partials.

``foreachBatch`` aggregates the rows of a micro-batch's files only and adds them
to a table of partial totals whose ledger names the files that it holds (see
``ledger``).  A file counts once, also when a batch is replayed after a lost
executor or driver, when the stream starts anew with a fresh checkpoint, or when
another stream has loaded it.  The table's totals are the sum of the partials:
files may come in any order and events may be late by any time, nothing is
dropped.  No state store, watermark or session setting is needed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir
from salesmart.streaming.ledger import PartialsTable

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")
KEYS = ["day", "event_type"]
MONEY = "decimal(38,2)"
PARTIALS = f"day date, event_type string, n_events bigint, total_value {MONEY}, last_ts timestamp_ntz"


def event_stream(spark: SparkSession, source: str, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The event files at ``source``: a folder of part files (optionally only
    those whose names match ``glob``) or a single file."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    parent, _, name = source.rstrip("/").rpartition("/")
    if not glob:   # a file is streamed as its folder's only file of that name
        files = spark.read.schema(EVENT_SCHEMA).parquet(source).inputFiles()
        if len(files) == 1 and files[0].endswith(f"/{parent.rpartition('/')[2]}/{name}"):
            source, glob = parent, name
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source)


def day_partials(events: DataFrame) -> DataFrame:
    """Totals of some events per (day, type); sums of such rows are totals again."""
    return (events.groupBy(F.to_date("ts").alias("day"), "event_type")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast(MONEY).alias("total_value"),
                 F.max("ts").alias("last_ts")))


def day_table(spark: SparkSession, path: str) -> PartialsTable:
    """The table of day totals at ``path``."""
    merge = {"n_events": F.sum("n_events"), "total_value": F.sum("total_value").cast(MONEY), "last_ts": F.max("last_ts")}
    return PartialsTable(spark, path, PARTIALS, merge, KEYS)


def day_totals(spark: SparkSession, path: str) -> DataFrame:
    """The table's state: one row per key over all files."""
    return day_table(spark, path).totals().withColumn("total_value", F.col("total_value").cast("decimal(18,2)"))


def run_daily_upsert(spark: SparkSession, source: str, glob: str | None = None,
                     target_path: str | None = None, checkpoint_path: str | None = None,
                     max_files_per_trigger: int | None = None, compact_after: int = 100) -> str:
    """Process every available event file once (availableNow) into the table of
    partials; returns its path.  Re-running processes only new files; the table
    is compacted after ``compact_after`` batches."""
    base = checkpoint_dir(spark).rstrip("/")
    run = uuid.uuid4().hex
    target_path = target_path or f"{base}/salesmart-stream/{run}/target"
    checkpoint_path = checkpoint_path or f"{base}/salesmart-stream/{run}/checkpoint"

    table, done = day_table(spark, target_path), []

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.load(batch, day_partials)
        done.append(batch_id)
        if len(done) % compact_after == 0:
            table.compact()

    events = event_stream(spark, source, glob, max_files_per_trigger).select("*", F.col("_metadata.file_path").alias("file"))
    q = (events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target_path
