"""Keyed upsert without a row-level catalog.

``upsert`` is the set-based MERGE: target rows whose key is not in the batch,
plus the winning batch row per key (latest ``order_col``).  ``merge_into_path``
applies it to a Parquet table partitioned by date parts: only partitions the
batch touches are read, merged and rewritten (dynamic partition overwrite);
the merged frame is checkpointed into the cluster checkpoint folder first so
the write never reads the files it replaces.  The audit row is appended last.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """New state after MERGE(batch INTO target ON keys): batch rows win; among
    several batch rows for a key the one with the greatest ``order_col`` wins.
    Keys are compared NULL-safe (``<=>``) so nullable key parts still match."""
    cols = target.columns
    order = F.col(order_col) if order_col else F.lit(None).cast("int")
    new = batch.select(*cols, F.lit(1).alias("_new"), order.alias("_order"))
    old = target.select(*cols, F.lit(0).alias("_new"), F.lit(None).cast(new.schema["_order"].dataType).alias("_order"))
    # both sides meet in one shuffle and one sort; a key's batch rows stand first
    w = Window.partitionBy(*keys).orderBy(F.col("_new").desc(), F.col("_order").desc())
    both = old.unionByName(new).withColumns({"_any": F.first("_new").over(w), "_rn": F.row_number().over(w)})
    wins = (F.col("_rn") == 1) if order_col else F.lit(True)
    return both.filter(F.when(F.col("_new") == 1, wins).otherwise(F.col("_any") == 0)).select(*cols)


def upsert_with_timestamps(target: DataFrame, source: DataFrame, key: str, now,
                           first_col: str = "first_loaded_at", last_col: str = "last_loaded_at") -> DataFrame:
    """Full outer join on ``key``; source values win, ``first_col`` keeps the
    target's first load, ``last_col`` moves to ``now`` for keys in the source."""
    value_cols = [c for c in source.columns if c != key]
    t = target.alias("t")
    s = source.alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    in_s = F.col(f"s.{key}").isNotNull()
    out = [F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key)]
    for c in value_cols:
        out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    out.append(F.coalesce(F.col(f"t.{first_col}"), F.when(in_s, F.lit(now))).cast("timestamp").alias(first_col))
    out.append(F.when(in_s, F.lit(now)).otherwise(F.col(f"t.{last_col}")).cast("timestamp").alias(last_col))
    return j.select(*out)


def evolve_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive schema evolution — columns missing on either side are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def merge_into_path(spark: SparkSession, path: str, batch: DataFrame, keys: list[str],
                    partition_cols: list[str], order_col: str | None = None) -> int:
    """Upsert ``batch`` into the Parquet table at ``path`` (created if absent).

    Returns the number of batch rows applied.  A batch with several rows for a
    key needs ``order_col``.  Only touched partitions are rewritten; the merged
    partitions are checkpointed (reliable checkpoint in the shared checkpoint
    folder) before the overwrite.  The session's settings stay as they are."""
    checkpoint_dir(spark)
    try:
        current = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # any other failure must not pass for a first load
            raise
        current = None
    batch = batch.checkpoint(eager=True)
    if order_col is None and batch.groupBy(*keys).count().where("count > 1").head(1):
        raise ValueError(f"rows of the batch share a key of {keys} and no order_col says which one wins")
    data_cols = [c for c in batch.columns if c != order_col] if order_col else batch.columns
    if current is None:
        # nothing is replaced, so what is written needs no copy of its own
        merged = upsert(batch.limit(0).select(*data_cols), batch, keys, order_col) if order_col else batch
    else:
        touched = batch.select(*partition_cols).distinct()
        cur = current.join(touched, partition_cols, "left_semi").select(*data_cols)
        merged = upsert(cur, batch, keys, order_col).checkpoint(eager=True)
    # rows of a partition together, large ones in several tasks: few files for each
    merged.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(path)
    return batch.count()   # of the checkpointed rows


def append_log(path: str, rows: DataFrame) -> str:
    """Append-only audit log (written after the data it describes),
    each row with its run's id and the time of the load; returns the id."""
    run_id = str(uuid.uuid4())
    rows.withColumns({"run_id": F.lit(run_id), "loaded_at": F.current_timestamp()}).write.mode("append").parquet(path)
    return run_id
