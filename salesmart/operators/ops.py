"""Operational helpers: sources/sinks and run reporting (A3 A5 A6 A7 A8 A11
A13 A14 D6 D24 G3 J11 F1 F7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.numeric import coerce_double
from salesmart.sources.reports import RULE_SCHEMA


def read_override_rules(spark: SparkSession, path: str) -> DataFrame:
    """A3: override rules from JSON lines with an explicit schema; a missing
    document means "no rules" (an empty frame), as in the reference."""
    try:
        return spark.read.schema(RULE_SCHEMA).json(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is tolerated
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], RULE_SCHEMA)
        raise


def write_override_rules(rules: DataFrame, path: str) -> None:
    rules.write.mode("overwrite").json(path)


def read_csv_dataset(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A5: CSV dataset with header and explicit schema (UTF-8 BOM tolerated)."""
    return spark.read.option("header", True).option("encoding", "UTF-8").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, order_by=(), bom: bool = False) -> None:
    """A8 + F1: CSV sink with header, rows ordered at the sink; ``bom`` puts a
    byte order mark before each file's header, as spreadsheets want it."""
    out = df.orderBy(*order_by) if order_by else df
    if bom:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    out.write.mode("overwrite").option("header", True).csv(path)


def require_non_empty(df: DataFrame, what: str) -> DataFrame:
    """A dimension that must not be empty (one-row probe, no full count)."""
    if not df.limit(1).take(1):
        raise ValueError(f"{what} is empty")
    return df


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Publish marts as temporary views for SQL / BI clients."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def dry_run_counts(records: DataFrame) -> DataFrame:
    """What a load would write, counted by record type (no sink)."""
    return records.groupBy("record_type").agg(F.count(F.lit(1)).alias("n_records"),
                                              F.countDistinct("source_file").alias("n_files"))


def run_totals(outcomes: DataFrame) -> DataFrame:
    """Loaded / skipped / failed files and rows from the per-file outcomes."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"),
                                          F.sum("records_loaded").alias("records_loaded"))


def set_difference_report(actual: DataFrame, expected: DataFrame, cols) -> DataFrame:
    """Rows of ``actual`` missing from ``expected`` and vice versa (exceptAll
    both ways); empty means the sets (with multiplicity) are equal."""
    a = actual.select(*cols)
    e = expected.select(*cols)
    return (a.exceptAll(e).withColumn("side", F.lit("unexpected"))
            .unionByName(e.exceptAll(a).withColumn("side", F.lit("missing"))))


def read_amounts(rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose text is a finite number, as ``amount``; rejected
    rows with the reason).  Nothing raises on bad text."""
    own = rows.withColumn("_number", F.col(column).try_cast("double")).withColumn("amount", coerce_double(column))
    why = (F.when(F.col(column).isNull(), "missing").when(F.col("_number").isNull(), "not a number")
           .otherwise("not finite"))
    return (own.filter(F.col("amount").isNotNull()).drop("_number"),
            own.filter(F.col("amount").isNull()).withColumn("reason", why).drop("_number", "amount"))


def save_model_table(coefs: DataFrame, path: str) -> None:
    """Fitted coefficients as a Parquet table (one row per series x fold x alpha)."""
    coefs.write.mode("overwrite").parquet(path)
