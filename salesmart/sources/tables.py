"""Readers for the driver tables (one Parquet dataset each).

Reads are lazy: Catalyst prunes columns and pushes filters into the Parquet
scan, so binding code may name whole tables and select what it needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


BROADCAST_ROWS = 500_000       # a dimension of (key, name) with so many rows takes some 50 MB


def broadcast_if_small(dim: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``dim`` with a broadcast hint when it is measured to have at most ``rows``
    rows, else ``dim`` itself.  The planner only knows an estimate, which
    multiplies up over joins, and moves the large side before AQE can see better."""
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._memo: dict[str, DataFrame] = {}

    def memo(self, key: str, build, materialize: bool = True) -> DataFrame:
        """Derived frame built once per query.  Small month-level tables that
        several branches read are materialised with a reliable checkpoint in
        the cluster checkpoint folder: the expensive join behind them runs
        once, and the lineage is cut (a lost executor recomputes nothing
        upstream)."""
        if key not in self._memo:
            df = build()
            if materialize:
                from salesmart.session import checkpoint_dir
                checkpoint_dir(self.spark)
                df = df.checkpoint(eager=True)
            self._memo[key] = df
        return self._memo[key]

    def only(self, name: str, condition) -> "Tables":
        """These tables with only the rows of ``name`` that meet ``condition``:
        the filter stands below all that is derived from the table."""
        t = Tables(self.spark, self.sf_dir)
        t.__dict__[name] = self.read(name).where(condition)
        return t

    def tasks(self, name: str, most: int = 150_000, least: int = 20_000) -> int:
        """Number of shuffle partitions for work on all rows of ``name``: the
        session's, but at most ``most`` and, where there are fewer rows than
        that, at least ``least`` rows each.  The count comes from the file footers."""
        rows = getattr(self, name).count()
        conf = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(-(-rows // most), min(conf, -(-rows // least)), 1)

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            df = self.read(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLE_NAMES
