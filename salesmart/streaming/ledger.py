"""A table of partial totals with a ledger of the files that it holds.

Layout under the table's path, one folder for each generation::

    gen=<n>/partials/run=<id>/...   totals of some files' rows
    gen=<n>/ledger/...              (file, run): what is loaded, and where it stands
    gen=<n>/_READY                  the generation may be read

A load writes the totals of the files that the ledger does not hold, then their
ledger rows as one file: that file's appearance is the commit.  A run that the
ledger does not name (its task or driver was lost) is never read, and its files
are loaded again.  So each file counts once, whatever checkpoints or batch
numbers the loads had.  Files are known by their path: a file replaced under its
old name is not loaded again.

``compact`` writes the totals of all runs as one run of a new generation, with
all files in its ledger, and marks it ready last; older generations are removed,
but for the one before, which readers may still have open.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "file string, run string"


class PartialsTable:
    """Totals per ``keys``; ``sums`` maps each measure to its aggregate, which
    must also hold over totals (sums, minima, maxima), and its type."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: dict[str, Column], keys: list[str]):
        self.spark, self.path, self.schema, self.merge, self.keys = spark, path.rstrip("/"), schema, merge, keys

    # -- files of the table ------------------------------------------------------
    def _fs(self, path: str):
        """(file system, path) of a path of any kind that Spark reads."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def generations(self) -> list[int]:
        """Numbers of the generations that may be read, the newest last."""
        fs, p = self._fs(self.path)
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        found = [int(n[4:]) for n in found if n.startswith("gen=") and n[4:].isdigit()]
        return sorted(n for n in found if self._exists(f"{self.path}/gen={n}/_READY"))

    def _ready(self, n: int) -> None:
        fs, p = self._fs(f"{self.path}/gen={n}/_READY")
        fs.mkdirs(p.getParent())
        fs.create(p, True).close()

    def _current(self) -> str:
        found = self.generations()
        if not found:
            self._ready(0)
        return f"{self.path}/gen={found[-1] if found else 0}"

    # -- reading -------------------------------------------------------------------
    def ledger(self, generation: str | None = None) -> DataFrame:
        path = f"{generation or self._current()}/ledger"
        return self.spark.read.schema(LEDGER).parquet(path) if self._exists(path) else self.spark.createDataFrame([], LEDGER)

    def _partials(self, generation: str) -> DataFrame:
        path = f"{generation}/partials"
        if not self._exists(path):
            return self.spark.createDataFrame([], f"{self.schema}, run string")
        rows = self.spark.read.schema(f"{self.schema}, run string").parquet(path)
        return rows.join(self.ledger(generation).select("run").distinct(), "run", "left_semi")

    def totals(self) -> DataFrame:
        """One row per key over all loaded files."""
        return self._partials(self._current()).groupBy(*self.keys).agg(*(c.alias(n) for n, c in self.merge.items()))

    # -- writing -------------------------------------------------------------------
    def load(self, rows: DataFrame, partials, file_col: str = "file") -> None:
        """Add the files of ``rows`` that the ledger lacks; ``partials`` turns rows
        into totals by key.  ``rows`` must hold each of its files whole."""
        generation, run = self._current(), uuid.uuid4().hex
        rows = rows.join(self.ledger(generation).select(F.col("file").alias(file_col)), file_col, "left_anti")
        partials(rows).write.parquet(f"{generation}/partials/run={run}")
        # a file's rows count in the run even if none is left after the aggregation
        files = rows.select(F.col(file_col).alias("file")).distinct().withColumn("run", F.lit(run))
        files.coalesce(1).write.mode("append").parquet(f"{generation}/ledger")

    def compact(self) -> int:
        """Rewrite the table as one run; the number of its generation."""
        old = self.generations()
        generation = self._current()
        n, run = int(generation.rpartition("=")[2]) + 1, uuid.uuid4().hex
        new = f"{self.path}/gen={n}"
        fs, p = self._fs(new)
        if fs.exists(p):        # of a compaction that was lost before it was ready
            fs.delete(p, True)
        self.totals().write.parquet(f"{new}/partials/run={run}")
        self.ledger(generation).select("file", F.lit(run).alias("run")).write.parquet(f"{new}/ledger")
        self._ready(n)
        for m in old[:-1]:
            fs, p = self._fs(f"{self.path}/gen={m}")
            fs.delete(p, True)
        return n
