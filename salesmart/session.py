"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from measured sizes
# (broadcast only when the runtime side is small), splits skewed shuffle
# partitions and coalesces tiny ones.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # HotSpot never compiles a method beyond 8000 bytes: wider projections go in several methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts vary from a few bytes to megabytes: bound what a Python worker gets at once
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "salesmart", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests/bench; on a cluster the submitter's master wins."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    b = (SparkSession.builder.appName(app)
         .master(os.environ.get("SPARK_MASTER", f"local[{cpus}]"))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Runtime-settable SQL confs for a session created elsewhere (the driver)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)   # all are runtime settings: a failure is worth knowing


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``salesmart`` importable in the Python workers (pandas UDFs pickle
    functions by module reference): zip the package once and ``addPyFile`` it,
    which distributes it to every executor of the context."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    ckpt = checkpoint_dir(spark)
    local = ckpt[len("file:"):] if ckpt.startswith("file:") else ckpt
    out_dir = local if "://" not in local and os.path.isdir(local) else tempfile.mkdtemp(prefix="salesmart-py-")
    zpath = os.path.join(out_dir, f"salesmart-{os.getpid()}.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared lineage-cut folder.

    The cluster names it in ``spark.checkpoint.dir`` or on the context; only in
    local mode (unit tests) may it be missing, and a private folder is made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    d = d or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core conf may be read-only
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
