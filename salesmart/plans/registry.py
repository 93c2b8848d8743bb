"""Name -> (Spark query, DuckDB oracle SQL) registry.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables.  The
oracle, when SQL can express the operator, is registered next to it so the
two stay in step.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PLAN_MODULES = ["q_marts", "q_text", "q_ingest", "q_quality", "q_upsert", "q_macro",
                "q_features", "q_stats", "q_forecast", "q_stream", "q_ops", "q_store", "q_views"]


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES and QUERIES[name] is not fn:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so its queries register."""
    for m in PLAN_MODULES:
        importlib.import_module(f"salesmart.plans.{m}")
