"""Plan properties of headline queries: pruned scans, no cartesian products,
no row-at-a-time Python UDFs."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

HEADLINE = ["month_end_reconcile", "daily_store_sales", "canonical_monthly", "cells_to_records",
            "resolve_files", "key_audit", "pearson", "naive_scores"]


@pytest.mark.parametrize("name", HEADLINE)
def test_plan_properties(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*/lineitem\.parquet", plan):
        assert len(m.group(1).split(",")) <= 5, m.group(0)   # lineitem has 11 columns


def test_flagship_pushes_grand_total_filter(spark):
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(s_suppkey,-1)" in plan
