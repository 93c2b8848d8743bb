"""Null-safe numeric Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(x, lo: float, hi: float) -> Column:
    """pandas-style clip: NULL stays NULL (bare least/greatest would return a bound)."""
    x = col_(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(x, F.lit(hi))))


def guarded_pct_diff(total, other) -> Column:
    """|t - s| * 100 / t, NULL when t is NULL or 0."""
    t, s = col_(total), col_(other)
    return F.when(t.isNull() | (t == 0), F.lit(None)).otherwise(
        F.abs(t - s).cast("double") * 100.0 / t.cast("double"))


def cents(x) -> Column:
    """decimal(.,2) money -> bigint cents (exact)."""
    return (col_(x) * 100).cast("bigint")


def half_up_ratio_2dp(money: str, count: str, out_type: str = "decimal(18,2)") -> Column:
    """money / count rounded half-up to 2 decimals, computed exactly with
    integer cents and integer division so every engine agrees.
    NULL when count is 0/NULL.  Arguments are column names."""
    q = (f"CASE WHEN {count} > 0 THEN "
         f"(CAST({money} * 100 AS BIGINT) * 2 + {count}) div (CAST({count} AS BIGINT) * 2) END")
    return (F.expr(q).cast("decimal(20,0)") / 100).cast(out_type)


def pct(a, b, digits: int = 1) -> Column:
    """a * 100 / b as double rounded; NULL when b is 0/NULL."""
    return F.round(F.try_divide(col_(a).cast("double") * 100.0, col_(b).cast("double")), digits)


def finite_or_null(x) -> Column:
    """NaN / +-inf -> NULL."""
    x = col_(x).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def coerce_double(x) -> Column:
    """to_numeric(errors='coerce') -> NULL for text, NaN and infinities."""
    return finite_or_null(col_(x).try_cast("double"))


def interaction(a, b) -> Column:
    """coalesce(a,0) * coalesce(b,0)."""
    return F.coalesce(col_(a).cast("double"), F.lit(0.0)) * F.coalesce(col_(b).cast("double"), F.lit(0.0))



def avg_exact(x: str, in_scale: int, out_scale: int) -> Column:
    """Aggregate: average of column ``x`` (values carry ``in_scale`` decimals),
    rounded half-up to ``out_scale`` decimals with integer arithmetic, so the
    result does not depend on floating summation order.  Returns double."""
    units = f"CAST(ROUND(CAST({x} AS DOUBLE) * {10 ** in_scale}) AS BIGINT)"
    q = (f"CASE WHEN COUNT({x}) > 0 THEN (SUM({units}) * {10 ** (out_scale - in_scale) * 2} + COUNT({x})) "
         f"div (COUNT({x}) * 2) END")
    return (F.expr(q).cast("decimal(38,0)") / (10 ** out_scale)).cast("double")
