"""Calendar Column helpers (H12-H16, H20, C6 spine)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import col_


def days_in_month(d) -> Column:
    """H13."""
    return F.dayofmonth(F.last_day(col_(d)))


def weekdays_in_month(d) -> Column:
    """Monday-Friday count of the month containing ``d``."""
    d = col_(d)
    return F.size(F.filter(F.sequence(F.trunc(d, "month"), F.last_day(d)),
                           lambda x: F.weekday(x) < 5))


def working_days_fallback(wd, cd) -> Column:
    """Missing working days -> calendar_days * 5 div 7."""
    return F.coalesce(col_(wd), F.floor(col_(cd) * 5 / 7).cast("int"))


def weekend_days(cd, wd) -> Column:
    """Calendar - working, NULLs as 0."""
    return F.coalesce(col_(cd), F.lit(0)) - F.coalesce(col_(wd), F.lit(0))


def month_spine(df: DataFrame, c: str) -> DataFrame:
    """Every (report_year, report_month) from min(c) to max(c).

    One-row min/max aggregate exploded into months; bounded by the calendar
    span, not by the number of input rows."""
    b = df.agg(F.trunc(F.min(c), "month").alias("lo"), F.trunc(F.max(c), "month").alias("hi"))
    m = b.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start"))
    return m.select(F.year("month_start").alias("report_year"),
                    F.month("month_start").alias("report_month"), "month_start")
