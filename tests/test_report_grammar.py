"""The report grammar: damaged labels, KPI blocks, lines that belong nowhere."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import report_grammar as RG


@pytest.mark.parametrize("label,item", [
    ("GIFT 930 DOWN", "GIFT_930_DOWN"), ("Gift\n930↓", "GIFT_930_DOWN"), ("gift 930  ▼", "GIFT_930_DOWN"), ("GIFT\n5000↑", "GIFT_5000_UP"),
    ("F&B", "FB"), ("food\nand  beverage", "FB"), ("Dry\nCake", "DRY_CAKE"), ("Customer Count", "CUSTOMER_COUNT"), ("CUS\nUNIT PRICE", "UNIT_PRICE"),
    ("Average daily sales", "AVERAGE_DAILY_SALES"), ("day in month", "DAY_IN_MONTH"), ("GIFT 123 UP", None), ("AN AVERAGE", None), ("", None), (None, None)])
def test_labels(spark, label, item):
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(RG.item_of(RG.clean_label(F.col("l"))).alias("i")).first()["i"] == item


def lines(spark, rows):
    return spark.createDataFrame([(2001, p, [c[0], *c[1], *["-"] * (15 - len(c[1]))]) for p, c in rows], "report_year int, pos int, cells array<string>")


def test_blocks_are_read_by_their_grammar_and_the_rest_is_listed(spark):
    df = lines(spark, [(0, ("", ["9"])), (1, ("Fbx", ["9"])), (2, ("F&B", ["1,000", "(5)"])), (3, ("", ["99.5"])), (4, ("", ["12.0"])), (5, ("", ["11.0"])),
                       (6, ("", ["7"])), (7, ("Customer\ncount", ["10", "abc"])), (8, ("", ["101.0"])), (9, ("Turnover", ["1.25"])), (20, ("???", ["1"]))])
    got = {(r.item, r.measure, r.period_type, r.report_month): r.value for r in RG.parse_report(df).collect()}
    assert got == {("FB", "sales_result", "MONTHLY", 1): 1000.0, ("FB", "sales_result", "MONTHLY", 2): -5.0, ("FB", "sales_yoy_pct", "MONTHLY", 1): 99.5,
                   ("FB", "composition_curr_pct", "MONTHLY", 1): 12.0, ("FB", "composition_prev_pct", "MONTHLY", 1): 11.0,
                   ("CUSTOMER_COUNT", "customer_count", "MONTHLY", 1): 10.0, ("CUSTOMER_COUNT", "customer_yoy_pct", "MONTHLY", 1): 101.0,
                   ("TURNOVER", "turnover_curr", "MONTHLY", 1): 1.25}
    assert {(r.pos, r.reason) for r in RG.unplaced_lines(df).collect()} == {
        (0, "no label above"), (1, "unknown label"), (6, "beyond its block"), (7, "no number"), (20, "unknown label")}
    kpi = RG.kpi_table(RG.parse_report(df)).first()
    assert (kpi.customer_count, kpi.customer_yoy_pct, kpi.turnover_curr, kpi.avg_daily_sales) == (10.0, 101.0, 1.25, None)


def test_an_own_grammar_and_an_empty_report(spark):
    own = (RG.Block("X", "category", (("a", RG.COUNT),), ("EX",)), RG.Block("Y", "kpi", (("b", RG.MONEY), ("c", RG.PERCENT)), ("WHY",), True))
    values = spark.createDataFrame([(2001, i, m, p, q, v) for i, m, p, q, v in (
        ("X", "a", "MONTHLY", 3, 7.0), ("Y", "b", "H1", None, -1234.5), ("Y", "c", "ANNUAL", None, 99.9))],
        "report_year int, item string, measure string, period_type string, report_month int, value double")
    rendered = RG.render_report(values, grammar=own)
    back = {tuple(r) for r in RG.parse_report(rendered, own).select("report_year", "item", "measure", "period_type", "report_month", "value").collect()}
    assert back == {tuple(r) for r in values.collect()} and RG.unplaced_lines(rendered, own).count() == 0
    assert RG.parse_report(rendered.limit(0), own).count() == 0 and RG.unplaced_lines(rendered.limit(0)).count() == 0
