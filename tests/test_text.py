"""H1 H2 H3 H4 H5 H24 on literal frames (cases from the reference's parser)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions.text import (date_from_filename, format_amount, join_or_null, normalise_name,
                                      parse_amount, parse_int, payload_int)


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


def test_date_from_filename_last_valid(spark):
    cases = {
        "DAYREPORT 2020.10.01.pdf": dt.date(2020, 10, 1),
        "DAYREPORT 2025.6.04.pdf": dt.date(2025, 6, 4),
        "old 2019.1.5 DAYREPORT 2020.2.3.pdf": dt.date(2020, 2, 3),
        "DAYREPORT 2020.2.3 rev 2020.13.45.pdf": dt.date(2020, 2, 3),   # invalid later match skipped
        "DAYREPORT 2021.2.29.pdf": None,                                  # not a date
        "README.pdf": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select(
        "v", date_from_filename(F.col("v")).alias("d")).collect()
    assert {r.v: r.d for r in rows} == cases


def test_parse_amount_cases(spark):
    cases = {"1,234": 1234.0, "(1234)": -1234.0, "( 12.5 )": -12.5, "": None, "-": None, "N/A": None,
             "#N/A": None, "#VALUE!": None, "abc": None, "5d": None, None: None, " 7 ": 7.0, "1e3": 1000.0,
             "nan": None, "inf": None, "1_0": None, "0": 0.0}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select(
        "v", parse_amount(F.col("v")).alias("p"), parse_int(F.col("v")).alias("i")).collect()
    got = {r.v: r.p for r in rows}
    assert got == cases
    ints = {r.v: r.i for r in rows}
    assert ints["( 12.5 )"] == -12 and ints["1,234"] == 1234     # truncation toward zero


@settings(max_examples=40, deadline=None)
@given(st.decimals(min_value=-10 ** 9, max_value=10 ** 9, places=2, allow_nan=False, allow_infinity=False))
def test_format_then_parse_round_trip(spark, x):
    df = spark.createDataFrame([(x,)], "v decimal(18,2)")
    r = df.select(parse_amount(format_amount(F.col("v"), 2)).alias("p")).first()["p"]
    assert abs(r - float(x)) < 1e-6


def test_normalise_name(spark):
    cases = {"New Store Sales\nALL 19 STORES": "New Store Sales", "Ban–Ciao": "Ban-Ciao",
             "ALL 19 STORES": "ALL 18 STORES", "ALL 17 STORES": "ALL 18 STORES", "BD": "Business Development",
             "  Taipei 101 ": "Taipei 101", "\n  Webshop\r\nx": "Webshop", "A－B": "A-B"}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select(
        "v", normalise_name(F.col("v")).alias("n")).collect()
    assert {r.v: r.n for r in rows} == cases


def test_payload_and_join(spark):
    df = spark.createDataFrame([("LNY:12|MA:21",), ("",), ("WD:21|CD:31",)], "v string")
    r = df.select(payload_int("v", "LNY").alias("l"), payload_int("v", "MA").alias("m"),
                  payload_int("v", "WD").alias("w")).collect()
    assert [(x.l, x.m, x.w) for x in r] == [(12, 21, None), (None, None, None), (None, None, 21)]
    j = spark.createDataFrame([(["a", "b"],), ([],)], "v array<string>").select(join_or_null("v").alias("j"))
    assert [x.j for x in j.collect()] == ["a; b", None]


def test_amounts_and_labels_off_the_short_way(spark):
    """Texts at the edges of the short ways for NULL tokens, plain numbers and ASCII labels."""
    amounts = {"(": None, "()": None, ")": None, "( 1,0 )": -10.0, "(-5)": None, "(5": None, "5)": None, " - ": None, "(N/A)": None,
               " 7 ": 7.0, "+1": 1.0, "1e2": 100.0, "--1": None, ",": None, "(+5)": None, "\n3": None}
    rows = spark.createDataFrame([(k,) for k in amounts], "v string").select("v", parse_amount("v").alias("r")).collect()
    assert {r.v: r.r for r in rows} == amounts
    labels = {"": "", "  ": "", " BD ": "Business Development", "BD": "Business Development", "A\rB": "A", "\r\n BD\n": "Business Development",
              "B\u2013D": "B-D", " ALL 17 STORES": "ALL 18 STORES", "\u5e97": "\u5e97", "a\tb": "a\tb"}
    rows = spark.createDataFrame([(k,) for k in labels], "v string").select("v", normalise_name("v").alias("r")).collect()
    assert {r.v: r.r for r in rows} == labels
