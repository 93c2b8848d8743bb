"""File resolution (J9 cases), job list (J10/C11), cells -> records (I1/I2),
layout (F6/L4), unknown-store policies (J7/J8) and the file listing (A1)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from salesmart.operators import ingest as I
from salesmart.sources.reports import RULE_SCHEMA

D = dt.date(2024, 3, 5)


def resolve(spark, paths, rule=None):
    files = spark.createDataFrame([(p, D) for p in paths], "path string, report_date date")
    rules = spark.createDataFrame([rule] if rule else [], RULE_SCHEMA)
    return I.resolve_files(files, rules).first()


def rule(use=None, instead=None, contains=None, ignore=(), note="n"):
    return (D, use, instead, contains, list(ignore), note)


def test_resolution_cases(spark):
    r = resolve(spark, ["a/DAYREPORT 2024.3.5.pdf"])
    assert (r.status, r.chosen_path) == ("chosen", "a/DAYREPORT 2024.3.5.pdf")
    r = resolve(spark, ["a/x.pdf", "a/old.pdf"], rule(ignore=["OLD.pdf"]))
    assert (r.status, r.chosen_path, r.ignored_files_note) == ("chosen", "a/x.pdf", "old.pdf")
    r = resolve(spark, ["a/x.pdf", "a/y.pdf"], rule(use="y.pdf", instead="x.pdf"))
    assert (r.status, r.chosen_path, r.default_source_file) == ("chosen", "a/y.pdf", "x.pdf")
    assert resolve(spark, ["a/x.pdf"], rule(use="z.pdf")).status == "no_match"
    assert resolve(spark, ["a/x.pdf", "b/x.pdf"], rule(use="x.pdf")).status == "multiple_match"
    r = resolve(spark, ["a/x.pdf", "b\\x.pdf"], rule(use="x.pdf", contains="b/"))
    assert (r.status, r.chosen_path) == ("chosen", "b\\x.pdf")
    r = resolve(spark, ["b/x.pdf", "a/x.pdf"])
    assert r.status == "chosen" and r.chosen_path == "a/x.pdf" and "duplicate" in r.resolution_note
    assert resolve(spark, ["a/x.pdf", "a/y.pdf"]).status == "ambiguous"
    assert resolve(spark, ["a/x.pdf"], rule(ignore=["X.PDF"])).status == "no_file"


def test_job_list(spark):
    res = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "chosen", "r/a.pdf"), (dt.date(2024, 1, 2), "chosen", "r/b.pdf"),
         (dt.date(2024, 1, 3), "ambiguous", None), (dt.date(2024, 2, 1), "chosen", "r/c.pdf")],
        "report_date date, status string, chosen_path string")
    log = spark.createDataFrame([("a.pdf", dt.date(2024, 1, 1), "SUCCESS"), ("b.pdf", dt.date(2024, 1, 2), "FAILED")],
                                "source_file string, report_date date, status string")
    got = [r.source_file for r in I.job_list(res, log, "2024-01-01", "2024-01-31").orderBy("report_date").collect()]
    assert got == ["b.pdf"]
    forced = I.job_list(res, log, None, None, force=True).count()
    assert forced == 3


def cells_frame(spark):
    rows = [
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 0, ["STORE", "SALES", "BUDGET %", "YOY %", "CUSTOMERS", "YOY %"]),
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 10, ["Ban–Ciao", "1,234.50", "N/A", "-", "10", "#N/A", "123.45"]),
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 11, ["", "(5,000)", "N/A", "-", "20"]),
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 12, ["New Store\nALL 19 STORES", "0", "0", "0", "0"]),
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 13, ["7", "8", "9", "10"]),          # offset 0, inherits label
        ("DAYREPORT 2024.3.5 b0.pdf", 1, 2, 0, ["Note", "1", "x"]),               # shorter table: ignored
    ]
    return spark.createDataFrame(rows, "source_file string, page int, table_no int, pos int, cells array<string>")


def test_cells_to_records(spark):
    rec = I.cells_to_records(cells_frame(spark)).orderBy("store_name", "record_type").collect()
    got = [(r.store_name, r.record_type, r.sales_result, r.customer_count, r.unit_price) for r in rec]
    assert got == [("Ban-Ciao", "DAILY", 1234, 10, 123.45), ("Ban-Ciao", "MTD", -5000, 20, None),
                   ("New Store", "DAILY", 0, 0, None), ("New Store", "MTD", 7, 10, None)]
    assert all(r.report_date == D for r in rec)
    assert all(r.ft_expense is None for r in rec)


def test_layout_detect(spark):
    rows = I.data_rows(cells_frame(spark))
    out = I.detect_layout(rows, [("A", 2, 0), ("B", 2, 1)]).first()
    assert (out.p1_rows, out.p2_rows, out.layout, out.warn_page1) == (4, 0, "A", False)


def test_store_policies(spark):
    rec = I.cells_to_records(cells_frame(spark))
    dim = spark.createDataFrame([("Ban-Ciao", 1)], "store_name string, store_id int")
    assert I.apply_store_policy(rec, dim, "skip_row").count() == 2
    assert I.apply_store_policy(rec, dim, "skip_day").count() == 0
    o = I.load_outcomes(I.flag_store_policy(rec, dim, "skip_day"), "skip_day").first()
    assert (o.records_parsed, o.records_loaded, o.status) == (4, 0, "SKIPPED")
    assert [r.store_name for r in I.unknown_stores(rec, dim).collect()] == ["New Store"]


def test_list_report_files(spark, scratch):
    for rel in ["2024/DAYREPORT 2024.3.5.pdf", "2024/sub/DAYREPORT 2024.3.6.pdf", "2024/notes.pdf", "x.txt"]:
        p = os.path.join(scratch, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(b"%PDF")
    got = sorted((os.path.basename(r.path), r.report_date) for r in I.list_report_files(spark, scratch).collect())
    assert got == [("DAYREPORT 2024.3.5.pdf", dt.date(2024, 3, 5)), ("DAYREPORT 2024.3.6.pdf", dt.date(2024, 3, 6))]


def test_bindings_report_cells_have_headers(spark):
    from salesmart.sources.reports import report_cells
    from salesmart.sources.tables import Tables
    c = report_cells(Tables(spark, "/root/testdata/sf0.001"))
    pages = c.select("source_file", "page").distinct().count()
    assert c.filter((F.col("table_no") == 1) & (F.col("pos") == 0)).count() == pages
    assert c.filter(F.col("table_no") == 2).count() == pages


def test_written_report_files_are_listed_by_date(spark, scratch):
    """A1: files in folders by year; names without a valid date are dropped."""
    from salesmart.sources import reports as R
    names = spark.createDataFrame([("1995", "DAYREPORT 1995.3.1 b0.pdf"), ("1995", "DAYREPORT 1995.3.1 b1.pdf"), ("1996", "DAYREPORT 1996.12.31 b0.pdf"),
                                   ("notes", "NOTES 199503.pdf"), ("notes", "DAYREPORT 2001.13.45 x.pdf")], "folder string, name string")
    root = f"file:{scratch}/reports"
    assert R.write_files(names, root) == 5 and R.write_files(names, root) == 5      # a repeated write changes nothing
    got = {str(r.report_date): r["count"] for r in I.list_report_files(spark, root).groupBy("report_date").count().collect()}
    assert got == {"1995-03-01": 2, "1996-12-31": 1}
    assert R.write_files(names.limit(0), root) == 0


def test_tables_can_be_restricted_below_everything_derived(spark):
    from pyspark.sql import functions as F
    from salesmart.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    less = t.only("lineitem", F.col("l_quantity") > 45)
    assert 0 < less.lineitem.count() < t.lineitem.count() and less.orders.count() == t.orders.count()


def test_report_parse_sorts_once_and_moves_no_cells(spark):
    """Lines are parsed before the windows: a page's windows share one sort, the
    labels by position move no lines, and no text cell is sorted."""
    cells = spark.createDataFrame([("DAYREPORT 2024.3.5 b0.pdf", 1, 1, 10, ["A", "1"])],
                                  "source_file string, page int, table_no int, pos int, cells array<string>")
    places = spark.createDataFrame([("DAYREPORT 2024.3.5 b0.pdf", 1, 0, "A")], "source_file string, page int, place int, store_name string")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plain = I.cells_to_records(cells)._jdf.queryExecution().executedPlan().toString()
        placed = I.cells_to_records(cells, places)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plain.count("Sort [") == 1 and plain.count("Exchange") == 1
    assert placed.count("Exchange") == 2      # the lines and the positions, each once
    assert not [x for x in plain.splitlines() if "Window [" in x and "cells#" in x]


def test_labels_by_position_reach_both_lines(spark):
    """Positions with gaps, a label of its own, an odd last line and a page without positions."""
    def line(page, pos, label):
        return ("DAYREPORT 2024.3.5 b0.pdf", page, 1, pos, [label, str(pos), "", "", "2"])
    cells = spark.createDataFrame([line(1, 1, ""), line(1, 2, ""), line(1, 3, "Own"), line(1, 4, ""), line(1, 5, ""), line(1, 6, ""),
                                   line(1, 7, "Odd"), line(2, 1, ""), line(2, 2, "Late")],
                                  "source_file string, page int, table_no int, pos int, cells array<string>")
    places = spark.createDataFrame([("DAYREPORT 2024.3.5 b0.pdf", 1, 0, "P0"), ("DAYREPORT 2024.3.5 b0.pdf", 1, 1, "P1")],
                                   "source_file string, page int, place int, store_name string")
    got = sorted((r.sales_result, r.store_name, r.record_type) for r in I.cells_to_records(cells, places).collect())
    assert got == [(1, "P0", "DAILY"), (2, "Late", "MTD"), (2, "P0", "MTD"), (3, "Own", "DAILY"), (4, "Own", "MTD")]


def test_listing_is_done_by_tasks(spark, scratch, monkeypatch):
    """A1: the driver never holds the files, hidden names and other globs as Spark's own listing."""
    from pyspark.sql.readwriter import DataFrameReader
    own = DataFrameReader.load
    for rel in ["a 1/b/DAYREPORT 2024.3.5 x.pdf", "a 1/_c/DAYREPORT 2024.3.6.pdf", "a 1/.DAYREPORT 2024.3.7.pdf", "_p=1/DAYREPORT 2024.3.8.pdf",
                "DAYREPORT 2024.3.9.txt", "a 1/DAYREPORT 2024.3.4é.pdf", "a 1/DAYREPORT 2024.3.3.PDF"]:
        os.makedirs(os.path.dirname(f"{scratch}/{rel}"), exist_ok=True)
        with open(f"{scratch}/{rel}", "w") as f:
            f.write("x")
    open(f"{scratch}/DAYREPORT 2024.3.10.pdf", "w").close()
    os.makedirs(f"{scratch}/empty")
    for glob in ["*.pdf", "*.{pdf,txt}", "DAY*[45]*", "*2024.3.?.???"]:
        spark_own = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
                     .load(scratch).select("path", "modificationTime").collect())
        with monkeypatch.context() as m:
            m.setattr(DataFrameReader, "load", lambda *a, **k: (_ for _ in ()).throw(AssertionError("listed by the driver")))
            got = I.list_report_files(spark, scratch, glob).collect()
        assert DataFrameReader.load is own and spark_own
        assert sorted((r.path, r.modificationTime) for r in got) == sorted((r.path, r.modificationTime) for r in spark_own)


def _moves(df):
    """Shuffles of a plan, broadcasts and the gathering of a total left out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_reports_are_made_and_parsed_in_two_moves(spark, monkeypatch):
    """The lines by store and month and the store days by report, never the parsed
    lines: not for the stores by position, nor for policies, listings and layouts."""
    from salesmart.plans import q_ingest as Q
    from salesmart.sources import reports as R
    from salesmart.sources.tables import Tables
    monkeypatch.setattr(Tables, "tasks", lambda *a: 3)      # so small a table goes to one partition
    t = Tables(spark, "/root/testdata/sf0.001")
    assert len(_moves(I.cells_to_records(R.report_cells(t)))) == 2
    assert len(_moves(I.cells_to_records(R.damaged_cells(t), R.positions(t)))) == 3      # the positions once
    for q in (Q.q_unknown_stores, Q.q_unknown_store_policy_row, Q.q_layout_detect):
        assert len(_moves(q(spark, "/root/testdata/sf0.001"))) == 2
    records = I.cells_to_records(R.report_cells(t))
    assert len(_moves(I.load_outcomes(I.flag_store_policy(records, Q._snapshot_dim(t), "skip_day"), "skip_day"))) == 2


def test_partitions_grow_with_the_rows_and_small_names_are_broadcast(spark):
    from salesmart.sources.tables import Tables, broadcast_if_small
    t = Tables(spark, "/root/testdata/sf0.001")
    n, conf = t.lineitem.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert t.tasks("lineitem", most=n // (10 * conf), least=1) >= 10 * conf      # not the session's few
    assert t.tasks("lineitem", most=n, least=n) == 1 and t.tasks("lineitem", most=n, least=1) == conf
    dim = spark.createDataFrame([("A",), ("A",), (None,)], "store_name string")
    assert broadcast_if_small(dim, 2) is dim and sorted(map(str, broadcast_if_small(dim, 3).collect())) == sorted(map(str, dim.collect()))


def test_policies_keep_repeated_names(spark):
    """A name that stands twice in the dimension gives two rows, however it is joined."""
    records = spark.createDataFrame([("f", "A"), ("f", "B"), ("f", None)], "source_file string, store_name string")
    dim = spark.createDataFrame([("A", 1), ("A", 2), (None, 3)], "store_name string, store_id bigint")
    got = sorted((str(r.store_name), r.store_id or 0, r._keep) for r in I.flag_store_policy(records, dim).collect())
    assert got == [("A", 1, True), ("A", 2, True), ("B", 0, False), ("None", 0, False)]
    assert sorted(str(r.store_name) for r in I.unknown_stores(records, dim).collect()) == ["B", "None"]
