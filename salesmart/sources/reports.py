"""Report-shaped inputs derived from the driver tables.

* ``report_cells``: the daily report as extracted table cells — one row per
  report line with a ragged ``array<string>`` of text cells, rendered from the
  DAILY and MTD fact rows (thousands separators, ``(n)`` negatives, N/A tokens,
  label variants, header rows, a footnote table).  Parsing it back (I1/I2)
  must reproduce the fact values.
* ``file_candidates`` / ``override_rules``: report files per date (duplicates,
  revisions, stale copies) and the per-date override rules of the eight rule
  shapes.  ``load_log``: outcomes of earlier loads.

All are computed by Spark from ``lineitem``/``supplier`` so they grow with the
data.  A report holds one block of at most ``STORES_PER_BLOCK`` stores, so a
report page is a bounded group however large the store table is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import half_up_ratio_2dp
from salesmart.functions.text import format_amount
from salesmart.sources import bindings as B
from salesmart.sources.tables import Tables, broadcast_if_small

STORES_PER_BLOCK = 40          # stores per report file
PAGE1_STORES = 20              # store_id % 40 < 20 -> page 1
# Layouts of this binding: label -> (stores on page 1, stores on page 2), in tie-break order
LAYOUTS = [("A", 4, 4), ("B", 4, 3), ("C", 3, 3), ("D", 5, 4)]
HEADER = ["STORE", "SALES", "BUDGET %", "YOY %", "CUSTOMERS", "YOY %"]


def _date_text(d):
    return F.concat_ws(".", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))


def report_file_name(d, block):
    return F.concat(F.lit("DAYREPORT "), _date_text(d), F.lit(" b"), block.cast("string"), F.lit(".pdf"))


PAGES = ("source_file", "page")


def _page_of(slot):
    return F.when(slot < PAGE1_STORES, 1).otherwise(2)


def _deal_out(rows: DataFrame, names: DataFrame, tasks: int, by) -> DataFrame:
    """``rows`` dealt out by the columns ``by`` with the names of their stores; names
    too many for a broadcast are joined before, so that reports stay together."""
    small = broadcast_if_small(names)
    if small is names:
        return rows.join(names, "store_id").repartition(tasks, *by)
    return rows.repartition(tasks, *by).join(small, "store_id")


def report_cells(t: Tables, by=("source_file",)) -> DataFrame:
    """(source_file, page, table_no, pos, cells) — see module doc.

    One pipeline: the per-store daily aggregate, the MTD running sums beside it
    (window per store-month), then one ``explode`` emitting each store's DAILY
    and MTD lines, plus the page header and a footnote table on the page's
    first store (window per report page, a bounded group).  Only numbers are
    shuffled, the lines by store and month and the store days by report (by
    ``PAGES`` for a parser that looks up ``positions``); names and the text of a
    line are made after that, and all that a parser asks of a report stays within
    its partition."""
    tasks = t.tasks("lineitem")
    daily = B.store_daily_by_month(t, tasks)
    w_mtd = (Window.partitionBy("store_id", "report_month").orderBy("report_date")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = daily.select(
        "report_date", "store_id", "sales_result", "customer_count", "unit_price", "transfer_amount",
        "sales_incl_result",
        F.sum("sales_result").over(w_mtd).cast(B.MONEY).alias("m_sales_result"),
        F.sum("customer_count").over(w_mtd).cast("bigint").alias("m_customer_count"),
        F.sum("transfer_amount").over(w_mtd).cast(B.MONEY).alias("m_transfer_amount"),
        F.sum("sales_incl_result").over(w_mtd).cast(B.MONEY).alias("m_sales_incl_result"))
    sid = F.col("store_id")
    block = (sid / STORES_PER_BLOCK).cast("bigint")
    slot = sid % STORES_PER_BLOCK
    both = both.withColumns({"source_file": report_file_name(F.col("report_date"), block), "page": _page_of(slot)})
    names = B.dim_store(t).select("store_id", "store_name")
    j = _deal_out(both, names, tasks, by).select(
        "*", half_up_ratio_2dp("m_sales_result", "m_customer_count", "decimal(12,2)").alias("m_unit_price"),
        (slot % PAGE1_STORES).alias("row_slot"))
    first_in_page = F.col("row_slot") == F.min("row_slot").over(Window.partitionBy("source_file", "page"))

    values = ["sales_result", "customer_count", "unit_price", "transfer_amount", "sales_incl_result"]
    pos0 = F.lit(10) + F.col("row_slot") * 2

    def line(kind, table_no, pos, prefix=""):
        return F.struct(F.lit(kind).alias("kind"), F.lit(table_no).alias("table_no"), pos.cast("int").alias("pos"),
                        *[F.col(f"{prefix}{v}").alias(v) for v in values])
    lines = F.array(line("daily", 1, pos0), line("mtd", 1, pos0 + 1, "m_"))
    extra = F.array(line("header", 1, F.lit(0)), line("note", 2, F.lit(0)))
    j = j.withColumn("_first", first_in_page)
    j = j.select("source_file", "page", "store_id", "store_name",
                 F.explode(F.when(F.col("_first"), F.concat(lines, extra)).otherwise(lines)).alias("l"))

    measures = F.array(format_amount(F.col("l.sales_result"), 2), F.lit("N/A"), F.lit("-"),
                       format_amount(F.col("l.customer_count"), 0), F.lit("#N/A"),
                       format_amount(F.col("l.unit_price"), 2), F.lit("#VALUE!"),
                       F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.lit(""),
                       format_amount(F.col("l.transfer_amount"), 2), format_amount(F.col("l.sales_incl_result"), 2),
                       F.lit("-"), F.lit("-"))
    name = F.col("store_name")
    label = (F.when(sid % 5 == 1, F.replace(name, F.lit("-"), F.lit("–")))
             .when(sid % 5 == 2, F.concat(name, F.lit("\nALL 19 STORES")))
             .when(sid % 5 == 3, F.concat(F.lit("  "), name, F.lit("  ")))
             .otherwise(name))
    kind = F.col("l.kind")
    bare = (kind == "mtd") & (sid % 3 == 0)                            # no / blank label
    n_measures = F.when((kind == "mtd") & (sid % 7 == 6), 15).otherwise(17)   # ragged line
    texts = F.concat(F.array(F.when(kind == "mtd", "").otherwise(label)), measures)
    cells = (F.when(kind == "header", F.array(*[F.lit(h) for h in HEADER]))
             .when(kind == "note", F.array(F.lit("Note"), F.lit("1,234"), F.lit("unaudited")))
             .otherwise(F.slice(texts, F.when(bare, 2).otherwise(1),
                                n_measures + F.when(bare, 0).otherwise(1))))
    return j.select("source_file", "page", "l.table_no", "l.pos", cells.alias("cells"))


def report_files(t: Tables) -> DataFrame:
    """The files that were delivered: a report for each (date, block), and on
    the first of a month one that holds no table."""
    day = F.col("l_shipdate").cast("date")
    days = t.lineitem.select(day.alias("d"), (F.col("l_suppkey") / STORES_PER_BLOCK).cast("bigint").alias("block")).distinct()
    empty = F.concat(F.lit("DAYREPORT "), _date_text(F.col("d")), F.lit(" empty.pdf"))
    return days.select(report_file_name(F.col("d"), F.col("block")).alias("source_file")).union(
        days.filter(F.dayofmonth("d") == 1).select(empty.alias("source_file")).distinct())


def delivered_names(t: Tables) -> DataFrame:
    """(folder, name) of everything that lies in the report folders: the reports
    by year and month, and for each month a note without a date and a file whose
    name holds an impossible one."""
    named = report_files(t).withColumn("folder", F.regexp_replace(
        F.regexp_extract("source_file", r" (\d{4}\.\d{1,2})\.", 1), r"\.", "/"))
    months = t.lineitem.select(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m")).distinct()
    month = F.date_format("m", "yyyyMM")
    return named.select("folder", F.col("source_file").alias("name")).unionByName(
        months.select(F.lit("notes").alias("folder"), F.concat(F.lit("NOTES "), month, F.lit(".pdf")).alias("name"))).unionByName(
        months.select(F.lit("notes").alias("folder"), F.concat(F.lit("DAYREPORT 2001.13.45 "), month, F.lit(".pdf")).alias("name")))


def write_files(names: DataFrame, root: str) -> int:
    """Write a small file for each (folder, name) under ``root``, a folder that
    all executors share; the number of files.  Tasks write their own rows; a task
    that is repeated writes the same files again."""
    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            rows = batch.to_pylist()
            for folder in {r["folder"] for r in rows}:
                store.create_dir(f"{base}/{folder}", recursive=True)
            for r in rows:
                with store.open_output_stream(f"{base}/{r['folder']}/{r['name']}") as out:
                    out.write(r["name"].encode())
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], names=["n"])
    return names.select("folder", "name").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def positions(t: Tables) -> DataFrame:
    """(source_file, page, place, store_name): which store stands where, the
    fallback for lines without a label.  Dealt out by ``PAGES`` as the cells are."""
    sid = F.col("store_id")
    slot = sid % STORES_PER_BLOCK
    tasks = t.tasks("lineitem")
    lines = t.lineitem.select(report_file_name(F.col("l_shipdate").cast("date"),
                                               (F.col("l_suppkey") / STORES_PER_BLOCK).cast("bigint")).alias("source_file"),
                              F.col("l_suppkey").alias("store_id")).withColumn("page", _page_of(slot))
    present = lines.repartition(tasks, *PAGES).distinct()     # a file holds one date
    named = (present.join(broadcast_if_small(B.dim_store(t).select("store_id", "store_name")), "store_id")
             .select("source_file", "page", "store_id", "store_name"))
    w = Window.partitionBy("source_file", "page").orderBy("store_id")
    return named.withColumn("place", F.row_number().over(w) - 1)


def damaged_cells(t: Tables) -> DataFrame:
    """The report cells with faults that a parser must bear: DAILY lines
    without a label, stray odd lines at the end of page 1, personnel values
    (negative ones among them) in columns that the load blanks."""
    c = report_cells(t, PAGES)
    line = (F.col("table_no") == 1) & (F.col("pos") >= 10) & (F.col("pos") % 2 == 0)
    slot = F.expr("(pos - 10) div 2")
    bare = F.concat(F.array(F.lit("")), F.slice("cells", 2, 100))
    paid = F.concat(F.slice("cells", 1, 8), F.array(F.lit("(5)")), F.slice("cells", 10, 100))
    c = c.withColumn("cells", F.when(line & (slot % 4 == 2), paid).otherwise(F.col("cells")))
    c = c.withColumn("cells", F.when(line & (slot % 3 == 1), bare).otherwise(F.col("cells")))
    stray = F.array(*[F.lit(x) for x in ("Stray", "1", "2", "3", "4", "5")])
    header = (F.col("page") == 1) & (F.col("table_no") == 1) & (F.col("pos") == 0)
    own = F.struct("pos", "cells")
    odd = F.struct(F.lit(1000).alias("pos"), stray.alias("cells"))
    return c.select("source_file", "page", "table_no",
                    F.inline(F.when(header, F.array(own, odd)).otherwise(F.array(own))))


# Out-of-range text in a DAILY line: measure -> what its cell holds, one fault for
# each place on a page modulo the number of measures that are checked
FAULTS = {"sales_result": "(10)", "sales_budget_pct": "123,456.7", "sales_yoy_pct": "(3)", "customer_count": "(7)",
          "unit_price": "(1.50)", "ft_expense": "(5)", "pt_expense": "(2)", "total_personnel_expense": "(9)"}
FAULT_CYCLE = len(FAULTS) + 1


def faulty_cells(t: Tables, measures: list[str]) -> DataFrame:
    """The report cells with one value out of range in most DAILY lines."""
    line = (F.col("table_no") == 1) & (F.col("pos") >= 10) & (F.col("pos") % 2 == 0)
    place = F.expr("(pos - 10) div 2") % FAULT_CYCLE
    cells = F.col("cells")
    for k, (measure, text) in enumerate(FAULTS.items()):
        at = measures.index(measure) + 1      # behind the label
        swapped = F.concat(F.slice("cells", 1, at), F.array(F.lit(text)), F.slice("cells", at + 2, 100))
        cells = F.when(line & (place == k), swapped).otherwise(cells)
    return report_cells(t, PAGES).withColumn("cells", cells)


# ---------------------------------------------------------------------------
# Files per date and override rules
# ---------------------------------------------------------------------------
def _report_dates(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_shipdate").cast("date").alias("report_date")).distinct()


def _case_key(d):
    return F.dayofyear(d) % 29


def file_candidates(t: Tables) -> DataFrame:
    """(path, report_date) for every report file; case by day-of-year % 29:
    1 same name in two folders; 2 same + rule with path filter; 3 two names, no
    rule; 4 two names + use rule; 5 all ignored; 6 stale copy ignored;
    7 rule names a missing file; 8 same name twice + use rule without filter."""
    d = _report_dates(t)
    k = _case_key(F.col("report_date"))
    y = F.year("report_date").cast("string")
    base = F.concat(F.lit("DAYREPORT "), _date_text(F.col("report_date")), F.lit(".pdf"))
    rev = F.concat(F.lit("DAYREPORT "), _date_text(F.col("report_date")), F.lit(" rev.pdf"))
    old = F.concat(F.lit("dayreport "), _date_text(F.col("report_date")), F.lit(" (old).pdf"))
    main = F.concat(F.lit("reports/"), y, F.lit("/"), base)
    paths = F.array(main)
    paths = F.when(k.isin(1, 2, 8), F.array(main, F.concat(F.lit("archive/"), y, F.lit("/"), base))) \
        .when(k.isin(3, 4), F.array(main, F.concat(F.lit("reports/"), y, F.lit("/"), rev))) \
        .when(k == 6, F.array(main, F.concat(F.lit("reports/"), y, F.lit("/"), old))) \
        .otherwise(paths)
    return d.select(F.explode(paths).alias("path"), "report_date")


RULE_SCHEMA = ("report_date date, use_basename string, instead_of_basename string, "
               "path_contains string, ignore_basenames array<string>, note string")


def override_rules(t: Tables) -> DataFrame:
    """Per-date override rules (the YAML document as a DataFrame)."""
    d = _report_dates(t)
    k = _case_key(F.col("report_date"))
    txt = _date_text(F.col("report_date"))
    base = F.concat(F.lit("DAYREPORT "), txt, F.lit(".pdf"))
    rev = F.concat(F.lit("DAYREPORT "), txt, F.lit(" rev.pdf"))
    old = F.concat(F.lit("DAYREPORT "), txt, F.lit(" (OLD).pdf"))
    nul = F.lit(None).cast("string")
    return d.filter(k.isin(2, 4, 5, 6, 7, 8)).select(
        "report_date",
        F.when(k.isin(2, 8), base).when(k == 4, rev).when(k == 7, F.concat(F.lit("missing "), base))
        .otherwise(nul).alias("use_basename"),
        F.when(k == 4, base).otherwise(nul).alias("instead_of_basename"),
        F.when(k == 2, F.lit("archive/")).otherwise(nul).alias("path_contains"),
        F.when(k == 5, F.array(F.lower(base))).when(k == 6, F.array(old))
        .otherwise(F.array().cast("array<string>")).alias("ignore_basenames"),
        F.concat(F.lit("rule "), k.cast("string")).alias("note"))


def load_log(t: Tables) -> DataFrame:
    """Earlier load outcomes (etl_log): every 5th date loaded OK, every 7th failed."""
    files = file_candidates(t)
    dom = F.dayofmonth("report_date")
    status = F.when(dom % 5 == 0, "SUCCESS").when(dom % 7 == 0, "FAILED")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "report_date",
                        status.alias("status")).filter(F.col("status").isNotNull()).distinct()
