"""Report ingest as set-based Spark operators (A1, A2, B10, F6, L4, I1, I2,
J7-J11, C9-C11, H1, H23, H24).

The reference loops over files and rows in Python; here every step is a
filter, window or aggregation over all reports at once.  Windows are
partitioned by (report file, page) — a bounded group (one table of a page).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.text import basename, date_from_filename, join_or_null, normalise_name, parse_amount
from salesmart.session import checkpoint_dir
from salesmart.sources.tables import broadcast_if_small

# Report columns after the label cell, in order (17 measures)
MEASURES = [
    ("sales_result", "int"), ("sales_budget_pct", "float"), ("sales_yoy_pct", "float"),
    ("customer_count", "int"), ("customer_yoy_pct", "float"),
    ("unit_price", "float"), ("unit_price_yoy_pct", "float"),
    ("ft_expense", "int"), ("ft_budget_pct", "float"), ("pt_expense", "int"), ("pt_budget_pct", "float"),
    ("total_personnel_expense", "int"), ("total_personnel_budget_pct", "float"),
    ("transfer_amount", "int"), ("sales_incl_result", "int"),
    ("sales_incl_budget_pct", "float"), ("sales_incl_yoy_pct", "float")]
PERSONNEL = ["ft_expense", "ft_budget_pct", "pt_expense", "pt_budget_pct",
             "total_personnel_expense", "total_personnel_budget_pct"]


# A1 ---------------------------------------------------------------------------
LISTING = "path string, is_folder boolean, modificationTime timestamp"


def _hidden(name: str) -> bool:
    """Names that Spark's own listing passes over."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _list_folders(root: str):
    """Tasks' part of the listing: the entries of each folder of a batch, under
    the paths that begin with ``root``."""
    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(root)
        kind = pa.timestamp("us", "UTC")
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = store.get_file_info(fs.FileSelector(base + folder[len(root):]))
                for i in range(0, len(found), 10_000):
                    part = [f for f in found[i:i + 10_000] if not _hidden(f.base_name)
                            and (f.size or f.type == fs.FileType.Directory)]      # empty files are passed over too
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{folder}/{f.base_name}" for f in part], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in part], pa.bool_()),
                        pa.array([f.mtime_ns and f.mtime_ns // 1_000_000 * 1_000 for f in part], kind)],
                        names=["path", "is_folder", "modificationTime"])
    return run


def list_report_files(spark, root: str, glob: str = "*.pdf") -> DataFrame:
    """Recursive listing of report files with the date parsed from the name;
    undated names dropped.  Only path metadata is read.

    The tasks list the folders, one level of the tree after the other; what a
    level holds is kept in the checkpoint folder.  The driver learns only how
    many folders come next, however many files there are."""
    root = root.rstrip("/")
    checkpoint_dir(spark)
    files, folders = None, spark.createDataFrame([(root,)], "path string")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))     # a number keeps folders apart that are small as rows
    while folders is not None:
        found = folders.repartition(tasks, "path").mapInArrow(_list_folders(root), LISTING).checkpoint(eager=True)
        here = found.where("NOT is_folder").select("path", "modificationTime")
        files = here if files is None else files.unionByName(here)
        folders = found.where("is_folder").select("path")
        folders = None if folders.isEmpty() else folders
    scheme = "" if "://" in root or root.startswith("file:") else "file:"
    files = files.select(F.concat(F.lit(scheme), "path").alias("path"), "modificationTime")
    return (files.where(F.regexp_like(basename("path"), F.lit(glob_pattern(glob))))
            .withColumn("report_date", date_from_filename(basename("path")))
            .filter(F.col("report_date").isNotNull()))


def glob_pattern(glob: str) -> str:
    """Hadoop's file glob (* ? [..] [^..] {a,b} and \\) as a regular expression for whole names."""
    out, depth, in_set, i = "", 0, False, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif in_set:
            in_set = c != "]"
            out += "^" if c == "!" and out.endswith("[") else c
        elif c in "*?":
            out += ".*" if c == "*" else "."
        elif c == "[":
            in_set, out = True, out + c
        elif c == "{":
            depth, out = depth + 1, out + "(?:"
        elif c == "}" and depth:
            depth, out = depth - 1, out + ")"
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)^(?:{out})$"


# A2 B10 ---------------------------------------------------------------------
def _page():
    return Window.partitionBy("source_file", "page")


def _lines():
    """The one order that all windows over a page share."""
    return _page().orderBy("table_no", "pos")


def longest_tables(cells: DataFrame) -> DataFrame:
    """Keep, per (file, page), the table with most rows (lowest table_no on
    ties) — windows over the page, so the cells are read once (no self join).
    The lines are numbered first: all windows then share one shuffle by page
    and one sort, and a table has as many lines as its numbers span."""
    table = Window.partitionBy("source_file", "page", "table_no")
    c = cells.withColumn("_at", F.row_number().over(_lines()))
    c = c.withColumn("_n", F.max("_at").over(table) - F.min("_at").over(table) + 1)
    best = F.max(F.struct(F.col("_n").alias("n"), (-F.col("table_no")).alias("neg_table"))).over(_page())
    c = c.withColumn("_best", best)
    return c.filter((F.col("_n") == F.col("_best.n")) & (F.col("table_no") == -F.col("_best.neg_table"))) \
        .drop("_at", "_n", "_best")


MAX_CELLS = 1 + len(MEASURES)   # label + measures: the record builder reads no further


def cell_numbers(cells) -> F.Column:
    """H2 on each of the first MAX_CELLS cells once: array<double> (NULL past
    the end of a ragged row).  Unrolled per position rather than a lambda so
    the parse stays inside whole-stage codegen."""
    c = F.col(cells) if isinstance(cells, str) else cells
    return F.array(*[parse_amount(F.get(c, i)) for i in range(MAX_CELLS)])


def is_data_row(cells, nums=None) -> F.Column:
    """Any of cells 1..5 parses as a number (an all-zero row counts)."""
    c = F.col(cells) if isinstance(cells, str) else cells
    out = None
    for i in range(1, 6):   # positions past the row's end are NULL
        e = (parse_amount(F.get(c, i)) if nums is None else F.get(nums, i)).isNotNull()
        out = e if out is None else out | e
    return out


def _number_lines(lines: DataFrame) -> DataFrame:
    """The data lines (``_data``) of each page's longest table, numbered 0.. in
    line order.  Lines are parsed before they come here, and columns that nobody
    reads are pruned: what is sorted holds no text cells."""
    rows = longest_tables(lines).filter("_data").drop("_data")
    return rows.withColumn("idx", F.row_number().over(_lines()) - 1)


def data_rows(cells: DataFrame) -> DataFrame:
    """A2 + B10, numbered 0.. within each (file, page) in line order, with the
    parsed numbers (``nums``)."""
    return _number_lines(cells.withColumns({"nums": cell_numbers("cells"), "_data": is_data_row("cells")}))


# F6 L4 -----------------------------------------------------------------------
def detect_layout(rows: DataFrame, layouts, tolerance: int = 2) -> DataFrame:
    """Nearest layout by L1 distance of (page-1 stores, page-2 stores) to each
    layout; the first layout wins ties.  Layouts are a literal array (no join).
    Also flags pages whose row count is off the layout by more than ``tolerance``."""
    per = (rows.groupBy("source_file")
           .agg(F.count_if(F.col("page") == 1).alias("p1_rows"), F.count_if(F.col("page") == 2).alias("p2_rows")))
    lay = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(lbl).alias("label"), F.lit(a).alias("e1"),
                             F.lit(b).alias("e2")) for i, (lbl, a, b) in enumerate(layouts)])
    scored = F.transform(lay, lambda l: F.struct(
        (F.abs(F.col("p1_rows") / 2 - l["e1"]) + F.abs(F.col("p2_rows") / 2 - l["e2"])).alias("dist"),
        l["ord"].alias("ord"), l["label"].alias("label"), l["e1"].alias("e1"), l["e2"].alias("e2")))
    best = F.array_min(scored)
    out = per.withColumn("best", best)
    return out.select(
        "source_file", "p1_rows", "p2_rows", F.col("best.label").alias("layout"),
        F.col("best.dist").alias("distance"),
        (F.abs(F.col("p1_rows") - 2 * F.col("best.e1")) > tolerance).alias("warn_page1"),
        (F.abs(F.col("p2_rows") - 2 * F.col("best.e2")) > tolerance).alias("warn_page2"))


# I1 I2 -----------------------------------------------------------------------
def cells_to_records(cells: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Lines -> typed records as they go to the load: the personnel columns,
    which the checks before it still see (``parsed_records``), are blanked (B16)."""
    return blank_personnel(parsed_records(cells, positions))


def blank_personnel(records: DataFrame) -> DataFrame:
    """The personnel measures of a report are not loaded."""
    kinds = dict(MEASURES)
    return records.withColumns({c: F.lit(None).cast("bigint" if kinds[c] == "int" else "double") for c in PERSONNEL})


def parsed_records(cells: DataFrame, positions: DataFrame | None = None) -> DataFrame:
    """Lines -> typed records with all measures.  Line 2k is the DAILY row and
    2k+1 the MTD row of store k; an odd line at the end of a page belongs to no
    store and is dropped.  The label cell wins; a line without one takes the
    label that ``positions`` (source_file, page, place, store_name) has for its
    pair, a blank MTD label the DAILY one's; pairs without any label are
    dropped.  The column offset is 0 when cell 0 is numeric, else 1;
    out-of-range cells are NULL.  The parse comes before the windows, each
    measure a column of its own, and labels are placed by page: lines are moved
    and sorted once, without their cells and without measures nobody reads, and
    not moved at all when they and ``positions`` come dealt out by page."""
    first = F.get(F.col("cells"), 0)
    numeric = parse_amount(first).isNotNull()
    textual = ~numeric & first.isNotNull() & (first != "")
    # the measures' own cells once a line, in place of a choice for each measure
    own = F.when(numeric, F.col("cells")).otherwise(F.slice("cells", 2, len(MEASURES)))
    lines = cells.select("source_file", "page", "table_no", "pos", F.when(textual, normalise_name(first)).alias("own_label"),
                         own.alias("_own"), is_data_row("cells").alias("_data"))
    meas = []
    for i, (name, kind) in enumerate(MEASURES):
        v = parse_amount(F.get("_own", i))
        meas.append((v.cast("bigint") if kind == "int" else v).alias(name))
    lines = lines.select("source_file", "page", "table_no", "pos", "own_label", *meas, "_data")
    rows = _number_lines(lines).withColumns({"n_lines": F.count(F.lit(1)).over(_page()),
                                             "prev_label": F.lag("own_label", 1).over(_lines())})
    rows = rows.filter(F.col("idx") < F.col("n_lines") - F.col("n_lines") % 2)
    is_mtd = F.col("idx") % 2 == 1
    label = F.when(is_mtd, F.coalesce("own_label", "prev_label")).otherwise(F.col("own_label"))
    if positions is not None:
        # the stores of a page as one row: the lines stay where they are, by (file, page)
        placed = positions.groupBy("source_file", "page").agg(F.collect_list(F.struct("place", "store_name")).alias("placed"))
        here = F.filter("placed", lambda x: x["place"] == F.expr("idx div 2"))["store_name"]
        rows = rows.join(placed, ["source_file", "page"], "left")
        rows = rows.select("*", F.explode_outer(F.when(label.isNull(), here).otherwise(F.array(label))).alias("label"))
        label = F.col("label")
    rows = rows.withColumn("store_name", label).filter(F.col("store_name").isNotNull())
    return rows.select(
        date_from_filename("source_file").alias("report_date"), "store_name",
        F.when(F.col("idx") % 2 == 1, "MTD").otherwise("DAILY").alias("record_type"),
        *[m for m, _ in MEASURES], "source_file")


# J9 J10 J11 ---------------------------------------------------------------------
def resolve_files(files: DataFrame, rules: DataFrame) -> DataFrame:
    """One file per report date (J9) in a single aggregation per date.

    status: chosen | no_file (all ignored) | no_match | multiple_match | ambiguous.
    Same basename in several folders without a rule: first path, with warning."""
    f = files.select("path", "report_date", basename("path").alias("name"))
    j = f.join(rules, "report_date", "left")
    ignored = F.coalesce(F.array_contains(F.transform("ignore_basenames", F.lower), F.lower("name")), F.lit(False))
    norm_path = F.replace(F.col("path"), F.lit("\\"), F.lit("/"))
    is_match = (~ignored & (F.col("name") == F.col("use_basename"))
                & (F.col("path_contains").isNull() | norm_path.contains(F.coalesce("path_contains", F.lit("")))))
    g = j.groupBy("report_date").agg(
        F.count_if(~ignored).alias("n_kept"),
        F.countDistinct(F.when(~ignored, F.col("name"))).alias("n_names"),
        F.min(F.when(~ignored, F.col("path"))).alias("first_kept"),
        F.count_if(is_match).alias("n_match"),
        F.min(F.when(is_match, F.col("path"))).alias("match_path"),
        F.max("use_basename").alias("use_basename"),
        F.max("instead_of_basename").alias("instead_of_basename"),
        F.max("note").alias("note"),
        F.array_sort(F.collect_set(F.when(ignored, F.col("name")))).alias("ignored"))
    has_rule = F.col("use_basename").isNotNull()
    status = (F.when(F.col("n_kept") == 0, "no_file")
              .when(has_rule & (F.col("n_match") == 1), "chosen")
              .when(has_rule & (F.col("n_match") > 1), "multiple_match")
              .when(has_rule, "no_match")
              .when(F.col("n_kept") == 1, "chosen")
              .when(F.col("n_names") == 1, "chosen")
              .otherwise("ambiguous"))
    chosen = (F.when(F.col("status") != "chosen", F.lit(None))
              .when(has_rule, F.col("match_path")).otherwise(F.col("first_kept")))
    warn = (~has_rule & (F.col("n_kept") > 1) & (F.col("n_names") == 1))
    return (g.withColumn("status", status)
            .select("report_date", "status", chosen.alias("chosen_path"),
                    F.when(has_rule & (F.col("status") == "chosen"), F.col("instead_of_basename"))
                    .alias("default_source_file"),
                    F.when(warn, F.concat(F.coalesce("note", F.lit("")), F.lit(" [duplicate paths: first taken]")))
                    .otherwise(F.col("note")).alias("resolution_note"),
                    join_or_null(F.col("ignored")).alias("ignored_files_note")))


def job_list(resolved: DataFrame, log: DataFrame, date_from=None, date_to=None, force: bool = False) -> DataFrame:
    """J10 + B6 + C11: chosen files in the inclusive date range, minus files
    already loaded successfully (unless ``force``), ordered by date."""
    r = resolved.filter(F.col("status") == "chosen")
    if date_from is not None:
        r = r.filter(F.col("report_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        r = r.filter(F.col("report_date") <= F.lit(date_to).cast("date"))
    r = r.withColumn("source_file", basename("chosen_path"))
    if not force:
        done = log.filter(F.col("status") == "SUCCESS").select("source_file")
        r = r.join(done, "source_file", "left_anti")
    return r.select("report_date", "chosen_path", "source_file").orderBy("report_date", "source_file")


def single_file_check(resolved: DataFrame, name: str) -> DataFrame:
    """The named file must be the one the rules choose for its date."""
    d = date_from_filename(F.lit(name))
    return resolved.filter(F.col("report_date") == d).select(
        "report_date", "status", "chosen_path",
        (F.coalesce(basename("chosen_path") == F.lit(name), F.lit(False))).alias("is_rule_choice"))


# J7 J8 C9 C10 -----------------------------------------------------------------
def unknown_stores(records: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct (file, name) not in the store dimension."""
    return (records.select("source_file", "store_name").distinct()
            .join(broadcast_if_small(dim.select("store_name")), "store_name", "left_anti"))


def flag_store_policy(records: DataFrame, dim: DataFrame, policy: str = "skip_row") -> DataFrame:
    """J7 in one pass: left join to the dimension gives store_id (NULL =
    unknown); ``_keep`` says whether the row loads.  skip_row drops unknown
    rows; skip_day drops every row of a file that has any unknown row (a
    window per file — one report, a bounded group)."""
    r = records.join(broadcast_if_small(dim.select("store_name", "store_id")), "store_name", "left")
    unknown = F.col("store_id").isNull()
    if policy == "skip_row":
        keep = ~unknown
    elif policy == "skip_day":
        keep = ~F.max(unknown.cast("int")).over(Window.partitionBy("source_file")).cast("boolean")
    else:
        raise ValueError(policy)
    return r.withColumn("_keep", keep)


def apply_store_policy(records: DataFrame, dim: DataFrame, policy: str = "skip_row") -> DataFrame:
    """The rows that load under ``policy``, with their store_id."""
    return flag_store_policy(records, dim, policy).filter("_keep").drop("_keep")


def load_outcomes(flagged: DataFrame, policy: str, files: DataFrame | None = None) -> DataFrame:
    """One outcome row per file of ``files`` (source_file; without it
    the files that have rows): SUCCESS with the rows loaded, SKIPPED when the
    policy dropped the whole file, FAILED when it parsed to nothing.  The note
    names the unknown stores (at most one report's) or the failure."""
    g = flagged.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records_parsed"), F.count_if(F.col("_keep")).alias("records_loaded"),
        join_or_null(F.array_sort(F.collect_set(F.when(F.col("store_id").isNull(), F.col("store_name"))))).alias("unknown"))
    if files is not None:
        g = files.select("source_file").distinct().join(g, "source_file", "left").fillna(
            0, ["records_parsed", "records_loaded"])
    status = (F.when(F.col("records_parsed") == 0, "FAILED")
              .when(F.col("records_loaded") == 0, "SKIPPED").otherwise("SUCCESS"))
    return g.select("source_file", F.col("records_parsed").cast("bigint").alias("records_parsed"),
                    F.col("records_loaded").cast("bigint").alias("records_loaded"),
                    (F.col("records_parsed") - F.col("records_loaded")).cast("bigint").alias("records_skipped"),
                    status.alias("status"), F.lit(policy).alias("policy"),
                    F.when(F.col("records_parsed") == 0, "no records parsed")
                    .when(F.col("unknown").isNotNull(), F.concat(F.lit("unknown stores: "), "unknown")).alias("note"))
