"""Report ingest queries: cells -> records, layout check, file resolution,
incremental job list, unknown-store policies (I1 I2 F6 B10 L4 J7-J10 C9-C11 B6 B9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesmart.operators import ingest as I
from salesmart.operators import quality as Q
from salesmart.plans.oracle_base import cte, with_ctes
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.sources import bindings as B
from salesmart.sources import reports as R
from salesmart.sources.tables import Tables

_TXT = "CAST(year({d}) AS VARCHAR) || '.' || CAST(month({d}) AS VARCHAR) || '.' || CAST(day({d}) AS VARCHAR)"


def _txt(d):
    return _TXT.format(d=d)


cte("expected_records", ["daily_all", "mtd_all", "dim_store"], f"""
SELECT f.report_date, d.store_name, f.record_type,
       CAST(trunc(f.sales_result) AS BIGINT) AS sales_result, CAST(NULL AS DOUBLE) AS sales_budget_pct,
       CAST(NULL AS DOUBLE) AS sales_yoy_pct, CAST(f.customer_count AS BIGINT) AS customer_count,
       CAST(NULL AS DOUBLE) AS customer_yoy_pct, CAST(f.unit_price AS DOUBLE) AS unit_price,
       CAST(NULL AS DOUBLE) AS unit_price_yoy_pct, CAST(NULL AS BIGINT) AS ft_expense,
       CAST(NULL AS DOUBLE) AS ft_budget_pct, CAST(NULL AS BIGINT) AS pt_expense,
       CAST(NULL AS DOUBLE) AS pt_budget_pct, CAST(NULL AS BIGINT) AS total_personnel_expense,
       CAST(NULL AS DOUBLE) AS total_personnel_budget_pct,
       CAST(trunc(f.transfer_amount) AS BIGINT) AS transfer_amount,
       CAST(trunc(f.sales_incl_result) AS BIGINT) AS sales_incl_result,
       CAST(NULL AS DOUBLE) AS sales_incl_budget_pct, CAST(NULL AS DOUBLE) AS sales_incl_yoy_pct,
       'DAYREPORT ' || {_txt('f.report_date')} || ' b' || CAST(f.store_id // 40 AS VARCHAR) || '.pdf' AS source_file,
       f.store_id
FROM (SELECT *, 'DAILY' AS record_type FROM daily_all WHERE store_id >= 0
      UNION ALL SELECT *, 'MTD' FROM mtd_all WHERE store_id >= 0) f
JOIN dim_store d ON d.store_id = f.store_id""")

RECORD_COLS = ["report_date", "store_name", "record_type"] + [m for m, _ in I.MEASURES] + ["source_file"]


def _records(spark, sf):
    return I.cells_to_records(R.report_cells(Tables(spark, sf)))


@query("cells_to_records", with_ctes("SELECT " + ", ".join(RECORD_COLS) + " FROM expected_records",
                                     "expected_records"))
def q_cells_to_records(spark, sf):
    """Report cells parsed back to typed records."""
    return _records(spark, sf)


@query("cells_damaged", with_ctes("SELECT " + ", ".join(RECORD_COLS) + " FROM expected_records",
                                  "expected_records"))
def q_cells_damaged(spark, sf):
    """Missing labels, odd trailing lines and personnel values parse
    to the same records."""
    t = Tables(spark, sf)
    return I.cells_to_records(R.damaged_cells(t), R.positions(t))


@query("personnel_range", with_ctes("""
SELECT record_type, COUNT(*) AS n_records,
       COUNT(*) FILTER (WHERE record_type = 'DAILY' AND store_id % 20 % 4 = 2) AS n_negative
FROM expected_records GROUP BY record_type""", "expected_records"))
def q_personnel_range(spark, sf):
    """The range check sees the personnel measures before they are blanked."""
    t = Tables(spark, sf)
    r = I.parsed_records(R.damaged_cells(t), R.positions(t))
    return r.groupBy("record_type").agg(F.count(F.lit(1)).alias("n_records"),
                                        F.count_if(F.col("ft_expense") < 0).alias("n_negative"))


def _parsed_range_sql():
    def count(c, below):
        lo, hi = Q.RANGE_CHECKS[c]
        if c not in R.FAULTS or (lo if below else hi) is None or below != R.FAULTS[c].startswith("("):
            return "COUNT(*) FILTER (WHERE FALSE)"
        k = list(R.FAULTS).index(c)
        return f"COUNT(*) FILTER (WHERE record_type = 'DAILY' AND store_id % 20 % {R.FAULT_CYCLE} = {k})"
    bound = {None: "CAST(NULL AS DOUBLE)"}
    return " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, {bound.get(lo, f'CAST({lo} AS DOUBLE)')} AS lo, {bound.get(hi, f'CAST({hi} AS DOUBLE)')} AS hi,
       {count(c, True)} AS n_below, {count(c, False)} AS n_above FROM expected_records""" for c, (lo, hi) in Q.RANGE_CHECKS.items())


@query("range_audit_parsed", with_ctes(_parsed_range_sql(), "expected_records"))
def q_range_audit_parsed(spark, sf):
    """All nine checked columns of the parsed reports, each with values out of
    its range, before the personnel measures are blanked."""
    t = Tables(spark, sf)
    return Q.range_audit(I.parsed_records(R.faulty_cells(t, [m for m, _ in I.MEASURES]), R.positions(t)))


@query("report_listing", f"""
SELECT d AS report_date, COUNT(*) AS n_files FROM (
  SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_suppkey // {R.STORES_PER_BLOCK} AS block FROM lineitem
  UNION ALL SELECT DISTINCT CAST(l_shipdate AS DATE), -1 FROM lineitem WHERE day(CAST(l_shipdate AS DATE)) = 1) GROUP BY d""")
def q_report_listing(spark, sf):
    """A1: the report folders listed by file metadata, files by the date in their
    names; names without a valid date are dropped."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/salesmart-reports/{uuid.uuid4().hex}"
    R.write_files(R.delivered_names(Tables(spark, sf)), root)
    return I.list_report_files(spark, root).groupBy("report_date").agg(F.count(F.lit(1)).alias("n_files"))


_LAYOUT_VALUES = ", ".join(f"({i}, '{lbl}', {a}, {b})" for i, (lbl, a, b) in enumerate(R.LAYOUTS))


@query("layout_detect", with_ctes(f"""
SELECT source_file, p1_rows, p2_rows, label AS layout, dist AS distance,
       abs(p1_rows - 2 * e1) > 2 AS warn_page1, abs(p2_rows - 2 * e2) > 2 AS warn_page2
FROM (SELECT p.*, l.*, abs(p1_rows / 2 - e1) + abs(p2_rows / 2 - e2) AS dist,
             ROW_NUMBER() OVER (PARTITION BY source_file ORDER BY abs(p1_rows / 2 - e1) + abs(p2_rows / 2 - e2), ord) AS rn
      FROM pages p, (VALUES {_LAYOUT_VALUES}) l(ord, label, e1, e2))
WHERE rn = 1""", "store_daily", local={"pages": f"""
SELECT 'DAYREPORT ' || {_txt('report_date')} || ' b' || CAST(store_id // 40 AS VARCHAR) || '.pdf' AS source_file,
       2 * COUNT(*) FILTER (WHERE store_id % 40 < 20) AS p1_rows,
       2 * COUNT(*) FILTER (WHERE store_id % 40 >= 20) AS p2_rows
FROM store_daily GROUP BY 1"""}))
def q_layout_detect(spark, sf):
    """F6 + L4: nearest layout per report file and row-count warnings."""
    return I.detect_layout(I.data_rows(R.report_cells(Tables(spark, sf))), R.LAYOUTS)


# --- file resolution (oracle written as per-date CASE logic) -----------------------
cte("report_dates", [], "SELECT DISTINCT CAST(l_shipdate AS DATE) AS report_date FROM lineitem")
cte("file_candidates", ["report_dates"], f"""
SELECT unnest(CASE WHEN k IN (1, 2, 8) THEN [main, 'archive/' || y || '/' || base]
                   WHEN k IN (3, 4) THEN [main, 'reports/' || y || '/' || rev]
                   WHEN k = 6 THEN [main, 'reports/' || y || '/' || old]
                   ELSE [main] END) AS path, report_date
FROM (SELECT report_date, dayofyear(report_date) % 29 AS k, CAST(year(report_date) AS VARCHAR) AS y,
             'DAYREPORT ' || {_txt('report_date')} || '.pdf' AS base,
             'DAYREPORT ' || {_txt('report_date')} || ' rev.pdf' AS rev,
             'dayreport ' || {_txt('report_date')} || ' (old).pdf' AS old,
             'reports/' || CAST(year(report_date) AS VARCHAR) || '/DAYREPORT ' || {_txt('report_date')} || '.pdf' AS main
      FROM report_dates)""")
cte("override_rules", ["report_dates"], f"""
SELECT report_date,
       CASE WHEN k IN (2, 8) THEN base WHEN k = 4 THEN rev WHEN k = 7 THEN 'missing ' || base END AS use_basename,
       CASE WHEN k = 4 THEN base END AS instead_of_basename,
       CASE WHEN k = 2 THEN 'archive/' END AS path_contains,
       CASE WHEN k = 5 THEN [lower(base)] WHEN k = 6 THEN [old] ELSE CAST([] AS VARCHAR[]) END AS ignore_basenames,
       'rule ' || CAST(k AS VARCHAR) AS note
FROM (SELECT report_date, dayofyear(report_date) % 29 AS k,
             'DAYREPORT ' || {_txt('report_date')} || '.pdf' AS base,
             'DAYREPORT ' || {_txt('report_date')} || ' rev.pdf' AS rev,
             'DAYREPORT ' || {_txt('report_date')} || ' (OLD).pdf' AS old
      FROM report_dates) WHERE k IN (2, 4, 5, 6, 7, 8)""")
cte("resolved", ["file_candidates", "override_rules"], """
SELECT report_date, status,
       CASE WHEN status <> 'chosen' THEN NULL WHEN use_basename IS NOT NULL THEN match_path ELSE first_kept END AS chosen_path,
       CASE WHEN use_basename IS NOT NULL AND status = 'chosen' THEN instead_of_basename END AS default_source_file,
       CASE WHEN use_basename IS NULL AND n_kept > 1 AND n_names = 1
            THEN COALESCE(note, '') || ' [duplicate paths: first taken]' ELSE note END AS resolution_note,
       CASE WHEN len(ignored) > 0 THEN array_to_string(ignored, '; ') END AS ignored_files_note
FROM (SELECT *, CASE WHEN n_kept = 0 THEN 'no_file'
                     WHEN use_basename IS NOT NULL AND n_match = 1 THEN 'chosen'
                     WHEN use_basename IS NOT NULL AND n_match > 1 THEN 'multiple_match'
                     WHEN use_basename IS NOT NULL THEN 'no_match'
                     WHEN n_kept = 1 THEN 'chosen' WHEN n_names = 1 THEN 'chosen'
                     ELSE 'ambiguous' END AS status
      FROM (SELECT f.report_date,
                   COUNT(*) FILTER (WHERE NOT ign) AS n_kept,
                   COUNT(DISTINCT name) FILTER (WHERE NOT ign) AS n_names,
                   MIN(path) FILTER (WHERE NOT ign) AS first_kept,
                   COUNT(*) FILTER (WHERE mt) AS n_match,
                   MIN(path) FILTER (WHERE mt) AS match_path,
                   MAX(use_basename) AS use_basename, MAX(instead_of_basename) AS instead_of_basename,
                   MAX(note) AS note,
                   list_sort(list_distinct(list(name) FILTER (WHERE ign))) AS ignored
            FROM (SELECT f.*, r.use_basename, r.instead_of_basename, r.path_contains, r.note, name,
                         COALESCE(list_contains(list_transform(r.ignore_basenames, lambda x: lower(x)), lower(name)), FALSE) AS ign,
                         NOT COALESCE(list_contains(list_transform(r.ignore_basenames, lambda x: lower(x)), lower(name)), FALSE)
                           AND name = r.use_basename
                           AND (r.path_contains IS NULL OR contains(replace(f.path, '\\', '/'), r.path_contains)) AS mt
                  FROM (SELECT *, string_split(replace(path, '\\', '/'), '/')[-1] AS name FROM file_candidates) f
                  LEFT JOIN override_rules r ON r.report_date = f.report_date) f
            GROUP BY f.report_date))""")


def _resolved(spark, sf):
    t = Tables(spark, sf)
    return I.resolve_files(R.file_candidates(t), R.override_rules(t))


@query("resolve_files", with_ctes("SELECT * FROM resolved", "resolved"))
def q_resolve_files(spark, sf):
    """One file per report date under the override rules."""
    return _resolved(spark, sf)


cte("load_log", ["file_candidates"], """
SELECT DISTINCT string_split(path, '/')[-1] AS source_file, report_date,
       CASE WHEN day(report_date) % 5 = 0 THEN 'SUCCESS' WHEN day(report_date) % 7 = 0 THEN 'FAILED' END AS status
FROM file_candidates WHERE day(report_date) % 5 = 0 OR day(report_date) % 7 = 0""")


@query("incremental_jobs", with_ctes("""
SELECT r.report_date, r.chosen_path, string_split(r.chosen_path, '/')[-1] AS source_file
FROM resolved r
WHERE r.status = 'chosen' AND r.report_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
  AND string_split(r.chosen_path, '/')[-1] NOT IN (SELECT source_file FROM load_log WHERE status = 'SUCCESS')""",
    "resolved", "load_log"))
def q_incremental_jobs(spark, sf):
    """J10 + B6 + C11: resolved files in range, minus files already loaded."""
    t = Tables(spark, sf)
    return I.job_list(_resolved(spark, sf), R.load_log(t), "1996-01-01", "2000-12-31")


# --- unknown-store policies: the dimension snapshot predates stores with id % 13 = 0
def _snapshot_dim(t):
    return B.dim_store(t).filter(F.col("store_id") % 13 != 0)


@query("unknown_stores", with_ctes("""
SELECT DISTINCT source_file, store_name FROM expected_records WHERE store_id % 13 = 0""", "expected_records"))
def q_unknown_stores(spark, sf):
    """Report labels missing from the store dimension."""
    t = Tables(spark, sf)
    return I.unknown_stores(_records(spark, sf), _snapshot_dim(t))


@query("unknown_store_policy_row", with_ctes("""
SELECT report_date, store_id, store_name, record_type, sales_result, customer_count, source_file
FROM expected_records WHERE store_id % 13 <> 0""", "expected_records"))
def q_unknown_store_policy_row(spark, sf):
    """J7 skip_row / C9: known rows are loaded, unknown rows skipped."""
    t = Tables(spark, sf)
    kept = I.apply_store_policy(_records(spark, sf), _snapshot_dim(t), "skip_row")
    return kept.select("report_date", "store_id", "store_name", "record_type", "sales_result",
                       "customer_count", "source_file")


@query("unknown_store_policy_day", with_ctes("""
SELECT source_file, n AS records_parsed, CASE WHEN u IS NULL THEN n ELSE 0 END AS records_loaded,
       CASE WHEN u IS NULL THEN 0 ELSE n END AS records_skipped,
       CASE WHEN u IS NULL THEN 'SUCCESS' ELSE 'SKIPPED' END AS status, 'skip_day' AS policy,
       'unknown stores: ' || u AS note
FROM (SELECT source_file, COUNT(*) AS n,
             string_agg(DISTINCT store_name, '; ' ORDER BY store_name) FILTER (WHERE store_id % 13 = 0) AS u
      FROM expected_records GROUP BY source_file)
UNION ALL
SELECT DISTINCT 'DAYREPORT ' || """ + _txt("report_date") + """ || ' empty.pdf', 0, 0, 0, 'FAILED', 'skip_day', 'no records parsed'
FROM expected_records WHERE day(report_date) = 1""", "expected_records"))
def q_unknown_store_policy_day(spark, sf):
    """J7 skip_day + J8: whole files with an unknown store are skipped; one
    outcome row per file."""
    t = Tables(spark, sf)
    files = R.report_files(t)
    return I.load_outcomes(I.flag_store_policy(_records(spark, sf), _snapshot_dim(t), "skip_day"), "skip_day", files)
