"""Operational queries: sources/sinks, views, run reporting, set checks,
imputation, time-series splits and chart data (A3 A6 A7 A13 A14 D6 D24 G3
J11 F7 K1 K15 K24 H25)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.functions.calendar import month_spine
from salesmart.operators import features as FE
from salesmart.operators import forecast as FC
from salesmart.operators import ingest as I
from salesmart.operators import marts as M
from salesmart.operators import ops as OP
from salesmart.plans.oracle_base import with_ctes
from salesmart.plans.q_features import FEAT_LOCAL
from salesmart.plans.q_ingest import _records, _snapshot_dim
from salesmart.plans.q_marts import DATASET_LOCAL, DATASET_NEEDS, MONTH_END_RECONCILE_SQL, group_dataset_df
from salesmart.plans.registry import query
from salesmart.session import checkpoint_dir
from salesmart.sources import bindings as B
from salesmart.sources import reports as R
from salesmart.sources.tables import Tables

G = "canonical_group"
# the latest gift threshold, for the normalised floor feature
LATEST_THRESHOLD = 970


def _scratch(spark, what):
    return f"{checkpoint_dir(spark).rstrip('/')}/salesmart-{what}/{uuid.uuid4().hex}"


@query("dry_run_counts", with_ctes("""
SELECT record_type, COUNT(*) AS n_records, COUNT(DISTINCT source_file) AS n_files
FROM expected_records GROUP BY 1""", "expected_records"))
def q_dry_run_counts(spark, sf):
    """Parse and validate every report, count by record type, write nothing."""
    return OP.dry_run_counts(_records(spark, sf))


@query("run_totals", with_ctes("""
SELECT status, COUNT(*) AS n_files, CAST(SUM(records_loaded) AS BIGINT) AS records_loaded FROM (
  SELECT source_file,
         CASE WHEN COUNT(*) FILTER (WHERE store_id % 13 = 0) > 0 THEN 0 ELSE COUNT(*) END AS records_loaded,
         CASE WHEN COUNT(*) FILTER (WHERE store_id % 13 = 0) > 0 THEN 'SKIPPED' ELSE 'SUCCESS' END AS status
  FROM expected_records GROUP BY source_file) GROUP BY status""", "expected_records"))
def q_run_totals(spark, sf):
    """Files and rows by outcome under the skip_day policy."""
    t = Tables(spark, sf)
    out = I.load_outcomes(I.flag_store_policy(_records(spark, sf), _snapshot_dim(t), "skip_day"), "skip_day")
    return OP.run_totals(out)


@query("single_file_check", with_ctes("""
SELECT f.path, f.report_date, r.status, COALESCE(r.chosen_path = f.path, FALSE) AS is_rule_choice
FROM file_candidates f JOIN resolved r ON r.report_date = f.report_date""", "file_candidates", "resolved"))
def q_single_file_check(spark, sf):
    """For every candidate file, is it the one the rules choose for its date?"""
    t = Tables(spark, sf)
    res = I.resolve_files(R.file_candidates(t), R.override_rules(t))
    return (R.file_candidates(t).join(res, "report_date")
            .select("path", "report_date", "status",
                    F.coalesce(F.col("chosen_path") == F.col("path"), F.lit(False)).alias("is_rule_choice")))


@query("rules_json_resolution", with_ctes("SELECT * FROM resolved", "resolved"))
def q_rules_json_resolution(spark, sf):
    """A3: the override rules written as a JSON document and read back with an
    explicit schema drive the same resolution."""
    t = Tables(spark, sf)
    path = _scratch(spark, "rules")
    OP.write_override_rules(R.override_rules(t), path)
    rules = OP.read_override_rules(spark, path)
    return I.resolve_files(R.file_candidates(t), rules)


@query("store_listing", with_ctes("""
SELECT store_id, store_code, store_name, store_short_name, store_type, area, display_order, is_active
FROM dim_store""", "dim_store"))
def q_store_listing(spark, sf):
    """The store dimension (must be non-empty), in display order."""
    dim = OP.require_non_empty(B.dim_store(Tables(spark, sf)), "dim_store")
    return dim.orderBy("display_order")


@query("views_reconcile", MONTH_END_RECONCILE_SQL)
def q_views_reconcile(spark, sf):
    """Marts published as temporary views and read back through SQL."""
    t = Tables(spark, sf)
    fact = B.fact_sales(t, stores_mtd=False, grand_daily_rows=False, with_customers=False)
    OP.register_views(spark, {"vw_month_end_reconcile": M.month_end_reconcile(fact, B.dim_store(t))})
    return spark.sql("SELECT * FROM vw_month_end_reconcile")


@query("group_set_check", with_ctes(f"""
(SELECT g.{G}, s.report_year, s.report_month, 'missing' AS side
 FROM (VALUES ('GIFT_LOW'), ('GIFT_HIGH'), ('GIFT_LARGE'), ('GIFT_COMBINED')) g({G}), month_spine s
 EXCEPT ALL SELECT {G}, report_year, report_month, 'missing' FROM ds)
UNION ALL
(SELECT {G}, report_year, report_month, 'unexpected' FROM ds
 EXCEPT ALL SELECT g.{G}, s.report_year, s.report_month, 'unexpected'
 FROM (VALUES ('GIFT_LOW'), ('GIFT_HIGH'), ('GIFT_LARGE'), ('GIFT_COMBINED')) g({G}), month_spine s)""",
    *DATASET_NEEDS, "month_spine", local=DATASET_LOCAL))
def q_group_set_check(spark, sf):
    """The dataset holds exactly the 4 groups x every month of the
    calendar spine (exceptAll both ways; rows = gaps or extras)."""
    t = Tables(spark, sf)
    groups = F.array(*[F.lit(g) for g in ("GIFT_LOW", "GIFT_HIGH", "GIFT_LARGE", "GIFT_COMBINED")])
    expected = month_spine(t.orders, "o_orderdate").select(F.explode(groups).alias(G), "report_year", "report_month")
    return OP.set_difference_report(group_dataset_df(spark, sf), expected, [G, "report_year", "report_month"])


IMPUTE_COLS = ["sales_lag_12m", "sales_rolling_3m_mean"]


@query("impute_median", with_ctes(f"""
SELECT f.{G}, f.report_year, f.report_month,
       {", ".join(f"ROUND(COALESCE(f.{c}, m.med_{c}, 0), 4) AS {c}" for c in IMPUTE_COLS)}
FROM features f LEFT JOIN (SELECT {G}, {", ".join(f"median({c}) AS med_{c}" for c in IMPUTE_COLS)}
                           FROM features WHERE report_year < (SELECT max(report_year) FROM features) GROUP BY 1) m ON m.{G} = f.{G}""",
    *DATASET_NEEDS, local=FEAT_LOCAL))
def q_impute_median(spark, sf):
    """K1 (v1 style, leak-safe): missing features -> the group median over the
    training years (all before the newest) -> 0."""
    feat = FE.build_features(group_dataset_df(spark, sf))
    med = feat.filter(F.col("report_year") < FC.fold_specs(feat)[-1][1]).groupBy(G).agg(
        *[F.median(c).alias(f"med_{c}") for c in IMPUTE_COLS])
    j = feat.join(med, G, "left")
    return j.select(G, "report_year", "report_month",
                    *[F.round(F.coalesce(F.col(c), F.col(f"med_{c}"), F.lit(0.0)), 4).alias(c) for c in IMPUTE_COLS])


@query("time_series_split", with_ctes(f"""
SELECT {G}, split, role, COUNT(*) AS n_rows, MIN(report_year * 100 + report_month) AS first_month,
       MAX(report_year * 100 + report_month) AS last_month
FROM (SELECT d.*, s.split,
             CASE WHEN rn < n - (3 - s.split + 1) * (n // 4) THEN 'train' ELSE 'test' END AS role
      FROM (SELECT {G}, report_year, report_month,
                   row_number() OVER (PARTITION BY {G} ORDER BY report_year, report_month) - 1 AS rn,
                   COUNT(*) OVER (PARTITION BY {G}) AS n FROM ds) d,
           (VALUES (1), (2), (3)) s(split)
      WHERE rn < n - (3 - s.split + 1) * (n // 4) + n // 4)
GROUP BY 1, 2, 3""", *DATASET_NEEDS, local=DATASET_LOCAL))
def q_time_series_split(spark, sf):
    """Expanding time-series split with 3 splits (test size n // 4) per
    series, as fold membership counts."""
    ds = group_dataset_df(spark, sf)
    w = Window.partitionBy(G).orderBy("report_year", "report_month")
    d = ds.select(G, "report_year", "report_month", (F.row_number().over(w) - 1).alias("rn"),
                  F.count(F.lit(1)).over(Window.partitionBy(G)).alias("n"))
    ts = (F.col("n") / 4).cast("bigint")
    splits = F.array(*[F.lit(i) for i in (1, 2, 3)])
    e = d.select("*", F.explode(splits).alias("split"))
    start = F.col("n") - (3 - F.col("split") + 1) * ts
    e = e.filter(F.col("rn") < start + ts).withColumn("role", F.when(F.col("rn") < start, "train").otherwise("test"))
    return e.groupBy(G, "split", "role").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.col("report_year") * 100 + F.col("report_month")).alias("first_month"),
        F.max(F.col("report_year") * 100 + F.col("report_month")).alias("last_month"))


@query("chart_series", with_ctes(f"""
SELECT {G}, report_year, report_month, 'actual' AS series, ROUND(CAST(sales_result AS DOUBLE), 4) AS value FROM features
UNION ALL SELECT {G}, report_year, report_month, 'lag_12m', ROUND(sales_lag_12m, 4) FROM features
UNION ALL SELECT {G}, report_year, report_month, 'rolling_3m', ROUND(sales_rolling_3m_mean, 4) FROM features""",
    *DATASET_NEEDS, local=FEAT_LOCAL))
def q_chart_series(spark, sf):
    """Tidy (series, month, kind, value) frame behind the trend charts."""
    f = FE.build_features(group_dataset_df(spark, sf))
    kinds = {"actual": F.col("sales_result").cast("double"), "lag_12m": F.col("sales_lag_12m"),
             "rolling_3m": F.col("sales_rolling_3m_mean")}
    arr = F.array(*[F.struct(F.lit(k).alias("series"), F.round(v, 4).alias("value")) for k, v in kinds.items()])
    return f.select(G, "report_year", "report_month", F.explode(arr).alias("x")).select(
        G, "report_year", "report_month", "x.series", "x.value")


@query("structural_features", with_ctes(f"""
SELECT {G}, report_year, report_month, threshold_floor, threshold_ceiling,
       ROUND(threshold_floor / {LATEST_THRESHOLD}, 6) AS price_floor_normalized, year_in_regime
FROM features""", *DATASET_NEEDS, local=FEAT_LOCAL))
def q_structural_features(spark, sf):
    """Thresholds, the floor normalised by the latest threshold, regime year."""
    f = FE.build_features(group_dataset_df(spark, sf))
    return f.select(G, "report_year", "report_month", "threshold_floor", "threshold_ceiling",
                    F.round(F.col("threshold_floor") / LATEST_THRESHOLD, 6).alias("price_floor_normalized"),
                    "year_in_regime")
