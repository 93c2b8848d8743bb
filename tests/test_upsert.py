"""J1 J5 J12 upserts and the J6 stream (idempotence, NULL-safe keys, last wins)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salesmart.operators import upsert as U


def test_upsert_last_wins_and_null_safe_keys(spark):
    tgt = spark.createDataFrame([(1, None, 10.0), (2, "a", 20.0), (3, "b", 30.0)], "k int, m string, v double")
    bat = spark.createDataFrame([(1, None, 11.0, 1), (2, "a", 21.0, 1), (2, "a", 22.0, 2), (4, "c", 40.0, 1)],
                                "k int, m string, v double, seq int")
    out = {(r.k, r.m): r.v for r in U.upsert(tgt, bat, ["k", "m"], "seq").collect()}
    assert out == {(1, None): 11.0, (2, "a"): 22.0, (3, "b"): 30.0, (4, "c"): 40.0}


def test_upsert_same_lineage(spark):
    base = spark.range(10).select(F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    tgt = base.filter("k < 6")
    bat = base.filter("k >= 4").withColumn("v", F.col("v") + 100)
    out = {r.k: r.v for r in U.upsert(tgt, bat, ["k"]).collect()}
    assert out == {0: 0.0, 1: 1.0, 2: 2.0, 3: 3.0, 4: 104.0, 5: 105.0, 6: 106.0, 7: 107.0, 8: 108.0, 9: 109.0}


def test_upsert_with_timestamps(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    tgt = spark.createDataFrame([(1, "a", t0, t0), (2, "b", t0, t0)],
                                "d int, p string, first_loaded_at timestamp, last_loaded_at timestamp")
    src = spark.createDataFrame([(2, "b2"), (3, "c")], "d int, p string")
    out = {r.d: (r.p, r.first_loaded_at, r.last_loaded_at)
           for r in U.upsert_with_timestamps(tgt, src, "d", t1).collect()}
    assert out == {1: ("a", t0, t0), 2: ("b2", t0, t1), 3: ("c", t1, t1)}


def test_merge_into_path_idempotent(spark, scratch):
    path = os.path.join(scratch, "fact")
    b1 = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 10.0), (dt.date(2024, 2, 1), 1, 20.0)],
                               "report_date date, store_id int, v double").withColumn("ym", F.date_format("report_date", "yyyyMM"))
    U.merge_into_path(spark, path, b1, ["report_date", "store_id"], ["ym"])
    b2 = spark.createDataFrame([(dt.date(2024, 2, 1), 1, 21.0)], "report_date date, store_id int, v double") \
        .withColumn("ym", F.date_format("report_date", "yyyyMM"))
    for _ in range(3):  # replaying the same batch changes nothing
        U.merge_into_path(spark, path, b2, ["report_date", "store_id"], ["ym"])
    got = sorted((r.report_date.month, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 10.0), (2, 21.0)]


def test_evolve_schema(spark):
    old = spark.createDataFrame([(1, 2.0)], "k int, a double")
    new = spark.createDataFrame([(2, "x")], "k int, b string")
    out = U.evolve_schema(old, new)
    assert out.columns == ["k", "a", "b"] and out.count() == 2


def test_stream_daily_upsert_matches_batch(spark):
    from salesmart.streaming.daily_upsert import day_totals, run_daily_upsert
    sf = "/root/testdata/sf0.001"
    target = run_daily_upsert(spark, sf, glob="events.parquet")
    got = {(r.day, r.event_type): (r.n_events, r.total_value) for r in day_totals(spark, target).collect()}
    ev = spark.read.parquet(f"{sf}/events.parquet")
    exp = {(r.day, r.event_type): (r.n, r.v) for r in ev.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("v"))
        .collect()}
    assert got == exp


def test_stream_keeps_late_events_of_a_folder_table(spark, scratch):
    """Newer half first, the older half as a later file: nothing is lost, and a re-run changes nothing."""
    from salesmart.streaming.daily_upsert import day_totals, run_daily_upsert
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    mid = ev.approxQuantile("event_id", [0.5], 0.0)[0]
    source, target, state = (f"{scratch}/{x}" for x in ("events.parquet", "target", "state"))
    ev.filter(F.col("event_id") > mid).coalesce(1).write.parquet(source)
    run_daily_upsert(spark, source, target_path=target, checkpoint_path=state)
    ev.filter(F.col("event_id") <= mid).repartition(3).write.mode("append").parquet(source)
    for _ in range(2):
        run_daily_upsert(spark, source, target_path=target, checkpoint_path=state, max_files_per_trigger=1)
        got = day_totals(spark, target)
        assert got.agg(F.sum("n_events")).first()[0] == ev.count()


def _events(spark, scratch):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    source = f"{scratch}/events"
    ev.where(half).repartition(3).write.parquet(source)
    return ev, half, source


def test_fresh_checkpoint_on_an_old_table_counts_each_file_once(spark, scratch):
    from salesmart.streaming.daily_upsert import day_totals, run_daily_upsert
    ev, half, source = _events(spark, scratch)
    for state in ("a", "b"):       # the second stream knows nothing of the first
        run_daily_upsert(spark, source, target_path=f"{scratch}/t", checkpoint_path=f"{scratch}/{state}")
    assert day_totals(spark, f"{scratch}/t").agg(F.sum("n_events")).first()[0] == ev.where(half).count()
    ev.where(~half).repartition(2).write.mode("append").parquet(source)
    for state in ("a", "c", "c"):
        run_daily_upsert(spark, source, target_path=f"{scratch}/t", checkpoint_path=f"{scratch}/{state}", max_files_per_trigger=1)
    got = {(r.day, r.event_type): (r.n_events, r.last_ts) for r in day_totals(spark, f"{scratch}/t").collect()}
    assert got == {(r.d, r.event_type): (r.n, r.l) for r in ev.groupBy(F.to_date("ts").alias("d"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("l")).collect()}


def test_compaction_keeps_totals_and_ledger_and_drops_old_folders(spark, scratch):
    from salesmart.streaming.daily_upsert import day_table, day_totals, run_daily_upsert
    ev, half, source = _events(spark, scratch)
    target = f"{scratch}/t"
    run_daily_upsert(spark, source, target_path=target, checkpoint_path=f"{scratch}/a", max_files_per_trigger=1, compact_after=2)
    table = day_table(spark, target)
    assert table.generations()[-1] == 1 and table.ledger().count() == 3
    before = sorted(map(tuple, day_totals(spark, target).collect()))
    for n in (2, 3, 4):
        assert table.compact() == n
    assert table.generations() == [3, 4] and len(os.listdir(f"{target}/gen=4/partials")) == 1
    run_daily_upsert(spark, source, target_path=target, checkpoint_path=f"{scratch}/b")
    assert sorted(map(tuple, day_totals(spark, target).collect())) == before and table.ledger().count() == 3


def test_uncommitted_runs_are_not_read(spark, scratch):
    """A load that was lost before its ledger rows, and a compaction before its mark."""
    from salesmart.streaming.daily_upsert import day_partials, day_table, day_totals
    ev, half, source = _events(spark, scratch)
    rows = spark.read.parquet(source).select("*", F.col("_metadata.file_path").alias("file"))
    table = day_table(spark, f"{scratch}/t")
    assert table.totals().count() == 0 and table.ledger().count() == 0
    table.load(rows, day_partials)
    day_partials(ev).write.parquet(f"{scratch}/t/gen=0/partials/run=lost")
    day_partials(ev).write.parquet(f"{scratch}/t/gen=1/partials/run=lost")
    assert day_totals(spark, f"{scratch}/t").agg(F.sum("n_events")).first()[0] == ev.where(half).count()
    assert table.compact() == 1
    assert day_totals(spark, f"{scratch}/t").agg(F.sum("n_events")).first()[0] == ev.where(half).count()
    table.load(rows.limit(0), day_partials)      # nothing new changes nothing
    assert day_totals(spark, f"{scratch}/t").agg(F.sum("n_events")).first()[0] == ev.where(half).count()


def test_merge_keeps_the_callers_overwrite_mode(spark, scratch):
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, p string, v double")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        U.merge_into_path(spark, f"{scratch}/m", rows, ["k"], ["p"])
        U.merge_into_path(spark, f"{scratch}/m", rows.where("k = 2").withColumn("v", F.lit(9.0)), ["k"], ["p"])
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert {(r.k, r.v) for r in spark.read.parquet(f"{scratch}/m").collect()} == {(1, 1.0), (2, 9.0)}


def test_merge_into_path_refuses_doubtful_batches(spark, scratch):
    rows = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, v double")
    with pytest.raises(ValueError):
        U.merge_into_path(spark, f"{scratch}/t", rows, ["k"], ["k"])
    open(f"{scratch}/no_table", "w").write("not a table")
    with pytest.raises(Exception, match="(?i)parquet|schema|infer"):
        U.merge_into_path(spark, f"{scratch}/no_table", rows.limit(1), ["k"], ["k"])


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_key = st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None]))


@settings(max_examples=15, deadline=None)
@given(target=st.dictionaries(_key, st.integers(0, 100), max_size=8),
       batch=st.lists(st.tuples(_key, st.integers(0, 100)), max_size=10))
def test_upsert_property(spark, target, batch):
    """J1 against a dict model: the batch row with the highest sequence wins per key."""
    tgt = spark.createDataFrame([(k[0], k[1], float(v)) for k, v in target.items()], "k int, m string, v double")
    bat = spark.createDataFrame([(k[0], k[1], float(v), i) for i, (k, v) in enumerate(batch)],
                                "k int, m string, v double, seq int")
    model = {k: float(v) for k, v in target.items()}
    for k, v in batch:
        model[k] = float(v)
    got = {(r.k, r.m): r.v for r in U.upsert(tgt, bat, ["k", "m"], "seq").collect()}
    assert got == model


def test_upsert_moves_each_side_once(spark):
    """Target and batch meet in one shuffle and one sort; repeated and null keys stay as they were."""
    old = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (None, 4.0)], "k int, v double")
    new = spark.createDataFrame([(2, 5.0, 1), (2, 6.0, 2), (None, 7.0, 1), (3, 8.0, None)], "k int, v double, seq int")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = U.upsert(old, new, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1

    def rows(df):
        return sorted(((r.k is None, r.k or 0, r.v) for r in df.collect()))
    assert rows(U.upsert(old, new, ["k"], "seq")) == [(False, 1, 1.0), (False, 1, 2.0), (False, 2, 6.0), (False, 3, 8.0), (True, 0, 7.0)]
    assert rows(U.upsert(old, new.drop("seq"), ["k"])) == [(False, 1, 1.0), (False, 1, 2.0), (False, 2, 5.0), (False, 2, 6.0),
                                                           (False, 3, 8.0), (True, 0, 7.0)]
