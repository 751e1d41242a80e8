"""The full chain: increments, contexts, plan shape, stored outputs."""

import importlib
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.functions import STORED, bt
from fleethealth.operators import clean
from fleethealth.plans import batch, chain
from fleethealth.session import scratch_dir
from fleethealth.sources import reports, state

SMALL = "/root/testdata/sf0.001"
checks = importlib.import_module("fleethealth.checks.chain_queries")
V = importlib.import_module("fleethealth.checks.views")


@pytest.fixture(scope="module")
def setup(spark):
    settings = replace(checks.SETTINGS, context="history", max_signatures=2)
    return V.fleet(spark, SMALL), checks._sigs(spark, SMALL, S.PHASES), settings


def stored(spark, df, name):
    path = state.write_stage(df, scratch_dir(spark, name))
    return reports.read_stage(spark, path)


def comparable(df, columns):
    number = lambda v: round(v, 8) if isinstance(v, float) else v
    return sorted([tuple(number(v) for v in r) for r in df.select(*map(bt, columns)).collect()], key=repr)


def test_increments_equal_one_run(spark, setup):
    fleet, sigs, settings = setup
    columns = [c for c in S.stage_columns(settings) if c != S.NEW_FLAG]
    full = stored(spark, chain.run_increment(fleet, sigs, None, settings).stage, "full")
    cut = datetime(2024, 1, 17)
    early = fleet.where(bt(S.TIME) < F.lit(cut).cast("timestamp_ntz"))
    first = chain.run_increment(early, sigs, None, settings)
    history = stored(spark, first.stage, "first")
    mark = first.checkpoint.first()["checkpoint"]
    # The second read starts at the checkpoint, inclusively, so it overlaps the first.
    late = reports.since_checkpoint(fleet, mark, cut)
    second = stored(spark, chain.run_increment(late, sigs, history, settings, mark).stage, "second")
    assert full.count() > 500
    assert comparable(second, columns) == comparable(full, columns)


def test_batch_context_flags_the_first_row_of_each_batch(spark, setup):
    fleet, sigs, settings = setup
    settings = replace(settings, context="batch")
    mark = datetime(2024, 1, 17)
    ts = F.lit(mark).cast("timestamp_ntz")
    history = stored(spark, chain.run_increment(fleet.where(bt(S.TIME) <= ts), sigs, None, settings).stage, "old")
    new = chain.run_increment(fleet.where(bt(S.TIME) > ts), sigs, history, settings, mark).stage
    visits = new.where("NEW_FLAG = 1").groupBy("phase", "ESN").agg(F.min_by("FlagSV", S.TIME).alias("first"))
    assert {r["first"] for r in visits.collect()} == {1}
    assert new.where("NEW_FLAG = 0 AND VAR1_IDENTIFIER2 IS NOT NULL").count() == 0


def test_stage_schema_is_fixed(spark, setup):
    fleet, sigs, settings = setup
    stage = chain.run_increment(fleet, sigs, None, settings).stage
    assert stage.columns == S.stage_columns(settings)
    assert len(S.stage_columns(S.Settings())) == 221  # 220 columns and the phase
    assert [f.dataType for f in stage.schema] == [S.column_type(c) for c in stage.columns]


def test_snapshots_change_nothing(spark, setup):
    fleet, sigs, settings = setup
    root = scratch_dir(spark, "snapshots")
    plain = chain.run_increment(fleet, sigs, None, settings).summary
    tapped = chain.run_increment(fleet, sigs, None, settings, snapshots=root).summary
    assert comparable(tapped, tapped.columns) == comparable(plain, plain.columns)
    assert reports.read_stage(spark, f"{root}/fit").where("OBS_MAGNITUDE2 IS NOT NULL").count() > 0


def test_a_snapshot_goes_when_the_next_one_is_there(spark, setup):
    fleet, sigs, settings = setup
    root = scratch_dir(spark, "snapshots-left")
    chain.run_increment(fleet, sigs, None, settings, snapshots=root)
    left = [s.getPath().getName() for s in _listed(spark, root)]
    assert left == ["fit"]


def _listed(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)



def test_newest_points_bound_the_history(spark, setup):
    fleet, sigs, settings = setup
    short, full = (chain.run_increment(fleet, sigs, None, replace(settings, n_points=n)) for n in (5, 650))
    assert short.stage.groupBy("phase", "ESN").count().agg(F.max("count")).first()[0] <= 5
    # What is kept for later is bounded, what is scored now is not.
    assert comparable(short.summary, full.summary.columns) == comparable(full.summary, full.summary.columns)
    assert short.merged.count() == full.merged.count() > short.stage.where("phase = 'cruise'").count()


def test_a_heavy_engine_gives_the_same_rows(spark, setup, hot):
    fleet, sigs, settings = setup
    settings = replace(settings, max_signatures=1)
    some = fleet.where("ESN <= 4")
    heavy = chain.run_increment(some, sigs, None, settings)
    plain = chain.run_increment(some, sigs, None, settings, check_skew=False)
    assert comparable(heavy.stage, heavy.stage.columns) == comparable(plain.stage, plain.stage.columns)


def test_batch_runs_write_their_outputs(spark, setup):
    fleet, sigs, settings = setup
    settings = replace(settings, max_signatures=1)
    root = scratch_dir(spark, "out")
    for end in (datetime(2024, 1, 17), None):
        rows = fleet if end is None else fleet.where(bt(S.TIME) < F.lit(end).cast("timestamp_ntz"))
        batch.run_batch(spark, rows, sigs, root, settings)
    last = batch.last_run(spark, root)
    assert last["run"] == 2
    store = batch.store_of(spark, root, settings)
    once = chain.run_increment(fleet, sigs, None, settings)
    columns = [c for c in S.stage_columns(settings) if c != S.NEW_FLAG]
    assert comparable(store.history(2), columns) == comparable(once.stage, columns)
    assert comparable(store.flights(2), once.merged.columns) == comparable(once.merged, once.merged.columns)
    summary = spark.read.parquet(f"{last['folder']}/summary")
    assert comparable(summary, summary.columns) == comparable(once.summary.withColumnsRenamed(batch.SUMMARY_NAMES), summary.columns)
    assert last["checkpoint"] == once.checkpoint.first()["checkpoint"]


def test_batch_context_keeps_other_engines(spark, setup):
    """The re-run behaviour: only rows past the checkpoint are new, gaps do not see stored ones."""
    fleet, sigs, settings = setup
    settings = replace(settings, max_signatures=1, context="batch")
    root = scratch_dir(spark, "rerun")
    mark = F.lit(datetime(2024, 1, 17)).cast("timestamp_ntz")
    batch.run_batch(spark, fleet.where(bt(S.TIME) < mark), sigs, root, settings)
    batch.run_batch(spark, fleet.where((bt(S.TIME) < mark) | bt("ACID").isin("AC1", "AC2")), sigs, root, settings)
    store = batch.store_of(spark, root, settings)
    before, after = (store.history(v).groupBy("ACID").count().collect() for v in (1, 2))
    grown = {r["ACID"] for r in after} - {r["ACID"] for r in before if dict((a["ACID"], a["count"]) for a in after)[r["ACID"]] == r["count"]}
    assert grown and grown <= {"AC1", "AC2"}


def test_stored_columns_travel_packed(spark, setup):
    """New rows have none, stored rows have theirs in one struct; equal reports come once."""
    fleet, _, settings = setup
    own = [S.PHASE, *S.REPORT_COLUMNS, S.NEW_FLAG]
    first = chain.ingest(fleet, None, settings, None, by_origin=True)
    assert sorted(first.columns) == sorted(own)
    known = clean.enforce_schema(first, S.stage_schema(settings)).where("ESN <= 4").withColumn("days_since_prev", F.lit(7.0))
    path = scratch_dir(spark, "known")
    known.write.parquet(path)
    both = chain.ingest(fleet.unionByName(fleet.limit(50)), spark.read.parquet(path), settings, None, by_origin=True)
    assert sorted(both.columns) == sorted([*own, STORED])
    count = lambda d: {r[0]: (r["rows"], r["kept"]) for r in d.groupBy(S.NEW_FLAG).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(f"{STORED}.days_since_prev") == 7.0).alias("kept")).collect()}
    n, old = first.count(), known.count()
    assert 0 < old < n
    assert count(both) == {0: (old, old), 1: (n - old, 0)}


def test_an_increment_writes_no_stage_but_the_fit(spark, setup, monkeypatch):
    fleet, sigs, settings = setup
    kept, store = [], batch.store_of(spark, scratch_dir(spark, "one-snapshot"), replace(settings, max_signatures=1))
    before = type(store)._written
    monkeypatch.setattr(type(store), "_written", lambda self, d, path: kept.append(path.rsplit("/", 1)[-1]) or before(self, d, path))
    store.apply(fleet.where("ESN <= 8"), sigs, 1, None)
    assert kept == ["stage", "flights"]


def test_checkpoint_round_trip(spark):
    path = scratch_dir(spark, "mark")
    assert state.read_checkpoint(spark, path) is None
    state.write_checkpoint(spark, path, datetime(2024, 1, 2, 3))
    assert state.read_checkpoint(spark, path) == datetime(2024, 1, 2, 3)


def test_engine_windows_share_their_exchange(spark, setup):
    fleet, sigs, settings = setup
    stage = chain.run_increment(fleet, sigs, None, settings).stage
    plan = stage._jdf.queryExecution().executedPlan().toString()
    # dedup, pairs, flags + means + lags, statistics, newest n. The planner knows no
    # partitioning behind a Python function, so the last two no longer share one.
    assert plan.count("Exchange hashpartitioning") == 5
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_range_filter_reaches_the_scan(spark):
    from fleethealth.operators import clean

    stored_fleet = state.tap(V.fleet(spark, SMALL), scratch_dir(spark, "fleet"))
    plan = clean.range_filter(stored_fleet).select("ESN")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(NL__PC,60.0)" in pushed and "LessThanOrEqual(NL__PC,120.0)" in pushed
    assert "PS160__PSI" not in plan  # columns outside the filter and the result are not read


def test_the_fleet_view_is_written_by_all_tasks(spark):
    fleet = V.fleet_rows(spark, SMALL)
    assert V.table(spark, SMALL, "events").rdd.getNumPartitions() == 1
    assert fleet.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert fleet.count() == 2 * V.table(spark, SMALL, "events").count()
