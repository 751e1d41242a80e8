"""Keyed streaming state, the bucketed store and late rows of the chain."""

import importlib
import random
import time as clock
from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from helpers import at
from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.functions import bt
from fleethealth.operators import phases, trend
from fleethealth.plans import chain
from fleethealth.plans.store import FleetStore
from fleethealth.session import scratch_dir
from fleethealth.sources.buckets import BucketStore
from fleethealth.streaming import jobs, state, stateful

SMALL = "/root/testdata/sf0.001"
checks = importlib.import_module("fleethealth.checks.chain_queries")
V = importlib.import_module("fleethealth.checks.views")


def arrivals(spark, batches, schema):
    """One file per micro-batch, in this order."""
    path = scratch_dir(spark, "arrivals")
    for rows in batches:
        frame = rows if hasattr(rows, "schema") else spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.mode("append").parquet(path)
        clock.sleep(0.02)
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return read.parquet(path)


def run(stream, out):
    with state.state_partitions(stream.sparkSession, 2):
        query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state")
                 .trigger(availableNow=True).start())
    query.awaitTermination()
    return query.recentProgress


PAIRS = "phase string, ACID string, reportdatetime timestamp_ntz, ESN long, x double"


def test_a_half_waits_for_the_other_one(spark):
    row = lambda a, d, e: ("cruise", a, at(d), e, None if e is None else float(e))
    batches = [
        [row("A", 0, 1), row("B", 0, 3), row("C", 0, 5), row("C", 0, 6), row("D", 0, 7)],
        [row("A", 0, 2), row("D", 0, 8), row("D", 0, 9), row("E", 1, 4), row("E", 1, None), (None, "E", at(1), 5, 0.0)],
        [row("A", 0, 9), row("C", 0, 5), row("E", 1, 4), row("F", 40, 1)],  # closed, closed, one engine twice
        [row("F", 40, 2)],
        [row("B", 0, 4)],  # B's half went when the watermark passed
    ]
    out = scratch_dir(spark, "pairs")
    progress = run(stateful.paired_stream(arrivals(spark, batches, PAIRS), "10 days"), out)
    got = sorted((r["ACID"], r["ESN"], r["x"]) for r in spark.read.parquet(out).collect())
    assert got == [("A", 1, 1.0), ("A", 2, 2.0), ("C", 5, 5.0), ("C", 6, 6.0), ("F", 1, 1.0), ("F", 2, 2.0)]
    left = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(left) == 6 and left[-1] == 1  # of all pairs only F's is still remembered


REPORTS = "ESN long, phase string, reportdatetime timestamp_ntz, row_sum long"


@pytest.fixture
def shuffled():
    rnd = random.Random(11)
    rows = [(rnd.randrange(6), rnd.choice([*S.PHASES, "taxi"]), at(0, rnd.randrange(0, 3000)), rnd.choice([None, 1, 2, 3])) for _ in range(400)]
    rows += [(1, "cruise", None, 4), (None, "cruise", at(0), 4), (2, "climb", None, 1)] + rows[:10]
    rnd.shuffle(rows)
    return [rows[i::5] for i in range(5)]


def test_matches_of_shuffled_arrivals_equal_the_batch(spark, shuffled):
    out = scratch_dir(spark, "matches")
    run(stateful.phase_matches_stream(arrivals(spark, shuffled, REPORTS), keys=["ESN"], delay="10 days"), out)
    emitted = spark.read.parquet(out)
    got = stateful.latest_revisions(emitted, ["ESN", "reportdatetime_cruise", "copy"]).drop("copy")
    want = phases.phase_asof(spark.createDataFrame([r for b in shuffled for r in b], REPORTS), keys=["ESN"])
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    # Corrections, not pairs: no driver row is emitted more often than it changed.
    assert want.count() < emitted.count() < 3 * want.count()


def test_match_state_ends_with_its_slice(spark):
    batches = [[(e, p, at(d, m), 1) for e in range(4) for p, m in (("take-off", 0), ("cruise", 20))] for d in (0, 5, 10)]
    out = scratch_dir(spark, "ending")
    progress = run(stateful.phase_matches_stream(arrivals(spark, batches, REPORTS), keys=["ESN"], delay="1 hour"), out)
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert totals[-1] == 4 and spark.read.parquet(out).count() == 12


SERIES = "phase string, ESN long, reportdatetime timestamp_ntz, seq long, x double, flag long"


def engine_rows(n, engines, seed):
    rnd = random.Random(seed)
    return [("cruise", rnd.randrange(engines), at(0, rnd.randrange(0, n)), i, rnd.choice([None, rnd.uniform(-1, 1), rnd.uniform(-1, 1), 0.5]),
             int(rnd.random() < 0.05)) for i in range(n)]


KEY = ["phase", "ESN", "reportdatetime", "seq"]


def test_shuffled_arrivals_equal_the_sorted_run(spark):
    rows = engine_rows(600, 4, 3)
    random.Random(1).shuffle(rows)
    kw = {"values": ["x"], "window": 4, "flags": ["flag"], "order": ["reportdatetime", "seq"]}
    out = scratch_dir(spark, "engines")
    run(stateful.engine_history_stream(arrivals(spark, [rows[i::6] for i in range(6)], SERIES), lags=(2, 7), delay="10 days", **kw), out)
    got = stateful.latest_revisions(spark.read.parquet(out), KEY)
    frame = spark.createDataFrame(rows, SERIES)
    means = trend.masked_rolling_mean(frame, suffix="_MEAN", **kw)
    want = trend.lag_delta(means, ["x_MEAN"], (2, 7), order=kw["order"])
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_a_late_row_reopens_its_reach_and_nothing_else(spark):
    rows = [("cruise", e, at(0, m), 0, float((m * 7) % 13), 0) for e in range(3) for m in range(0, 200, 2)]
    late = [("cruise", 1, at(0, 101), 0, 50.0, 0)]
    out = scratch_dir(spark, "reach")
    progress = run(stateful.engine_history_stream(
        arrivals(spark, [rows, late, [("cruise", 2, at(2), 0, 1.0, 0)], [("cruise", 2, at(2, 1), 0, 1.0, 0)]], SERIES),
        ["x"], (5,), 3, order=["reportdatetime", "seq"], delay="1 day"), out)
    again = spark.read.parquet(out).where("ESN = 1 AND revision = 2")
    assert again.count() == 1 + 7  # itself, and window - 1 + lag rows behind it
    assert again.where("reportdatetime < timestamp_ntz'2024-03-01 01:41:00'").count() == 0
    # State written per batch follows the batch, not the fleet.
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in progress if p["numInputRows"]]
    assert updated == [3, 1, 1, 1]


def test_the_buffer_forgets_what_nothing_reaches(spark):
    days = [[("cruise", 1, at(d, m), 0, float((d * 31 + m) % 17), 0) for m in range(0, 100, 5)] for d in range(6)]
    out = scratch_dir(spark, "buffer")
    stream = stateful.engine_history_stream(arrivals(spark, days, SERIES), ["x"], (4,), 3, order=["reportdatetime", "seq"], delay="1 hour")
    progress = run(stream, out)
    size = [p["stateOperators"][0]["memoryUsedBytes"] for p in progress if p["numInputRows"]]
    assert size[-1] < 2 * size[1]
    frame = spark.createDataFrame([r for d in days for r in d], SERIES)
    want = trend.lag_delta(trend.masked_rolling_mean(frame, ["x"], (), 3, order=["reportdatetime", "seq"], suffix="_MEAN"),
                           ["x_MEAN"], (4,), order=["reportdatetime", "seq"])
    got = stateful.latest_revisions(spark.read.parquet(out), KEY)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_a_store_reads_and_writes_the_buckets_it_needs(spark):
    frame = spark.range(400).selectExpr("id % 100 AS ESN", "id AS x")
    store = BucketStore(spark, scratch_dir(spark, "store"), frame.schema, ("ESN",), 16)
    store.write(0, frame, store.touched(frame), None)
    assert store.read(0).count() == 400 and store.read(None).count() == 0
    some = frame.where("ESN IN (3, 4)").withColumn("x", F.lit(-1).cast("long"))
    touched = store.touched(some)
    part = store.read(0, touched)
    assert len(touched) <= 2 and len(part.inputFiles()) == len(touched)
    mine, others = trend.rows_of_engines(part, some)
    assert mine.count() == 8 and mine.count() + others.count() == part.count()
    store.write(1, others.unionByName(some), touched, 0)
    assert store.read(1).where("x = -1").count() == 8 and store.read(1).count() == 400 and store.read(0).where("x = -1").count() == 0
    old, new = store.manifest(0), store.manifest(1)
    assert {b for b in new if new[b] != old[b]} == set(touched)
    store.carry(2, 1)
    store.write(3, some.limit(0), touched, 2)
    assert store.read(3).count() == 400 - part.count()
    assert store.vacuum(3) >= 1 and store.read(3).count() == 400 - part.count()


def test_few_engines_are_filtered_in_the_scan(spark, monkeypatch):
    path = scratch_dir(spark, "engines")
    spark.range(20_000).selectExpr("id AS ESN", "id AS x").sortWithinPartitions("ESN").write.parquet(path)
    stored, new = spark.read.parquet(path), spark.range(7, 200_000, 9_000).selectExpr("id AS ESN").limit(2)
    mine, others = trend.rows_of_engines(stored, new)
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(ESN, [7,9007])" in plan and "Exchange" not in plan
    assert mine.count() == 2 and others.count() == 19_998
    # A longer list of checked size is broadcast; the history is not shuffled for it.
    monkeypatch.setattr(trend, "MAX_PUSHED_KEYS", 1)
    plan = trend.rows_of_engines(stored, new)[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(trend, "MAX_BROADCAST_ENGINES", 1)
    assert trend.rows_of_engines(stored, new)[0].count() == 2


def test_rows_are_reopened_as_far_as_windows_reach(spark):
    rows = [("cruise", e, at(m), 52, "A", 1, int(e == 1 and m == 10), float(m)) for e in (1, 2) for m in range(40)]
    frame = spark.createDataFrame(rows, "phase string, ESN long, reportdatetime timestamp_ntz, DSCID long, ACID string,"
                                        " ENGPOS long, NEW_FLAG long, x double")
    got = trend.reopened(frame, 6, ["x"]).where("NEW_FLAG = 1").collect()
    assert sorted((r["ESN"], r["reportdatetime"], r["x"]) for r in got) == [(1, at(10), 10.0)] + [(1, at(10 + i), None) for i in range(1, 7)]
    assert trend.reopened_behind(frame).where("NEW_FLAG = 1").count() == 30


def test_late_halves_and_shuffled_arrivals_equal_one_run(spark):
    settings = replace(checks.SETTINGS, context="history", max_signatures=1)
    sigs, fleet = checks._sigs(spark, SMALL, S.PHASES), V.fleet(spark, SMALL)
    # A third of the reports come in another micro-batch than their pair, before or after their time.
    turn = F.pmod(F.hash("ACID", S.TIME, F.when(F.minute(S.TIME) % 3 == 0, bt("ENGPOS"))), F.lit(3))
    root = scratch_dir(spark, "increments")
    stream = arrivals(spark, [fleet.where(turn == i) for i in range(3)], fleet.schema)
    query = jobs.start_incremental(stream, root, sigs, settings, delay="60 days", buckets=8)
    query.awaitTermination()
    last = query.lastProgress["batchId"]
    full = chain.run_increment(fleet, sigs, None, settings)
    columns = [c for c in S.stage_columns(settings) if c != S.NEW_FLAG]
    number = lambda v: round(v, 8) if isinstance(v, float) else v
    rows = lambda df, names: sorted([tuple(number(v) for v in r) for r in df.select(*map(bt, names)).collect()], key=repr)
    store = FleetStore(spark, root, settings, 8)
    assert rows(store.history(last), columns) == rows(full.stage, columns)
    assert rows(store.flights(last), full.merged.columns) == rows(full.merged, full.merged.columns)
    assert rows(store.summary(last), full.summary.columns) == rows(full.summary, full.summary.columns)


def test_all_new_rows_are_matched_before_retention(spark):
    settings = replace(checks.SETTINGS, context="history", max_signatures=1, n_points=5)
    sigs, fleet = checks._sigs(spark, SMALL, S.PHASES), V.fleet(spark, SMALL)
    root = scratch_dir(spark, "retention")
    query = jobs.start_incremental(arrivals(spark, [fleet], fleet.schema), root, sigs, settings, delay="60 days")
    query.awaitTermination()
    last = query.lastProgress["batchId"]
    full = chain.run_increment(fleet, sigs, None, replace(settings, n_points=650))
    store = FleetStore(spark, root, settings)
    assert store.flights(last).count() == full.merged.count() > 0
    assert store.history(last).groupBy("phase", "ESN").count().agg(F.max("count")).first()[0] <= 5


def test_an_increment_reads_and_writes_the_buckets_of_its_engines(spark):
    settings = replace(checks.SETTINGS, context="history", max_signatures=1)
    sigs, fleet = checks._sigs(spark, SMALL, S.PHASES), V.fleet(spark, SMALL)
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    one = (bt("ACID") == "AC3") & (bt(S.TIME) >= cut)
    store = FleetStore(spark, scratch_dir(spark, "fleet"), settings, 32)
    store.apply(fleet.where(~one), sigs, 0, None)
    store.apply(fleet.where(one), sigs, 1, 0)
    old, new = store._history().manifest(0), store._history().manifest(1)
    engines = fleet.where(one).select("ESN").distinct().count()
    assert 0 < len([b for b in new if new[b] != old.get(b)]) <= engines < len(new)
    full = chain.run_increment(fleet, sigs, None, settings)
    number = lambda v: round(v, 8) if isinstance(v, float) else v
    rows = lambda df, names: sorted([tuple(number(v) for v in r) for r in df.select(*map(bt, names)).collect()], key=repr)
    columns = [c for c in S.stage_columns(settings) if c != S.NEW_FLAG]
    assert rows(store.history(1), columns) == rows(full.stage, columns)
    assert rows(store.flights(1), full.merged.columns) == rows(full.merged, full.merged.columns)


BIG = 2**53 + 1


def state_rows(progress):
    return max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"])


def test_states_of_pairs_do_not_grow_with_their_number(spark):
    schema = "phase string, ACID string, reportdatetime timestamp_ntz, ESN long, n long"
    side = lambda e: spark.range(3000).selectExpr("'climb' AS phase", "concat('A', id) AS ACID", "timestamp_ntz'2024-03-01 00:00:00' AS reportdatetime",
                                                  f"id * 2 + {e} AS ESN", f"IF(id % 2 = 0, NULL, {BIG} + id) AS n")
    first, second = (spark.createDataFrame(side(e).collect(), schema) for e in (0, 1))
    out = scratch_dir(spark, "many-pairs")
    progress = run(stateful.paired_stream(arrivals(spark, [first, second, second], schema), "10 days", buckets=16), out)
    assert state_rows(progress) <= 16
    got = spark.read.parquet(out)
    assert got.columns == first.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, first.union(second).collect()))


def test_states_of_matches_do_not_grow_with_installations(spark):
    row = lambda p, m, v: spark.range(3000).selectExpr(
        "id AS ESN", f"'{p}' AS phase", f"timestamp_ntz'2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, 0, {m}) AS reportdatetime", f"id % {v} AS row_sum")
    first, late = (spark.createDataFrame(d.collect(), REPORTS) for d in (row("cruise", 20, 7), row("take-off", 5, 5)))
    out = scratch_dir(spark, "many-matches")
    progress = run(stateful.phase_matches_stream(arrivals(spark, [first, late], REPORTS), keys=["ESN"], delay="10 days", buckets=16), out)
    assert state_rows(progress) <= 16
    got = stateful.latest_revisions(spark.read.parquet(out), ["ESN", "reportdatetime_cruise", "copy"]).drop("copy")
    want = phases.phase_asof(first.union(late), keys=["ESN"])
    assert got.where("row_sum_takeoff IS NOT NULL").count() == 3000
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_states_of_buffers_do_not_grow_with_engines(spark):
    schema = SERIES + ", n long"
    rows = [(*r, None if r[3] % 2 else BIG + r[3]) for r in engine_rows(1500, 700, 5)]
    # Nulls first, in the order too.
    rows = [r if i % 5 else (*r[:3], None, *r[4:]) for i, r in enumerate(rows)]
    rows = list({r[:4]: r for r in rows}.values())
    random.Random(2).shuffle(rows)
    kw = {"values": ["x"], "window": 2, "flags": ["flag"], "order": ["reportdatetime", "seq"]}
    out = scratch_dir(spark, "many-engines")
    progress = run(stateful.engine_history_stream(
        arrivals(spark, [rows[i::3] for i in range(3)], schema), lags=(1, 3), delay="10 days", buckets=16, **kw), out)
    assert state_rows(progress) <= 16
    got = stateful.latest_revisions(spark.read.parquet(out), KEY)
    means = trend.masked_rolling_mean(spark.createDataFrame(rows, schema), suffix="_MEAN", **kw)
    want = trend.lag_delta(means, ["x_MEAN"], (1, 3), order=kw["order"])
    assert got.where("x_MEAN IS NOT NULL").count() > 300
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
