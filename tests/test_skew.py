"""A hot key takes the detour; results must not change, and no key is gathered."""

import random

import numpy as np
import pytest
from helpers import at
from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.operators import deltas, flags, history, phases, skew, stats, trend

ORDER = ["reportdatetime", "seq"]
KEYS = ["ESN"]


@pytest.fixture
def rows(spark):
    """One engine holds a third of all rows, half of them at the same instant."""
    rnd = random.Random(3)
    data = []
    for i in range(300):
        esn = 1 if i % 3 == 0 else rnd.randrange(2, 40)
        when = at(0) if esn == 1 and i % 2 else at(rnd.random() * 200)
        data.append((i, esn, when, rnd.choice([0, 0, 0, 0, 0, 0, 1]), rnd.choice([None] + [rnd.uniform(-1, 2)] * 9),
                     rnd.choice(["IPC ETA", "HPC ETA", None]), rnd.choice([7, 7, 7, 8]), 0 if i % 5 == 0 else 1))
    return spark.createDataFrame(
        data, "seq long, ESN long, reportdatetime timestamp_ntz, FlagSV long, x double, VAR1_IDENTIFIER50 string,"
              " SISTER_ESN long, NEW_FLAG long").withColumns({
                  "phase": F.lit("cruise"), "FlagSisChg": F.lit(0).cast("long"), "VAR2_IDENTIFIER50": F.lit(None).cast("string"),
                  "VAR3_IDENTIFIER50": F.lit(None).cast("string"), "IPC_DAMAGE_SHIFT50": F.col("x"),
                  "ACID": F.lit("A"), "ENGPOS": F.lit(1).cast("long"), "DSCID": F.lit(52).cast("long")})


KW = {"keys": KEYS, "order": ORDER}
OPERATORS = {
    "gaps": lambda d: flags.days_since_prev(d, **KW),
    "gaps_history": lambda d: flags.days_since_prev(d, context="history", **KW),
    "flags": lambda d: flags.engine_flags(flags.days_since_prev(d, **KW), 2.0, **KW),
    "mean": lambda d: trend.masked_rolling_mean(d, ["x"], window=5, **KW),
    "lags": lambda d: trend.lag_delta(d, ["x"], (1, 7, 30), **KW),
    "segments": lambda d: trend.segmented_rolling_mean(d, ["x"], window=4, **KW),
    "cumulative": lambda d: trend.stepfree_cumulative(d, ["x"], **KW),
    "robust": lambda d: trend.robust_rolling_location(d.fillna(0.0, ["x"]), ["x"], window=6, **KW),
    "stats": lambda d: stats.summary_stats(d, S.Settings(lags=(50,)), **KW),
    "newest": lambda d: history.latest_n(d, 9, KEYS, ORDER),
    "newest_clean": lambda d: history.latest_n_clean(d.unionByName(d), 9, KEYS, ORDER),
    "group_set": lambda d: phases.report_ref_set(d, KEYS, "SISTER_ESN", valid=((7, 8), (7,)), span_minutes=1e6),
    "group_seq": lambda d: phases.report_ref_seq(d, KEYS, "SISTER_ESN", ties=["seq"], triples=((7, 7, 7),),
                                                 pairs=((7, 7),), triple_minutes=1e6, pair_minutes=1e6),
}


def collected(df):
    cols = sorted(df.columns)
    number = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted([tuple(number(r[c]) for c in cols) for r in df.collect()], key=repr)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_hot_key_gives_the_same_rows(rows, spark, name):
    want = collected(OPERATORS[name](rows))
    spark.conf.set(skew.HOT_ROWS_CONF, "8")
    try:
        assert skew.heavy_keys(rows, KEYS) is not None
        assert collected(OPERATORS[name](rows)) == want
    finally:
        spark.conf.unset(skew.HOT_ROWS_CONF)


@pytest.mark.parametrize("name", ["mean", "cumulative", "group_set", "newest"])
def test_a_long_list_of_heavy_keys_is_not_broadcast(rows, hot, monkeypatch, name):
    want = collected(OPERATORS[name](rows))
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 0)
    assert collected(OPERATORS[name](rows)) == want


def test_the_heavy_limit_does_not_grow_with_the_table(spark):
    df = spark.range(200_000).selectExpr("CASE WHEN id < 120 THEN -1 ELSE id END AS ESN")
    spark.conf.set(skew.HOT_ROWS_CONF, "100")  # below a thousandth of all rows
    try:
        assert [r[0] for r in skew.heavy_keys(df, KEYS).keys.collect()] == [-1]
    finally:
        spark.conf.unset(skew.HOT_ROWS_CONF)


def test_rows_are_sorted_once_per_match_flag(rows):
    d = stats.summary_stats(rows.withColumns({f"VAR{i}_IDENTIFIER200": F.lit(None).cast("string") for i in (1, 2, 3)}),
                            S.Settings(lags=(50, 200)), bounded=True, **KW)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Sort [") <= 4 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("engines", [1, 2, 3])
def test_hot_pair_group(spark, engines):
    """A pair group with a third of all rows, valid only with two engines."""
    data = [("A", at(0), 1 + i % engines, i, float(i * i % 17)) for i in range(60)]
    data += [(f"B{i // 2}", at(1), i, i, float(i)) for i in range(120)]
    df = spark.createDataFrame(data, "ACID string, reportdatetime timestamp_ntz, ESN long, DSCID long, x double").withColumns(
        {"phase": F.lit("cruise"), "NEW_FLAG": F.when(F.col("DSCID") % 9 == 0, 0).otherwise(1).cast("long")})
    pairs = lambda: collected(deltas.sister_delta(df, ["x"], ties=["DSCID"]))
    groups = lambda: collected(deltas.pair_groups_only(df))
    want, members = pairs(), groups()
    spark.conf.set(skew.HOT_ROWS_CONF, "8")
    try:
        assert pairs() == want and groups() == members
    finally:
        spark.conf.unset(skew.HOT_ROWS_CONF)
    assert any(r[0] == "A" for r in want)  # at least the old rows pass


def test_hot_key_is_cut_into_even_chunks(rows, hot):
    one = rows.where("ESN = 1")
    parts = skew.chunked(one, KEYS, [F.col(c) for c in ORDER], 5, skew.heavy_keys(one, KEYS))
    sizes = [r["count"] for r in parts.groupBy(skew.CHUNK).count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 6 + 5


def test_null_keys_are_not_lost(spark, hot):
    df = spark.createDataFrame([(None, i) for i in range(30)] + [(1, 1)], "ESN long, seq long")
    got = skew.with_group(df, KEYS, {"n": F.count(F.lit(1))}).groupBy("ESN").agg(F.max("n").alias("n"))
    assert {r["ESN"]: r["n"] for r in got.collect()} == {None: 30, 1: 1}


def test_light_plan_has_one_exchange(rows):
    d = rows.transform(trend.masked_rolling_mean, ["x"], window=5, bounded=True, **KW).transform(
        trend.lag_delta, ["x_MAV_NO_STEPS"], (1, 7), bounded=True, **KW)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.fixture
def flights(spark):
    """One installation with a third of all rows inside one time slice, ties, and null times."""
    rnd = random.Random(5)
    data = []
    for i in range(600):
        esn = 1 if i % 3 == 0 else rnd.randrange(2, 30)
        when = None if i % 50 == 7 else at(0.2, rnd.randrange(0, 90)) if esn == 1 else at(rnd.random() * 30)
        data.append((esn, when, rnd.choice(S.PHASES), i))
    return spark.createDataFrame(data, "ESN long, reportdatetime timestamp_ntz, phase string, row_sum long").repartition(5)


ASOF = {
    "backward": lambda d: phases.phase_asof(d, keys=KEYS),
    "forward": lambda d: phases.phase_asof_forward(d, keys=KEYS, driver_suffix="takeoff"),
    "chain": lambda d: phases.phase_asof_chain(d, keys=KEYS),
    "far": lambda d: phases.phase_asof(d, lookups=(phases.Lookup("climb", "climb", 3000),), keys=KEYS),
}


@pytest.mark.parametrize("name", list(ASOF))
@pytest.mark.parametrize("limit", ["8", "60"])
def test_a_hot_slice_is_matched_in_ranges(flights, spark, name, limit):
    want = collected(ASOF[name](flights))
    spark.conf.set(skew.HOT_ROWS_CONF, limit)
    try:
        assert collected(ASOF[name](flights)) == want
    finally:
        spark.conf.unset(skew.HOT_ROWS_CONF)


def test_as_of_equals_a_plain_loop(flights, hot):
    rows = [r for r in flights.collect()]
    got = {(r["ESN"], r["row_sum_cruise"]): (r["reportdatetime_takeoff"], r["reportdatetime_climb"]) for r in ASOF["backward"](flights).collect()}
    for d in (r for r in rows if r["phase"] == "cruise"):
        near = []
        for phase, minutes in (("take-off", 55), ("climb", 30)):
            before = [r["reportdatetime"] for r in rows if r["ESN"] == d["ESN"] and r["phase"] == phase and d["reportdatetime"]
                      and r["reportdatetime"] and r["reportdatetime"] < d["reportdatetime"]]
            near.append(max(before) if before and (d["reportdatetime"] - max(before)).total_seconds() < minutes * 60 else None)
        assert got[d["ESN"], d["row_sum"]] == tuple(near)


def test_a_hot_slice_spreads_over_the_tasks(spark, hot):
    """One installation, one slice: every range holds an even part, the frame never spans two."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("1L AS ESN", "id AS us", "CASE WHEN id % 5000 = 17 THEN named_struct('us', id) END AS e")
        found = skew.nearest_events(df, KEYS, "us", {"last": F.col("e")})
        assert found.where("coalesce(last.us, -1) <> CASE WHEN us > 17 THEN floor((us - 18) / 5000) * 5000 + 17 ELSE -1 END").count() == 0
        ranged, pid, _ = skew._sorted_ranges(df, [F.col("ESN"), F.col("us")])
        sizes = [r["count"] for r in ranged.groupBy(pid.alias("p")).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 20_000 / 4 * 1.5
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sliding_values_need_no_frame():
    rnd = np.random.default_rng(4)
    for rows in (1, 2, 5, 400):
        size = rnd.integers(0, 12, 40) if rows < 400 else np.array([1000, 3, 399, 400, 401])
        size = size[size > 0]
        begin = np.cumsum(size) - size
        x = rnd.normal(size=int(size.sum()))
        start = np.maximum(np.repeat(begin, size), np.arange(len(x)) - rows + 1)
        top = stats.sliding(x, begin, rows, np.maximum, -np.inf)
        total = stats.sliding(x, begin, rows, np.add, 0.0)
        assert top.tolist() == [x[a:i + 1].max() for i, a in enumerate(start)]
        assert np.allclose(total, [x[a:i + 1].sum() for i, a in enumerate(start)], rtol=1e-12, atol=1e-12)


def test_one_pass_equals_the_windows_over_any_batches(rows, spark):
    d = rows.withColumn("HPC_DAMAGE_SHIFT50", F.col("x") * 3)
    chosen = S.Settings(lags=(50,), thresholds=(0.2, 1.0))
    by, fresh = [F.col(c) for c in ORDER], stats.new_rows_only(d)
    specs = [stats.Rolling(f"{c}_DAMAGE_SHIFT50", n, f"{c}_MAX{n}", f"{c}_MEAN{n}", {0.2: f"{c}_F{n}"}, stats.matches(c, 50))
             for c in ("IPC", "HPC") for n in (1, 3, 7)]
    want = d.withColumns({s.flag: s.match for s in specs})
    for s in specs:
        want = stats._apply(want, s, KEYS, by, fresh)
    want = collected(want.drop(*[s.flag for s in specs]))
    for size in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert collected(stats.rolling_stats(d, specs, KEYS, ORDER)) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert stats.summary_stats(d.limit(0), chosen, **KW).count() == 0
