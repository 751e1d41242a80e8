"""Pairs, flags, rolling windows and statistics on hand-made frames."""

import random

import pytest
from helpers import at

from fleethealth import schema as S
from fleethealth.operators import deltas, flags, phases, stats, trend
from fleethealth.operators.phases import Lookup

ORDER = ["reportdatetime"]
KEYS = ["ESN"]


def pair_frame(frame, esns, flag=None):
    n = len(esns)
    return frame({"phase": ["cruise"] * n, "ACID": ["A"] * n, "reportdatetime": [at(0)] * n, "ESN": esns,
                  "NEW_FLAG": flag or [1] * n, **{c: [float(10 - 2 * i) for i in range(n)] for c in S.DELTA}})


def test_sister_delta_swaps_sisters(frame):
    a, b = deltas.sister_delta(pair_frame(frame, [1, 2])).orderBy("ESN").collect()
    assert (a["SISTER_ESN"], b["SISTER_ESN"]) == (2, 1)
    assert all(a[c] == 2.0 and b[c] == -2.0 for c in S.E2E)


@pytest.mark.parametrize("esns", [[1], [1, 2, 3], [1, 1]])
def test_sister_delta_needs_exactly_two_engines(frame, esns):
    df = pair_frame(frame, esns)
    assert deltas.sister_delta(df).count() == 0
    assert deltas.pair_groups_only(df).count() == 0


def test_sister_delta_old_rows_pass_and_duplicates(frame):
    df = pair_frame(frame, [1, 2, 1], [1, 1, 0])
    rows = deltas.sister_delta(df).collect()
    assert sorted((r["NEW_FLAG"], r["SISTER_ESN"]) for r in rows if r["NEW_FLAG"]) == [(1, 1), (1, 2)]
    assert [r["SISTER_ESN"] for r in rows if not r["NEW_FLAG"]] == [None]
    three = deltas.sister_delta(pair_frame(frame, [1, 1, 2])).collect()
    assert sorted((r["ESN"], r["SISTER_ESN"]) for r in three) == [(1, 1), (1, 1), (2, 1)]
    assert deltas.sister_delta(df.drop("T25__DEL_PC")).first()["T25__DEL_PC_E2E"] is None


@pytest.mark.parametrize("offsets,want", [
    ([0, 1, 2], [0.0, 1.0, 1.0]), ([0, 0.8, 1.2, 5.1], [0.0, 0.8, 0.4, 3.9])])
def test_days_since_prev(frame, offsets, want):
    n = len(offsets)
    shuffled = random.Random(1).sample(offsets, n)
    df = frame({"phase": ["cruise"] * n, "ESN": [1] * n, "ACID": ["A"] * n, "ENGPOS": [1] * n, "NEW_FLAG": [1] * n,
                "reportdatetime": [at(d) for d in shuffled]})
    got = flags.days_since_prev(df, order=ORDER).orderBy("reportdatetime").collect()
    assert [r["days_since_prev"] for r in got] == want
    assert flags.days_since_prev(df.limit(0), order=ORDER).columns[-1] == "days_since_prev"


def test_engine_flags_and_contexts(frame):
    df = frame({"phase": ["cruise"] * 5, "ESN": [1] * 5, "NEW_FLAG": [0, 1, 1, 1, 1],
                "reportdatetime": [at(d) for d in (0, 5, 50, 55, 60)], "SISTER_ESN": [7, 7, 7, 8, None],
                "days_since_prev": [0.0, 5.0, 45.0, 5.0, 5.0], "FlagSV": [9, None, None, None, None]})
    rows = flags.engine_flags(df, order=ORDER).orderBy("reportdatetime").collect()
    assert [r["FlagSV"] for r in rows] == [9, 1, 1, 0, 0]
    assert [r["FlagSisChg"] for r in rows] == [None, 0, 0, 1, 1]
    rows = flags.engine_flags(df, order=ORDER, context="history").orderBy("reportdatetime").collect()
    assert [r["FlagSV"] for r in rows] == [9, 0, 1, 0, 0]


def series(frame, n, **override):
    rnd = random.Random(5)
    return frame({"ESN": [1] * n, "reportdatetime": [at(i) for i in range(n)], "NEW_FLAG": [1] * n, "FlagSV": [0] * n,
                  "FlagSisChg": [0] * n, "x": [rnd.uniform(-5, 5) for _ in range(n)], **override})


def values(df, column):
    return [r[column] for r in df.orderBy("ESN", "reportdatetime").collect()]


def test_masked_rolling_mean_after_break(frame):
    broken = [1 if i in (15, 38) else 0 for i in range(50)]
    df = series(frame, 50, FlagSV=broken)
    x = values(df, "x")
    got = values(trend.masked_rolling_mean(df, ["x"], window=9, keys=KEYS, order=ORDER), "x_MAV_NO_STEPS")
    for i, v in enumerate(got):
        window = range(i - 8, i + 1)
        if window[0] < 0 or any(broken[k] for k in window):
            assert v is None
        else:
            assert v == pytest.approx(sum(x[k] for k in window) / 9, abs=1e-5)
    assert got[24] is not None and got[23] is None


def test_masked_rolling_mean_uses_history_as_context(frame):
    df = series(frame, 9, NEW_FLAG=[0] * 6 + [1] * 3)
    got = values(trend.masked_rolling_mean(df, ["x"], window=5, keys=KEYS, order=ORDER), "x_MAV_NO_STEPS")
    assert got[:6] == [None] * 6 and None not in got[6:]


def test_lag_delta_per_engine_and_stale_values(frame):
    df = frame({"ESN": [1, 1, 1, 2], "reportdatetime": [at(i) for i in range(4)], "NEW_FLAG": [1] * 4,
                "x": [1.0, 3.0, None, 7.0], "x_LAG_1": [9.0] * 4})
    assert values(trend.lag_delta(df.drop("x_LAG_1"), ["x"], [1], KEYS, ORDER), "x_LAG_1") == [None, 2.0, None, None]
    assert values(trend.lag_delta(df, ["x"], [1], KEYS, ORDER), "x_LAG_1") == [9.0, 2.0, 9.0, 9.0]


def test_segments_start_at_the_flagged_row(frame):
    broken = [1 if i == 4 else 0 for i in range(10)]
    df = series(frame, 10, FlagSV=broken, x=[float(i) for i in range(10)])
    got = values(trend.segmented_rolling_mean(df, ["x"], window=3, keys=KEYS, order=ORDER), "x_SEG_MEAN")
    assert got == [None, None, 1.0, 2.0, None, None, 5.0, 6.0, 7.0, 8.0]
    means = trend.since_break_mean(df, ["x"], suffix="_M", window=3, keys=KEYS, order=ORDER)
    total = trend.stepfree_cumulative(means, ["x_M"], KEYS, ORDER, "_C")
    assert values(total, "x_M_C") == [0, 0, 0, 1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0]


def test_robust_location_ignores_an_outlier(frame):
    df = series(frame, 8, x=[1.0, 1.1, 0.9, 100.0, 1.0, None, 2.0, 2.0])
    got = values(trend.robust_rolling_location(df, ["x"], window=4, keys=KEYS, order=ORDER), "x_ROBUST")
    # Third row: (0.9, 1.0) and (1.0, 1.1) are equally tight, the lower subset counts.
    assert got[:5] == [1.0, 1.0, 0.95, 1.0, 1.0]
    assert got[5:] == [None, None, None]


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4])
def test_robust_location_equals_brute_force_at_any_scale(frame, scale):
    rng = random.Random(8)
    x = [rng.gauss(0, scale) for _ in range(80)]
    got = values(trend.robust_rolling_location(series(frame, 80, x=x), ["x"], window=9, keys=KEYS, order=ORDER), "x_ROBUST")
    for i, mine in enumerate(got):
        w = sorted(x[max(0, i - 8):i + 1])
        h = max(int(len(w) * 0.75), 1)
        spread = lambda part: sum((v - sum(part) / len(part)) ** 2 for v in part)
        whole = spread(w)
        best = min((round(spread(w[a:a + h]) / whole * 1e9) if whole else 0, a) for a in range(len(w) - h + 1))[1]
        assert mine == pytest.approx(sum(w[best:best + h]) / h, abs=1e-5)


def test_rolling_stats_over_matching_rows(frame):
    df = frame({"phase": ["cruise"] * 5, "ESN": [1] * 5, "NEW_FLAG": [1] * 5, "reportdatetime": [at(i) for i in range(5)],
                "VAR1_IDENTIFIER50": ["IPC ETA"] * 3 + ["X", "IPC ETA"], "VAR2_IDENTIFIER50": [None] * 5,
                "VAR3_IDENTIFIER50": [None] * 5, "IPC_DAMAGE_SHIFT50": [0.1, 0.9, None, 5.0, 0.2]})
    d = stats.summary_stats(df, S.Settings(lags=(50,)), order=ORDER)
    assert values(d, "IPC_MAX50") == [0.1, 0.9, 0.9, None, 0.9]
    assert values(d, "IPC_MEAN50")[4] == pytest.approx(0.4)
    assert values(d, "IPC_FRACTION_GT_0.2_50") == [0.0, 0.5, pytest.approx(1 / 3), None, 0.25]
    assert values(d, "HPC_MAX50") == [None] * 5


def flights(frame, rows):
    phase, minutes, total, esn = zip(*rows)
    n = len(rows)
    return frame({"phase": list(phase), "reportdatetime": [at(0, m) for m in minutes], "row_sum": list(total),
                  "ESN": list(esn), "operator": ["OP"] * n, "ACID": ["A"] * n, "ENGPOS": [1] * n})


def test_phase_asof_tolerances(frame):
    df = flights(frame, [
        ("take-off", 0, 1, 1), ("climb", 25, 2, 1), ("cruise", 54.9, 3, 1),  # 54.9 and 29.9 minutes
        ("take-off", 600, 4, 1), ("climb", 600, 5, 1), ("cruise", 655, 6, 1),  # exactly 55: no match
        ("take-off", 0, 7, 2), ("cruise", 10, 8, 3), ("cruise", 600, 9, 4), ("take-off", 600, 9, 4)])
    rows = {(r["ESN"], r["row_sum_cruise"]): (r["row_sum_takeoff"], r["row_sum_climb"]) for r in phases.phase_asof(df).collect()}
    assert rows == {(1, 3): (1, 2), (1, 6): (None, None), (3, 8): (None, None), (4, 9): (None, None)}


def test_phase_asof_takes_only_the_nearest(frame):
    df = flights(frame, [("take-off", 0, 1, 1), ("take-off", 20, 2, 1), ("cruise", 40, 3, 1)])
    assert phases.phase_asof(df).first()["row_sum_takeoff"] == 2


def test_phase_asof_across_slices(frame):
    minutes = range(0, 60 * 24 * 3, 7)
    rows = [(("take-off", "climb", "cruise")[i % 3], m, i, 1) for i, m in enumerate(minutes)]
    got = phases.phase_asof(flights(frame, rows)).collect()
    for r in got:
        i = r["row_sum_cruise"]
        assert (r["row_sum_takeoff"], r["row_sum_climb"]) == (i - 2, i - 1)


def test_phase_asof_chain_voids_and_keeps(frame):
    df = flights(frame, [
        ("take-off", 0, 1, 1), ("climb", 10, 2, 1), ("cruise", 40, 3, 1),
        ("take-off", 5000, 4, 1), ("climb", 5010, 5, 1), ("cruise", 5100, 6, 1),  # span above an hour
        ("take-off", 9000, 7, 1), ("climb", 20000, 8, 1)])  # no cruise after it
    rows = {r["row_sum_takeoff"]: (r["row_sum_climb"], r["row_sum_cruise"]) for r in phases.phase_asof_chain(df).collect()}
    assert rows == {1: (2, 3), 4: (None, None), 7: (8, None)}


def test_alerts_and_summary(frame):
    n = 4
    merged = frame({"ESN": [1, 1, 1, 2], "operator": ["OP"] * n, "ACID": ["A"] * n, "ENGPOS": [1] * n,
                    "reportdatetime_takeoff": [at(0), at(2), at(1), None], "row_sum_takeoff": [10, 20, 9, 30],
                    "row_sum_climb": [20, 30, 20, 30], "row_sum_cruise": [30, 25, 30, None]},
                   reportdatetime_takeoff=S.T.TimestampNTZType(), row_sum_takeoff=S.T.LongType(),
                   row_sum_climb=S.T.LongType(), row_sum_cruise=S.T.LongType())
    alerts = phases.alert_flag(merged, 10)
    got = {(r["ESN"], r["row_sum_takeoff"]): (r["DN_FIRE"], r["merge_sum"]) for r in alerts.collect()}
    assert got == {(1, 10): ("YES", 60), (1, 20): ("YES", 75), (1, 9): ("NO", None), (2, 30): ("NO", None)}
    one, two = phases.alert_summary(alerts).orderBy("ESN").collect()
    assert (one["DN_FIRED"], one["DN_FIRES"]) == ("YES", 2)
    assert (one["First DN fire"], one["Last DN fire"]) == ("2024-03-01 00:00:00", "2024-03-03 00:00:00")
    assert (two["DN_FIRED"], two["DN_FIRES"], two["First DN fire"]) == ("NO", 0, None)
    assert phases.alert_flag(merged, 999).where("DN_FIRE = 'YES'").count() == 0


def test_forward_lookup(frame):
    df = flights(frame, [("take-off", 0, 1, 1), ("climb", 10, 2, 1), ("climb", 20, 3, 1), ("cruise", 60, 4, 1)])
    row = phases.phase_asof_forward(df).first()
    assert (row["row_sum_takeoff"], row["row_sum_climb"], row["row_sum_cruise"]) == (1, 2, None)
    near = phases.phase_asof_forward(df, [Lookup("cruise", "cruise", 61)]).first()
    assert near["row_sum_cruise"] == 4


def test_time_arithmetic_ignores_the_session_zone(spark, frame):
    """Across a daylight-saving change of the session's zone, gaps keep the wall clock."""
    df = frame({"phase": ["cruise"] * 3, "ESN": [1] * 3, "ACID": ["A"] * 3, "ENGPOS": [1] * 3, "NEW_FLAG": [1] * 3,
                "reportdatetime": [at(d) for d in (29, 30, 31)]})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert values(flags.days_since_prev(df, order=ORDER), "days_since_prev") == [0.0, 1.0, 1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_robust_frames_stay_one_array(spark):
    """No object per frame reaches the workers: the values come as Arrow data."""
    from pyspark.util import PythonEvalType
    frames = spark.createDataFrame([([3.0, 1.0, 2.0, 50.0],), ([5.0],), (None,), ([],)], "x array<double>")
    located = frames.select(trend._mcd(0.75)("x").alias("m"))
    assert trend._mcd(0.75).evalType == PythonEvalType.SQL_SCALAR_ARROW_UDF
    assert [r["m"] for r in located.collect()] == [2.0, 5.0, None, None]
