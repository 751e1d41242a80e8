"""Row-local operators on hand-made frames."""

from datetime import datetime

import pytest
from helpers import at
from pyspark.sql import functions as F, types as T

from fleethealth import schema as S
from fleethealth.operators import clean, deltas, history, stats


def readings(n, **override):
    columns = {c: [110.0] * n for c in S.MEASURED} | {c: [100.0] * n for c in S.NOMINAL}
    return columns | override


def test_percent_delta_values_and_old_rows(frame):
    df = frame({"ESN": [1, 2], "NEW_FLAG": [1, 0], **readings(2, T25__DEGC=[105.0, 105.0], NH__PC=[61.0, 61.0],
                                                              NH__NOM_PC=[60.0, 60.0])})
    new, old = deltas.percent_delta(df).orderBy("ESN").collect()
    assert (new["PS26__DEL_PC"], new["T25__DEL_PC"], new["NH__DEL_PC"]) == (10.0, 5.0, 1.66667)
    assert all(old[c] is None for c in S.DELTA)


def test_percent_delta_zero_nominal_missing_and_empty(frame):
    zero = frame({"ESN": [1], "NEW_FLAG": [1], **readings(1, FF__NOM_LBHR=[0.0])})
    assert deltas.percent_delta(zero).first()["FF__DEL_PC"] is None
    with pytest.raises(KeyError, match="FF__LBHR"):
        deltas.percent_delta(zero.drop("FF__LBHR"))
    assert deltas.percent_delta(zero.limit(0)).columns[-10:] == list(S.DELTA)


@pytest.mark.parametrize("phase", list(S.RANGE_LIMITS))
def test_range_filter_is_inclusive(frame, phase):
    limits = S.RANGE_LIMITS[phase]
    low, high = ({c: float(v[k]) for c, v in limits.items()} for k in (0, 1))
    rows = [low, high]
    for c in limits:
        rows += [low | {c: low[c] - 0.001}, high | {c: high[c] + 0.001}]
    df = frame({"phase": [phase.upper()] * len(rows), "ESN": list(range(len(rows))),
                **{c: [r[c] for r in rows] for c in limits}})
    assert sorted(r["ESN"] for r in clean.range_filter(df).collect()) == [0, 1]


def test_range_filter_rejects_unknown_phase_and_skips_absent_columns(frame):
    df = frame({"phase": ["cruise", "cruise"], "NL__PC": [90.0, 10.0]})
    assert clean.range_filter(df).count() == 1
    with pytest.raises(Exception, match="no limits for phase"):
        clean.range_filter(frame({"phase": ["descent"], "NL__PC": [90.0]})).collect()


def test_clean_reports_drops_bad_dates_and_rounds(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", "2024-01-01 00:00:00", 1.5555555, 1.23456789),
         (2, "bad_date", "2024-01-01 00:00:00", 1.0, 0.0), (3, "2024-01-01 00:00:00", None, 1.0, 0.0)],
        "ESN long, reportdatetime string, datestored string, x double, days_since_prev double")
    row, = clean.clean_reports(df).collect()
    assert (row["ESN"], row["x"], row["days_since_prev"]) == (1, 1.55556, 1.23456789)
    assert row["reportdatetime"] == datetime(2024, 1, 1)


def test_sentinel_and_nulls(frame):
    ok = {c: [1.0] * 4 for c in S.REQUIRED_READINGS}
    ok["NL__PC"] = [1.0, -5555.0, None, 1.0]
    df = frame({"ESN": [1, 2, 3, 4], "PS160__PSI": [1.0, 1.0, 1.0, -5555.0], **ok})
    rows = {r["ESN"]: r["PS160__PSI"] for r in clean.drop_sentinel(df).collect()}
    assert rows == {1: 1.0, 4: None}


def test_enforce_schema_adds_casts_and_keeps_extras(spark):
    df = spark.createDataFrame([("7", "x", 1)], "ESN string, FlagSV string, extra int")
    out = clean.enforce_schema(df, S.struct_of(["ESN", "FlagSV", "SISTER_ESN", "PS26__DEL_PC"]))
    assert out.first().asDict() == {"ESN": 7, "FlagSV": None, "extra": 1, "SISTER_ESN": None, "PS26__DEL_PC": None}
    assert out.schema["PS26__DEL_PC"].dataType == T.DoubleType()


def test_new_flag_without_checkpoint_marks_all(frame):
    df = frame({"reportdatetime": [at(0), at(1)]})
    assert [r["NEW_FLAG"] for r in clean.new_flag(df, None).collect()] == [1, 1]
    assert sorted(r["NEW_FLAG"] for r in clean.new_flag(df, at(0)).collect()) == [0, 1]
    assert [r["NEW_FLAG"] for r in clean.new_flag(df, at(0), inclusive=True).collect()] == [1, 1]


def test_row_norm_of_nulls_is_null(frame):
    df = frame({"a": [3.0, None], "b": [-4.0, 1.0]})
    for ord, want in ((2, 5.0), (1, 7.0), (float("inf"), 4.0)):
        got = [r["norm"] for r in deltas.row_norm(df, ["a", "b"], ord=ord).collect()]
        assert sorted(got, key=str) == sorted([want, None], key=str)


def test_damage_shift_last_match_wins_and_old_rows_stay(frame):
    df = frame({
        "ESN": [1, 2, 3], "NEW_FLAG": [1, 1, 0],
        "VAR1_IDENTIFIER50": ["IPC ETA", "OTHER", "IPC ETA"], "VAR2_IDENTIFIER50": ["HPC ETA", None, None],
        "VAR3_IDENTIFIER50": ["IPC ETA", None, None], "VAR1_SHIFT50": [0.5, 1.0, 9.0],
        "VAR2_SHIFT50": [-0.3, 1.0, 9.0], "VAR3_SHIFT50": [0.25, 1.0, 9.0]})
    a, b, c = stats.damage_shift(df, [50]).orderBy("ESN").collect()
    assert (a["IPC_DAMAGE_SHIFT50"], a["HPC_DAMAGE_SHIFT50"]) == (-0.25, 0.3)
    assert (b["IPC_DAMAGE_SHIFT50"], c["IPC_DAMAGE_SHIFT50"]) == (None, None)


def test_exceedance_count_edge_and_old_rows(frame):
    df = frame({"ESN": [1, 2, 3], "NEW_FLAG": [1, 1, 0], "IPC_FRACTION_GT_0.2_50": [0.15, None, 1.0],
                "HPC_FRACTION_GT_1.0_50": [0.1, 0.2, 1.0]})
    got = {r["ESN"]: r["row_sum"] for r in stats.exceedance_count(df, 0.15).collect()}
    assert got == {1: 1, 2: 1, 3: None}


def test_append_unique_and_normalized(frame):
    base = frame({"ESN": [1, 2], "reportdatetime": [at(0), at(1)], "operator": ["A", None]})
    new = frame({"operator": ["A", None, "B"], "ESN": [1, 2, 3], "reportdatetime": [at(0), at(1), at(-5)]})
    grown = history.append_unique(base, new.unionByName(frame(
        {"operator": ["C"], "ESN": [4], "reportdatetime": [None]})))
    assert sorted(r["ESN"] for r in grown.collect()) == [1, 2, 3]
    kept = history.append_dedup_normalized(
        frame({"operator": ["  Foo"], "ACID": ["x"]}), frame({"operator": ["foo ", "bar"], "ACID": ["X", "X"]}), ["operator"])
    assert sorted(r["operator"] for r in kept.collect()) == ["  Foo", "bar"]


def test_merge_history_keeps_history_row_and_newest(frame):
    old = frame({"phase": ["cruise"] * 3, "ESN": [1] * 3, "reportdatetime": [at(0), at(1), at(2)], "x": [1.0] * 3,
                 "FlagSV": [7, 7, 7]})
    new = frame({"phase": ["cruise"] * 4, "ESN": [1] * 4, "reportdatetime": [at(2), at(3), at(3), at(4)],
                 "x": [1.0, 1.0, 1.0, None]})
    got = history.merge_history(old, new, ["phase", "ESN", "reportdatetime", "x"], 3, order=["reportdatetime"])
    rows = {r["reportdatetime"]: r["FlagSV"] for r in got.collect()}
    assert rows == {at(1): 7, at(2): 7, at(3): None}


@pytest.mark.parametrize("limit,kept", [(0, 0), (10, 1), (25, 2), (39, 3), (40, 4), (1000, 4)])
def test_retain_within_bytes(frame, limit, kept):
    df = frame({"ESN": [1, 2, 3, 4], "reportdatetime": [at(0), at(3), at(3, 0.001), at(3, 5)]})
    got = history.retain_within_bytes(df, limit, ties=["ESN"], size=F.lit(10).cast("long"))
    assert sorted(r["ESN"] for r in got.collect()) == [4, 3, 2, 1][:kept][::-1]


def test_parse_mixed_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02 03:04",), ("2024-01-02",), ("x",)], "t string")
    assert [r["t"] for r in clean.parse_mixed_timestamps(df, ["t"]).collect()] == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4), datetime(2024, 1, 2), None]


def test_a_not_a_number_cell_is_null(spark):
    from fleethealth.session import scratch_dir
    from fleethealth.sources import reports

    path = scratch_dir(spark, "nan-csv")
    spark.createDataFrame([("1", "2024-03-01 00:00:00", "NaN"), ("2", "2024-03-02 00:00:00", "1.5")],
                          "ESN string, reportdatetime string, MN1 string").write.option("header", True).csv(path)
    typed = reports.read_history(spark, path, ["ESN", "reportdatetime", "MN1"])
    loose = reports.read_csv_trimmed(spark, path, {"ESN": "long", "MN1": "double"}, ["reportdatetime"])
    for df in (typed, loose):
        assert {r["ESN"]: r["MN1"] for r in df.collect()} == {1: None, 2: 1.5}


def test_unseen_rows_come_once_and_complete(frame):
    from fleethealth.operators import history

    stored = frame({"ESN": [1, 2, 2], "NL__PC": [1.0, 2.0, 3.0], "FF__LBHR": [9.0, 9.0, 9.0]})
    new = frame({"ESN": [2, 2, 3, 3, 4, None], "NL__PC": [3.0, 4.0, 5.0, 5.0, None, 6.0]})
    got = history.unseen(stored, new, ["ESN", "NL__PC"])
    assert sorted(tuple(r) for r in got.collect()) == [(2, 4.0), (3, 5.0)]


def test_newest_counts_before_it_cuts(frame):
    from fleethealth.operators import history

    rows = frame({"ESN": [1, 1, 1, 2], "FF__LBHR": [3.0, 1.0, 2.0, 5.0]})
    cut = history.newest(rows, 2, ["ESN"], ["FF__LBHR"])
    assert sorted(tuple(r) for r in cut.collect()) == [(1, 2.0), (1, 3.0), (2, 5.0)]
    whole = history.newest(rows, 3, ["ESN"], ["FF__LBHR"])
    assert whole.count() == 4 and "Window" not in whole._jdf.queryExecution().executedPlan().toString()
