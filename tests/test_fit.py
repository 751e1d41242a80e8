"""Signature fits against one least-squares solve per candidate."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.operators import fit

LAG = 50
COLUMNS = [S.lag_column(c, LAG) for c in S.FITTED_MEAN]


def signatures(spark, vectors, phase="cruise"):
    rows = [(phase, i, f"S{i}", *map(float, v)) for i, v in enumerate(vectors)]
    return fit.signature_norms(spark.createDataFrame(
        rows, "phase string, sig_pos long, sig_id string, " + ", ".join(f"{c} double" for c in S.SIGNATURE_COLUMNS)))


def observations(spark, vectors):
    rows = [("cruise", i, 1, *[None if x is None else float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(
        rows, "phase string, ESN long, NEW_FLAG long, " + ", ".join(f"{c} double" for c in COLUMNS))


def brute_force(obs, vectors, err_limit, factor):
    best, best_err = None, np.inf
    norms = np.linalg.norm(vectors, axis=1)
    size = np.linalg.norm(obs)
    for members in fit.candidate_sets(len(vectors)):
        f = vectors[list(members)].T
        c = np.linalg.lstsq(f, obs, rcond=None)[0]
        err = np.linalg.norm(obs - f @ c) / size
        if err < err_limit and np.abs(c * norms[list(members)]).sum() < factor * size and err < best_err:
            best, best_err = (members, c), err
    return best


@pytest.mark.parametrize("err_limit,factor", [(0.3, 5.0), (0.6, 1.3)])
def test_matches_brute_force(spark, err_limit, factor):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(10, 9))
    obs = rng.normal(size=(30, 9)) * 0.4 + rng.normal(size=(30, 3)) @ vectors[:3]
    settings = S.Settings(lags=(LAG,), rel_err_limit=err_limit, magnitude_factor=factor)
    got = fit.signature_fit(observations(spark, obs), signatures(spark, vectors), settings).orderBy("ESN").collect()
    found = 0
    for o, row in zip(obs, got):
        want = brute_force(o, vectors, err_limit, factor)
        ids = [row[f"VAR{i}_IDENTIFIER{LAG}"] for i in (1, 2, 3)]
        shifts = [row[f"VAR{i}_SHIFT{LAG}"] for i in (1, 2, 3)]
        if want is None:
            assert ids == [None] * 3 and row[f"ERROR_REL{LAG}"] is None
            continue
        found += 1
        members, c = want
        assert [i for i in ids if i] == [f"S{m}" for m in members]
        assert [s for s in shifts if s is not None] == pytest.approx(list(c), abs=1e-9)
    assert 0 < found


def test_null_zero_and_perfect_vectors(spark):
    vectors = np.eye(9)[:4] * 2
    obs = [[None] + [1.0] * 8, [0.0] * 9, list(vectors[2])]
    rows = fit.signature_fit(observations(spark, obs), signatures(spark, vectors), S.Settings(lags=(LAG,))).orderBy("ESN").collect()
    assert [r[f"OBS_MAGNITUDE{LAG}"] for r in rows] == [None, 0.0, 2.0]
    assert [r[f"VAR1_IDENTIFIER{LAG}"] for r in rows] == [None, None, "S2"]
    assert rows[2][f"VAR2_IDENTIFIER{LAG}"] is None and rows[2][f"VAR1_SHIFT{LAG}"] == pytest.approx(1.0)


def test_dependent_signatures(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(3, 9))
    vectors = np.vstack([v, v[0] * 3])  # the fourth repeats the first
    obs = rng.normal(size=(10, 9)) * 0.1 + v[0] - v[1]
    rows = fit.signature_fit(observations(spark, obs), signatures(spark, vectors), S.Settings(lags=(LAG,))).orderBy("ESN").collect()
    for o, row in zip(obs, rows):
        members, _ = brute_force(o, vectors, 0.3, 5.0)
        assert row[f"ERROR_MAGNITUDE{LAG}"] == pytest.approx(
            np.linalg.norm(o - vectors[list(members)].T @ np.linalg.lstsq(vectors[list(members)].T, o, rcond=None)[0]))


def test_missing_columns_and_contexts(spark):
    sigs = signatures(spark, np.eye(9)[:2])
    df = observations(spark, [[1.0] + [0.0] * 8]).withColumn("NEW_FLAG", F.lit(0).cast("long")).withColumn(
        f"VAR1_IDENTIFIER{LAG}", F.lit("kept"))
    cleared = fit.signature_fit(df, sigs, S.Settings(lags=(LAG,))).first()
    kept = fit.signature_fit(df, sigs, S.Settings(lags=(LAG,), context="history")).first()
    assert cleared[f"VAR1_IDENTIFIER{LAG}"] is None and kept[f"VAR1_IDENTIFIER{LAG}"] == "kept"
    short = fit.signature_fit(df.drop(COLUMNS[0]), sigs, S.Settings(lags=(LAG,))).first()
    assert short[f"OBS_MAGNITUDE{LAG}"] is None


def test_single_signature_equals_restricted_fit(spark):
    rng = np.random.default_rng(4)
    vectors, obs = rng.normal(size=(6, 9)), rng.normal(size=(40, 9))
    settings = S.Settings(lags=(LAG,), max_signatures=1, rel_err_limit=0.9)
    full = fit.signature_fit(observations(spark, obs), signatures(spark, vectors), settings).orderBy("ESN").collect()
    one = fit.signature_fit_single(
        observations(spark, obs).withColumn("obs", F.array(*COLUMNS)), signatures(spark, vectors), "obs", settings)
    rows = one.orderBy("ESN").collect()
    assert [r["IDENTIFIER"] for r in rows] == [r[f"VAR1_IDENTIFIER{LAG}"] for r in full]
    assert any(r["IDENTIFIER"] for r in rows)


def test_norms_and_size_check(spark, monkeypatch):
    sigs = signatures(spark, [[3.0, 4.0] + [0.0] * 7])
    assert sigs.first()["Vector_Norm"] == 5.0
    monkeypatch.setattr(fit, "MAX_ROWS", 4)
    with pytest.raises(ValueError, match="signatures"):
        fit.collect_signatures(signatures(spark, np.ones((5, 9))))
    assert len(fit.candidate_sets(32)) == 5488


def test_a_large_table_is_fitted_in_blocks(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(100, 9))
    obs = rng.normal(size=(12, 9)) * 0.2 + vectors[:12] * 2 - vectors[50:62]
    settings = S.Settings(lags=(LAG,), max_signatures=2)
    rows = fit.signature_fit(observations(spark, obs), signatures(spark, vectors), settings).orderBy("ESN").collect()
    best = fit._solver(tuple(map(tuple, vectors)), 2)
    want = [f and [f"S{m}" for m in f[4]] for f in fit._fit_block(obs, best, 0.3, 5.0, False)]
    assert [[r[f"VAR{i}_IDENTIFIER{LAG}"] for i in (1, 2)] for r in rows] == [w + [None] * (2 - len(w)) for w in want]
    counted = fit.admissible_counts(
        observations(spark, obs).withColumn("obs", F.array(*COLUMNS)), signatures(spark, vectors), "obs", settings)
    plain = [fit._fit_block(o[None], best, 0.3, 5.0, True)[0][5] for o in obs]
    assert [[r["candidates_1"], r["candidates_2"]] for r in counted.orderBy("ESN").collect()] == plain


@pytest.mark.parametrize("err_limit,factor", [(0.3, 5.0), (0.6, 2.0), (0.9, 1.05)])
@pytest.mark.parametrize("max_size", [1, 2, 3])
def test_branch_and_bound_equals_all_subsets(err_limit, factor, max_size):
    rng = np.random.default_rng(12)
    for n in (3, 9, 40):
        vectors = rng.normal(size=(n, 9)) * rng.uniform(0.1, 10, (n, 1))
        obs = np.vstack([rng.normal(size=(15, 9)), rng.normal(size=(8, 3)) @ vectors[:3] + rng.normal(size=(8, 9)) * 0.1,
                         vectors[:2] * 3, vectors[:1] - vectors[2:3]])
        table = tuple(map(tuple, vectors))
        want = fit._fit_block(obs, fit._solver(table, max_size), err_limit, factor, True)
        got = fit._fit_large(obs, fit._Bounded(table, max_size), err_limit, factor, True)
        assert [(f[4], f[5]) for f in want] == [(f[4], f[5]) for f in got]
        assert all(w[0] is None or (w[0] == pytest.approx(g[0], abs=1e-9) and w[2] == pytest.approx(g[2], abs=1e-6)) for w, g in zip(want, got))


def test_five_hundred_signatures_are_searched_in_part():
    """Equal to comparing all 20 833 250 subsets, on samples. How many are left out
    depends on how large magnitudes may be: a third at 5 times the observation, nearly all at 1.5."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(500, 9))
    table = fit._Bounded(tuple(map(tuple, vectors)), 3)
    picks = [rng.choice(500, 3, replace=False) for _ in range(3)]
    obs = np.array([rng.uniform(1, 2, 3) @ vectors[p] + rng.normal(size=9) * 0.02 for p in picks])
    got = [table.fit(o, 0.3, 5.0) for o in obs]
    assert table.visited / len(obs) < 0.75 * 20_833_250
    strict = fit._Bounded(tuple(map(tuple, vectors)), 3)
    strict.fit(obs[0], 0.3, 1.5)
    assert strict.visited < 0.1 * 20_833_250
    # Gram-Schmidt over all triples, one first member at a time.
    for o, f in zip(obs, got):
        best = 0.0
        for i in range(498):
            q = vectors[i] / np.linalg.norm(vectors[i])
            rest = vectors[i + 1:] - np.outer(vectors[i + 1:] @ q, q)
            r = o - (o @ q) * q
            for j in range(len(rest) - 1):
                p = rest[j] / np.linalg.norm(rest[j])
                last = rest[j + 1:] - np.outer(rest[j + 1:] @ p, p)
                gain = (last @ (r - (r @ p) * p)) ** 2 / (last ** 2).sum(axis=1)
                best = max(best, (o @ q) ** 2 + (r @ p) ** 2 + gain.max())
        assert f[1] ** 2 == pytest.approx(o @ o - best, abs=1e-9 * (o @ o))


def test_repeated_signatures_in_a_large_table():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(12, 9))
    table = tuple(map(tuple, np.vstack([vectors, vectors[:4], np.zeros((1, 9))])))
    obs = rng.normal(size=(10, 2)) @ vectors[:2]
    want = fit._fit_block(obs, fit._solver(table, 3), 0.3, 5.0, False)
    got = fit._fit_large(obs, fit._Bounded(table, 3), 0.3, 5.0, False)
    assert [f[4] for f in want] == [f[4] for f in got]


@pytest.mark.parametrize("factor", [1.05, 1.5, 5.0])
def test_a_block_gives_what_each_observation_gives_alone(factor):
    """Also where the least error is refused, ties, or is next to nothing."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(12, 9))
    vectors[5] = vectors[2]
    obs = np.concatenate([rng.normal(size=(70, 9)), vectors[[2, 7]] * 1.5, (vectors[1] - 0.5 * vectors[3])[None]])
    solver = fit._solver(tuple(map(tuple, vectors)), 3)
    got = fit._fit_block(obs, solver, 0.6, factor, False)
    refused = 0
    for o, g in zip(obs, got):
        explained, length = fit._explained(o[None], solver)[:, 0], float(np.linalg.norm(o))
        free = fit._best(o, explained.copy(), length, solver, 0.6, 1e9)
        want = fit._best(o, explained, length, solver, 0.6, factor)
        refused += free is not None and (want is None or want[4] != free[4])
        assert (g[4] is None) == (want is None)
        if want is not None:
            assert g[4] == want[4]
            assert np.allclose(g[0], want[0], atol=1e-12) and np.allclose(g[2], want[2]) and np.allclose(g[3], want[3])
    assert refused > 0 or factor == 5.0


def test_unusable_vectors_have_no_fit():
    import pandas as pd

    vectors = tuple(map(tuple, np.eye(3)))
    solvers = {"cruise": (fit._solve_with(vectors, 2), ["A", "B", "C"])}
    obs = pd.Series([None, np.array([1.0, np.nan, 0.0]), np.zeros(3), np.array([0.0, 2.0, 0.0]), np.array([np.nan]), np.array([3.0, 0.0, 0.0])])
    phase = pd.Series(["cruise"] * 5 + ["climb"])
    got = fit._fit_series(obs, phase, solvers, 0.3, 5.0, False)
    assert [list(s) if s is not None else None for s in got["sig_id"]] == [None, None, None, ["B"], None, None]
    assert len(fit._fit_series(obs[:1], phase[:1], solvers, 0.3, 5.0, False)) == 1
