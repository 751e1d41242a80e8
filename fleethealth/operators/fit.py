"""Least-squares attribution of a change vector to known fault signatures.

A signature table holds, per phase, ``sig_pos`` (row position), ``sig_id`` and
``vec`` (array of doubles). It is a calibration table, usually of a few dozen
rows. Candidates of up to ``RESIDENT`` signatures are prepared once per task;
of more the best subset is found by branch and bound, and only their count is
taken block by block.
"""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt, dot, norm, stored_value, vector_norm

RESIDENT = 64  # signatures per phase whose candidates (43 744) stay in memory
CANDIDATES = 20_000  # of larger tables compared at once
MAX_ROWS = 100_000  # of the whole table, which goes to the driver
ERROR_STEP = 1e-9  # errors closer than this are a tie, the earlier candidate wins
CLOSE = 1e-3
ROWS = 64  # second members of a branch whose third ones are compared at once
BLOCK = 32  # observations solved at once; their errors fit the cache

# The helpers below travel with the job: executors need no installed package.
register_pickle_by_value(sys.modules[__name__])

# Result of one fit, in this order.
FIT_FIELDS = {
    "err": T.DoubleType(),
    "residual": T.DoubleType(),
    "shift": T.ArrayType(T.DoubleType()),
    "magnitude": T.ArrayType(T.DoubleType()),
    "sig_id": T.ArrayType(T.StringType()),
    "admissible": T.ArrayType(T.LongType()),
}


def signature_norms(signatures: DataFrame, columns: Sequence[str] = S.SIGNATURE_COLUMNS) -> DataFrame:
    """Keep the fitted parameters and add each signature's Euclidean norm."""
    kept = [c for c in (S.PHASE, "sig_pos", "sig_id") if c in signatures.columns]
    return signatures.select(
        *kept, *map(bt, columns), norm(columns).alias("Vector_Norm"), F.array(*map(bt, columns)).alias("vec")
    )


def collect_signatures(signatures: DataFrame) -> dict[str, list[tuple[int, str, tuple[float, ...]]]]:
    """Signatures per phase in position order, after a size check."""
    rows = signatures.select(S.PHASE, "sig_pos", "sig_id", "vec").limit(MAX_ROWS + 1).collect()
    tables: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r[S.PHASE], r["sig_pos"])):
        tables.setdefault(r[S.PHASE], []).append((r["sig_pos"], r["sig_id"], tuple(r["vec"])))
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} signatures")
    return tables


def candidate_sets(n: int, max_size: int = 3) -> list[tuple[int, ...]]:
    """All subsets of 1..max_size signatures by (size, lexicographic) order."""
    return [c for k in range(1, max_size + 1) for c in itertools.combinations(range(n), k)]


@dataclass(frozen=True)
class Solver:
    """Everything about a phase's candidates that does not depend on observations."""

    vectors: np.ndarray  # signatures x parameters
    norms: np.ndarray
    members: list[tuple[int, ...]]  # candidates in (size, lexicographic) order
    starts: list[int]  # first candidate of each size, and the end
    parents: list[np.ndarray]  # per size: the candidate without its last member
    directions: list[np.ndarray]  # per size: what the last member adds, parameters x candidates
    inverses: list[np.ndarray]  # per size: candidates x size x parameters, pseudo-inverses
    sets: list[np.ndarray] = field(default_factory=list)  # per size: members as candidates x size


def _solver(vectors: tuple[tuple[float, ...], ...], max_size: int) -> Solver:
    m = np.array(vectors, dtype=float)
    s = Solver(m, np.linalg.norm(m, axis=1), [], [0], [], [], [])
    before: dict[tuple[int, ...], int] = {(): 0}
    for k in range(1, min(max_size, len(m)) + 1):
        sets = list(itertools.combinations(range(len(m)), k))
        stacked = m[np.array(sets)].transpose(0, 2, 1)
        rcond = np.finfo(float).eps * max(m.shape[1], k)
        q, r = np.linalg.qr(stacked)
        # A signature that depends on the members before it adds no direction.
        adds = np.abs(r[:, -1, -1]) > rcond * np.linalg.norm(stacked, axis=(1, 2)) * 16
        s.directions.append((q[:, :, -1] * adds[:, None]).T.copy())
        s.parents.append(np.array([before[c[:-1]] for c in sets]))
        s.inverses.append(np.linalg.pinv(stacked, rcond=rcond))
        before = {c: i for i, c in enumerate(sets)}
        s.members.extend(sets)
        s.sets.append(np.array(sets))
        s.starts.append(len(s.members))
    return s


def _explained(obs: np.ndarray, s: Solver) -> np.ndarray:
    """Squared length of each observation's projection on every candidate's span,
    candidates x observations: what a candidate adds to its parent are whole rows."""
    out = np.empty((len(s.members), len(obs)))
    turned = obs.T.copy()
    before = np.zeros((1, len(obs)))
    for k, direction in enumerate(s.directions):
        part = out[s.starts[k]:s.starts[k + 1]]
        np.matmul(direction.T, turned, out=part)
        part *= part
        if k:
            part += before[s.parents[k]]
        before = part
    return out


def _solve(obs: np.ndarray, solver: Solver, candidate: int):
    """Coefficients, magnitudes and residual of one candidate."""
    members = list(solver.members[candidate])
    k = len(members)
    c = solver.inverses[k - 1][candidate - solver.starts[k - 1]] @ obs
    rest = obs - c @ solver.vectors[members]
    return members, c, np.abs(c) * solver.norms[members], math.sqrt(rest @ rest)


def _best(obs, explained, length, solver: Solver, err_limit: float, factor: float):
    """First candidate of least error among the admissible ones.

    The least error is tried first; only where its magnitudes are too large the
    next one is. ``explained`` is used up.
    """
    square = length * length

    def reach(err: float) -> float:  # the error is below ``err`` iff more than this is explained
        return (1.0 - err * err) * square

    while True:
        top = explained.max()
        if top <= reach(err_limit):
            return None
        err = math.sqrt(max(1.0 - top / square, 0.0))
        if err < CLOSE:
            # Near-perfect: the difference above cancels, so rank by the residuals themselves.
            close = np.flatnonzero(explained > reach(CLOSE))
            steps = [round(_solve(obs, solver, c)[3] / length / ERROR_STEP) for c in close]
            at = int(close[int(np.argmin(steps))])
        else:
            at = int(np.argmax(explained >= reach(err + ERROR_STEP)))
        members, c, mags, residual = _solve(obs, solver, at)
        if mags.sum() < factor * length:
            return residual / length, residual, c, mags, members
        explained[at] = -1.0


def _best_together(obs, explained, length, solver: Solver, err_limit: float, factor: float) -> list:
    """``_best`` of all observations of a block: a round tries the least error of each
    one that is still open. Near-perfect fits are ranked one by one. ``explained`` is used up."""
    fits: list = [None] * len(obs)
    left = np.arange(len(obs))
    while len(left):
        x = explained if len(left) == len(obs) else explained[:, left]
        square = length[left] ** 2
        top = x.max(axis=0)
        live = top > (1.0 - err_limit * err_limit) * square
        err = np.sqrt(np.maximum(1.0 - top / square, 0.0))
        at = (x >= (1.0 - (err + ERROR_STEP) ** 2) * square).argmax(axis=0)
        for i in left[live & (err < CLOSE)]:
            fits[i] = _best(obs[i], explained[:, i], float(length[i]), solver, err_limit, factor)
        plain = live & (err >= CLOSE)
        left, at = left[plain], at[plain]
        explained[at, left] = -1.0  # whoever is done is not looked at again
        size = np.searchsorted(solver.starts, at, "right")
        refused = []
        for k in np.unique(size):
            who = left[size == k]
            which = at[size == k] - solver.starts[k - 1]
            o, members = obs[who], solver.sets[k - 1][which]
            c = np.matmul(solver.inverses[k - 1][which], o[:, :, None])[:, :, 0]
            rest = o - np.matmul(c[:, None, :], solver.vectors[members])[:, 0]
            mags, residual = np.abs(c) * solver.norms[members], np.sqrt((rest * rest).sum(axis=1))
            good = mags.sum(axis=1) < factor * length[who]
            for j in np.flatnonzero(good):
                fits[who[j]] = (residual[j] / length[who[j]], residual[j], c[j], mags[j], members[j].tolist())
            refused.append(who[~good])
        left = np.sort(np.concatenate(refused)) if refused else left
    return fits


def _admissible(obs, explained, length, solver: Solver, err_limit: float, factor: float) -> list[int]:
    """Number of admissible candidates of each size."""
    near = np.flatnonzero(explained > (1.0 - err_limit**2) * length**2)
    counts = []
    for k, (a, b) in enumerate(zip(solver.starts[:-1], solver.starts[1:])):
        own = near[(near >= a) & (near < b)]
        members = np.array([solver.members[c] for c in own], dtype=int).reshape(-1, k + 1)
        counts.append(_small(obs, solver.inverses[k][own - a], solver.norms[members], factor * length))
    return counts


def _small(obs: np.ndarray, inverses: np.ndarray, norms: np.ndarray, limit: float) -> int:
    """How many candidates have magnitudes that stay below ``limit`` in total."""
    return int(((np.abs(inverses @ obs) * norms).sum(axis=1) < limit).sum()) if len(inverses) else 0


def _in_blocks(vectors: tuple[tuple[float, ...], ...], max_size: int) -> Iterator[tuple[Solver, np.ndarray]]:
    """Candidates of one size at a time, ``CANDIDATES`` together, in the usual order,
    with an orthonormal basis of each."""
    m = np.array(vectors, dtype=float)
    norms = np.linalg.norm(m, axis=1)
    for k in range(1, min(max_size, len(m)) + 1):
        sets = itertools.combinations(range(len(m)), k)
        rcond = np.finfo(float).eps * max(m.shape[1], k)
        while part := list(itertools.islice(sets, CANDIDATES)):
            stacked = m[np.array(part)].transpose(0, 2, 1)
            q, r = np.linalg.qr(stacked)
            steps = np.abs(np.diagonal(r, axis1=1, axis2=2))
            q = q * (steps > rcond * np.linalg.norm(stacked, axis=(1, 2))[:, None] * 16)[:, None, :]
            yield Solver(m, norms, part, [0] * k, [], [], [np.empty(0)] * (k - 1) + [np.linalg.pinv(stacked, rcond=rcond)]), q


def _count_large(obs: np.ndarray, vectors, max_size: int, err_limit: float, factor: float) -> list[list[int]]:
    """Admissible candidates of each size for a table whose candidates do not fit at once."""
    length = np.linalg.norm(obs, axis=1)
    counts = [[0] * min(max_size, len(vectors)) for _ in obs]
    for solver, basis in _in_blocks(vectors, max_size):
        k = len(solver.members[0])
        members = np.array(solver.members)
        explained = (np.einsum("op,cpk->ock", obs, basis) ** 2).sum(axis=2)
        for i, (o, x) in enumerate(zip(obs, explained)):
            near = np.flatnonzero(x > (1.0 - err_limit**2) * length[i]**2)
            counts[i][k - 1] += _small(o, solver.inverses[k - 1][near], solver.norms[members[near]], factor * length[i])
    return counts


class _Bounded:
    """Best admissible subset of up to three signatures by branch and bound.

    With unit signatures f, b = f . o and coefficients c, a least-squares fit
    explains sum(c b), and an admissible one has sum(|c|) below M = factor |o|. So

    * a subset explains less than M times its largest |b|, and
    * what it explains beyond one member i is less than M times the largest
      |b| of the others after i is projected out of everything.

    Subsets are visited by their member of largest |b| first; a branch whose bound
    is below what the best subset so far explains is left out, and since |b| falls,
    all later ones with it. Projections are rank-one updates of the Gram matrix, a
    whole level at a time. The result is that of comparing all subsets.
    """

    def __init__(self, vectors, max_size: int) -> None:
        self.vectors, self.max_size = np.array(vectors, dtype=float), max_size
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.unit = np.divide(self.vectors, self.norms[:, None], out=np.zeros_like(self.vectors), where=self.norms[:, None] > 0)
        self.gram = self.unit @ self.unit.T
        self.visited = 0

    def fit(self, obs: np.ndarray, err_limit: float, factor: float):
        """(err, residual, coefficients, magnitudes, members), or None."""
        length = float(np.linalg.norm(obs))
        square, most = length * length, factor * length
        found: list[tuple[float, int, tuple[int, ...]]] = []
        least_err = err_limit

        def need() -> float:
            """What a subset must explain to matter, with room for rounding."""
            err = err_limit if not found else least_err + ERROR_STEP if least_err >= CLOSE else CLOSE
            return (1.0 - err * err) * square - 1e-12 * square

        def consider(members: np.ndarray, explained: np.ndarray) -> None:
            nonlocal least_err
            order = np.argsort(-explained, kind="stable")
            for at in range(0, len(order), 256):
                part = order[at:at + 256]
                part = part[explained[part] > need()]
                if not len(part):
                    break
                sets = np.sort(members[part], axis=1)
                f = self.vectors[sets].transpose(0, 2, 1)
                c = (np.linalg.pinv(f, rcond=np.finfo(float).eps * max(f.shape[1:])) @ obs)
                err = np.linalg.norm(obs - (f @ c[:, :, None])[:, :, 0], axis=1) / length
                ok = ((np.abs(c) * self.norms[sets]).sum(axis=1) < most) & (err < err_limit)
                found.extend((float(e), len(m), tuple(m.tolist())) for e, m in zip(err[ok], sets[ok]))
                if ok.any():
                    least_err = min(least_err, float(err[ok].min()))

        b = self.unit @ obs
        n = len(b)
        consider(np.arange(n)[:, None], b * b)
        order = np.argsort(-np.abs(b), kind="stable")
        for p, i in enumerate(order[:n - 1]) if self.max_size > 1 else ():
            if most * abs(b[i]) < need():
                break
            rest = order[p + 1:]
            g = self.gram[rest, i]
            left, size = b[rest] - g * b[i], 1.0 - g * g
            live = size > 1e-13  # what depends on i adds nothing
            explained = b[i] * b[i] + np.divide(left * left, size, out=np.zeros(len(rest)), where=live)
            self.visited += len(rest)
            consider(np.stack([np.full(len(rest), i), rest], axis=1), np.where(live, explained, 0.0))
            if self.max_size < 3:
                continue
            # Of the two that are added the one of larger |left| leads.
            turn = np.argsort(-np.abs(left), kind="stable")
            rest, g, left, size, explained, live = (v[turn] for v in (rest, g, left, size, explained, live))
            for at in range(0, len(rest) - 1, ROWS):
                lead = np.arange(at, min(at + ROWS, len(rest) - 1))
                lead = lead[live[lead] & (most * np.abs(left[lead]) >= need() - b[i] * b[i])]
                if not len(lead):
                    if most * abs(left[at]) < need() - b[i] * b[i]:
                        break
                    continue
                cross = self.gram[np.ix_(rest[lead], rest[at:])] - np.outer(g[lead], g[at:])
                ratio = cross / size[lead][:, None]
                last = left[None, at:] - ratio * left[lead][:, None]
                room = size[None, at:] - ratio * cross
                total = explained[lead][:, None] + np.divide(last * last, room, out=np.zeros_like(last), where=room > 1e-13)
                total[np.arange(at, len(rest))[None, :] <= lead[:, None]] = 0.0  # led by another one
                self.visited += int((len(rest) - 1 - lead).sum())
                x, y = np.nonzero(total > need())
                consider(np.stack([np.full(len(x), i), rest[lead[x]], rest[at + y]], axis=1), total[x, y])
        if not found:
            return None
        close = [f for f in found if f[0] <= (least_err + ERROR_STEP if least_err >= CLOSE else CLOSE)]
        rank = (lambda f: f[1:]) if least_err >= CLOSE else (lambda f: (round(f[0] / ERROR_STEP), *f[1:]))
        members = list(min(close, key=rank)[2])
        f = self.vectors[members].T
        c = np.linalg.pinv(f, rcond=np.finfo(float).eps * max(f.shape)) @ obs
        residual = float(np.linalg.norm(obs - f @ c))
        return residual / length, residual, c, np.abs(c) * self.norms[members], members


def _fit_large(obs: np.ndarray, bounded: _Bounded, err_limit: float, factor: float, count: bool):
    """As ``_fit_block`` for a table whose candidates do not fit at once."""
    counts = (_count_large(obs, bounded.vectors, bounded.max_size, err_limit, factor) if count else [None] * len(obs))
    return [(*(bounded.fit(o, err_limit, factor) or (None,) * 5), c) for o, c in zip(obs, counts)]


def _fit_block(obs: np.ndarray, solver: Solver, err_limit: float, factor: float, count: bool):
    """Fits of the (non-zero) observation rows of one phase."""
    explained, length = _explained(obs, solver), np.linalg.norm(obs, axis=1)
    counts = [_admissible(o, x, n, solver, err_limit, factor) for o, x, n in zip(obs, explained.T, length)] if count else [None] * len(obs)
    fits = _best_together(obs, explained, length, solver, err_limit, factor)
    return [(*(f or (None,) * 5), c) for f, c in zip(fits, counts)]


def _fit_series(obs: pd.Series, phase: pd.Series, solvers, err_limit, factor, count) -> pd.DataFrame:
    out: list = [(None,) * 6] * len(obs)
    rows = [i for i, v in enumerate(obs) if v is not None and len(v)]
    values = [v for v in obs if v is not None and len(v)]
    if len({len(v) for v in values}) > 1:  # vectors that are not used may have any length
        used = [not pd.isna(v).any() for v in values]
        rows, values = [i for i, u in zip(rows, used) if u], [v for v, u in zip(values, used) if u]
    if not rows:
        return pd.DataFrame(out, columns=list(FIT_FIELDS))
    stacked = np.array(values, dtype=float)
    usable = ~np.isnan(stacked).any(axis=1) & stacked.any(axis=1)
    rows, phases = np.array(rows, dtype=int), phase.to_numpy()
    for p, (solve, names) in solvers.items():
        mine = np.flatnonzero(usable & (phases[rows] == p))
        for at in range(0, len(mine), BLOCK):
            block = mine[at:at + BLOCK]
            for i, (err, residual, c, mags, members, counts) in zip(
                    rows[block].tolist(), solve(stacked[block], err_limit, factor, count)):
                chosen = None if members is None else [names[k] for k in members]
                out[i] = (err, residual, c, mags, chosen, counts)
    return pd.DataFrame(out, columns=list(FIT_FIELDS))


def _solve_with(vectors: tuple[tuple[float, ...], ...], max_size: int):
    """The fit of observation rows against one phase's signatures."""
    if len(vectors) > RESIDENT and max_size <= 3:
        bounded = _Bounded(vectors, max_size)
        return lambda obs, *rules: _fit_large(obs, bounded, *rules)
    solver = _solver(vectors, max_size)
    return lambda obs, *rules: _fit_block(obs, solver, *rules)


def fit_vectors(
    df: DataFrame, signatures: DataFrame, vectors: dict[str, Column], settings: S.Settings,
    phase: str = S.PHASE, count: bool = False,
) -> DataFrame:
    """Add one fit struct per named observation vector.

    An orthonormal basis of every candidate depends only on the signatures: a
    task builds it once (about 30 ms) and then does matrix products on Arrow batches.
    """
    tables = collect_signatures(signatures)
    max_size, err_limit, factor = settings.max_signatures, settings.rel_err_limit, settings.magnitude_factor
    names = [f"{f}_{i}" for i in range(len(vectors)) for f in FIT_FIELDS]
    types = [t for _ in vectors for t in FIT_FIELDS.values()]

    @F.pandas_udf(T.StructType([T.StructField(n, t) for n, t in zip(names, types)]))
    def fit(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        solvers = {p: (_solve_with(tuple(x[2] for x in t), max_size), [x[1] for x in t]) for p, t in tables.items()}
        for ph, *observed in it:
            fits = [_fit_series(obs, ph, solvers, err_limit, factor, count) for obs in observed]
            done = pd.concat(fits, axis=1)
            done.columns = names
            yield done

    # One Python pass for all vectors of a row.
    fitted = df.withColumn("__fits", fit(bt(phase), *vectors.values()))
    return fitted.withColumns({
        name: F.struct(*[F.col(f"__fits.{f}_{i}").alias(f) for f in FIT_FIELDS])
        for i, name in enumerate(vectors)
    }).drop("__fits")


def signature_fit(
    df: DataFrame,
    signatures: DataFrame,
    settings: S.Settings = S.Settings(),
    columns: Sequence[str] = S.FITTED_MEAN,
) -> DataFrame:
    """Explain each lag's change vector by at most three signatures.

    New rows only; in batch context the fits of stored rows are cleared.
    """
    fresh = bt(S.NEW_FLAG) == 1
    present, stored = set(df.columns), stored_value(df)
    obs = {
        lag: F.array(*[bt(c) if c in present else F.lit(None).cast("double")
                       for c in (S.lag_column(m, lag) for m in columns)])
        for lag in settings.lags
    }
    complete = {lag: F.forall(v, lambda x: x.isNotNull()) & fresh for lag, v in obs.items()}
    vectors = {f"__fit{lag}": F.when(complete[lag] & (vector_norm(v) > 0), v) for lag, v in obs.items()}
    fitted = fit_vectors(df, signatures, vectors, settings)
    out = {}
    for lag, v in obs.items():
        f = F.col(f"__fit{lag}")
        values = {}
        for i in (1, 2, 3):
            item = lambda a: F.get(f[a], F.lit(i - 1))
            values[f"VAR{i}_SHIFT{lag}"] = item("shift")
            values[f"VAR{i}_MAGNITUDE{lag}"] = item("magnitude")
            values[f"VAR{i}_IDENTIFIER{lag}"] = item("sig_id")
        values[f"ERROR_REL{lag}"] = f["err"]
        values[f"ERROR_MAGNITUDE{lag}"] = f["residual"]
        values[f"OBS_MAGNITUDE{lag}"] = F.when(complete[lag], vector_norm(v))
        for n, value in values.items():
            before = stored(n) if settings.context == "history" else None
            out[n] = F.when(fresh, value).otherwise(F.lit(None) if before is None else before)
    return fitted.withColumns(out).drop(*vectors)


def admissible_counts(
    df: DataFrame, signatures: DataFrame, obs: str, settings: S.Settings = S.Settings()
) -> DataFrame:
    """Number of admissible candidates of each subset size per observation."""
    fitted = fit_vectors(df, signatures, {"__fit": bt(obs)}, settings, count=True)
    return fitted.withColumns({
        f"candidates_{k}": F.get(F.col("__fit.admissible"), F.lit(k - 1))
        for k in range(1, settings.max_signatures + 1)
    }).drop("__fit")


def signature_fit_single(
    df: DataFrame, signatures: DataFrame, obs: str, settings: S.Settings = S.Settings(), phase: str = S.PHASE
) -> DataFrame:
    """One-signature fit in closed form, c = f.o / f.f, without leaving the JVM.

    The phase's signatures ride along as one array per row (a phase -> array
    table of as many rows as there are phases is broadcast), so no row is ever
    multiplied.
    """
    if signatures.limit(MAX_ROWS + 1).count() > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} signatures")
    table = signatures.groupBy(bt(S.PHASE).alias("__phase")).agg(
        F.array_sort(F.collect_list(F.struct("sig_pos", "sig_id", "vec"))).alias("__sigs"))
    o = bt(obs)
    length = vector_norm(o)

    def score(s: Column) -> Column:
        c = F.try_divide(dot(s["vec"], o), dot(s["vec"], s["vec"]))
        residual = F.sqrt(F.aggregate(
            F.zip_with(o, s["vec"], lambda x, y: (x - c * y) * (x - c * y)), F.lit(0.0), lambda a, x: a + x))
        return F.struct(
            F.rint(residual / length / ERROR_STEP).alias("step"), s["sig_pos"].alias("sig_pos"),
            s["sig_id"].alias("sig_id"), c.alias("shift"),
            F.abs(c * vector_norm(s["vec"])).alias("magnitude"),
            (residual / length).alias("err"), residual.alias("residual"))

    allowed = lambda f: ((f["err"] < settings.rel_err_limit)
                         & (f["magnitude"] < settings.magnitude_factor * length))
    best = F.when(length > 0, F.array_min(F.filter(F.transform(F.col("__sigs"), score), allowed)))
    joined = df.join(F.broadcast(table), bt(phase) == F.col("__phase"), "left")
    return joined.withColumn("__best", best).select(
        *map(bt, df.columns), length.alias("OBS_MAGNITUDE"),
        F.col("__best.sig_id").alias("IDENTIFIER"), F.col("__best.shift").alias("SHIFT"),
        F.col("__best.magnitude").alias("MAGNITUDE"), F.col("__best.err").alias("ERROR_REL"),
        F.col("__best.residual").alias("ERROR_MAGNITUDE"))
