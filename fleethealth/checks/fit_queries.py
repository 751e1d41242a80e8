"""Signature fits. The SQL solves the normal equations of every candidate."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.registry import check, r5
from fleethealth.functions import bt, r5 as round5
from fleethealth.operators import fit

DIM = range(1, 10)
STEP = "1e-9::DOUBLE"


def _dot(a: str, b: str) -> str:
    return " + ".join(f"{a}{i} * {b}{i}" for i in DIM)


def fit_sql(
    obs: str, max_size: int = 3, err_limit: float = 0.3, factor: float = 5.0, prefix: str = "", count: int = V.SIGNATURE_COUNT
) -> str:
    """CTEs ``fits`` (best candidate per obs row ``oid``) and ``counts``.

    ``obs`` names a relation (oid, o1..o9). Candidates carry the inverse of
    their Gram matrix; coefficients follow from the projections on the
    signatures. ``ord`` is the (size, lexicographic) position of a candidate. A
    relative error below 1e-6 is cancellation noise of a perfect fit, i.e. 0.
    """
    g = f"""{prefix}sig AS ({V.signatures_sql(count)}),
{prefix}gram AS (SELECT a.sig_pos AS i, b.sig_pos AS j, {_dot('a.v', 'b.v')} AS d FROM {prefix}sig a, {prefix}sig b),
{prefix}c1 AS (SELECT 1 AS size, i, -1 AS j, -1 AS k, 1 / d AS a11, 0.0::DOUBLE AS a12, 0.0::DOUBLE AS a13,
0.0::DOUBLE AS a22, 0.0::DOUBLE AS a23, 0.0::DOUBLE AS a33, sqrt(d) AS n1, 0.0::DOUBLE AS n2, 0.0::DOUBLE AS n3
FROM {prefix}gram WHERE i = j)"""
    parts = [f"SELECT * FROM {prefix}c1"]
    if max_size > 1:
        g += f""",
{prefix}c2 AS (SELECT 2, x.i, x.j, -1, q.d / t, -x.d / t, 0.0, p.d / t, 0.0, 0.0, sqrt(p.d), sqrt(q.d), 0.0 FROM
(SELECT *, 0 AS z FROM {prefix}gram WHERE i < j) x JOIN {prefix}gram p ON p.i = x.i AND p.j = x.i
JOIN {prefix}gram q ON q.i = x.j AND q.j = x.j, LATERAL (SELECT p.d * q.d - x.d * x.d AS t) l)"""
        parts.append(f"SELECT * FROM {prefix}c2")
    if max_size > 2:
        g += f""",
{prefix}c3 AS (SELECT 3, i, j, k, (b * c - yz * yz) / t, (xz * yz - xy * c) / t, (xy * yz - xz * b) / t,
(a * c - xz * xz) / t, (xy * xz - a * yz) / t, (a * b - xy * xy) / t, sqrt(a), sqrt(b), sqrt(c)
FROM (SELECT *, a * (b * c - yz * yz) - xy * (xy * c - yz * xz) + xz * (xy * yz - b * xz) AS t FROM
(SELECT ij.i, ij.j, jk.j AS k, ii.d AS a, jj.d AS b, kk.d AS c, ij.d AS xy, jk.d AS yz, ik.d AS xz
FROM {prefix}gram ij JOIN {prefix}gram jk ON ij.j = jk.i AND ij.i < ij.j AND jk.i < jk.j
JOIN {prefix}gram ik ON ik.i = ij.i AND ik.j = jk.j JOIN {prefix}gram ii ON ii.i = ij.i AND ii.j = ij.i
JOIN {prefix}gram jj ON jj.i = ij.j AND jj.j = ij.j JOIN {prefix}gram kk ON kk.i = jk.j AND kk.j = jk.j) m) n)"""
        parts.append(f"SELECT * FROM {prefix}c3")
    return g + f""",
{prefix}cand AS (SELECT *, ((size * 1024 + i) * 1024 + j) * 1024 + k AS ord FROM ({' UNION ALL '.join(parts)}) u),
{prefix}proj AS (SELECT oid, any_value(oo) AS oo, list(g ORDER BY sig_pos) AS g FROM (SELECT o.oid, s.sig_pos,
{_dot('o.o', 's.v')} AS g, {_dot('o.o', 'o.o')} AS oo FROM {obs} o, {prefix}sig s) x WHERE oo > 0 GROUP BY oid),
{prefix}coef AS (SELECT oid, oo, size, i, j, k, ord, n1, n2, n3, gi, gj, gk,
a11 * gi + a12 * gj + a13 * gk AS x1, a12 * gi + a22 * gj + a23 * gk AS x2, a13 * gi + a23 * gj + a33 * gk AS x3
FROM (SELECT oid, oo, c.*, g[c.i + 1] AS gi, CASE WHEN size > 1 THEN g[c.j + 1] ELSE 0 END AS gj,
CASE WHEN size > 2 THEN g[c.k + 1] ELSE 0 END AS gk FROM {prefix}proj, {prefix}cand c) y),
{prefix}err0 AS (SELECT *, sqrt(greatest(oo - x1 * gi - x2 * gj - x3 * gk, 0)) / sqrt(oo) AS e0 FROM {prefix}coef),
{prefix}err AS (SELECT *, CASE WHEN e0 < 1e-6 THEN 0 ELSE e0 END AS err FROM {prefix}err0),
{prefix}okay AS (SELECT * FROM {prefix}err WHERE err < {err_limit}
AND abs(x1) * n1 + abs(x2) * n2 + abs(x3) * n3 < {factor} * sqrt(oo)),
{prefix}fits AS (SELECT oid, arg_min(struct_pack(size := size, i := i, j := j, k := k, x1 := x1, x2 := x2, x3 := x3,
n1 := n1, n2 := n2, n3 := n3, err := err, oo := oo), struct_pack(e := round_even(err / {STEP}, 0), o := ord)) AS f
FROM {prefix}okay GROUP BY oid)"""


OBS = "obs AS (SELECT vec_id AS oid, " + ", ".join(
    f"{V.FOLD_SQL[i - 1]} AS o{i}" for i in DIM) + " FROM embeddings)"
NORM = f"sqrt({_dot('o.o', 'o.o')})"


def label(i: str) -> str:
    return ("CASE WHEN {0} % 4 = 0 THEN 'IPC ETA' WHEN {0} % 4 = 1 THEN 'HPC ETA'"
            " ELSE 'SIG ' || CAST({0} AS VARCHAR) END").format(i)


def _fit_columns(n: int, f: str = "f", o: str = "o") -> str:
    cols = []
    for i, p in ((1, "i"), (2, "j"), (3, "k")):
        has = f"{f}.size >= {i}"
        cols += [f"CASE WHEN {has} THEN {r5(f'{f}.x{i}')} END AS \"VAR{i}_SHIFT{n}\"",
                 f"CASE WHEN {has} THEN {r5(f'abs({f}.x{i} * {f}.n{i})')} END AS \"VAR{i}_MAGNITUDE{n}\"",
                 f"CASE WHEN {has} THEN {label(f'{f}.' + p)} END AS \"VAR{i}_IDENTIFIER{n}\""]
    length = f"sqrt({_dot(f'{o}.o', f'{o}.o')})"
    return ", ".join(cols) + (f", {r5(f'{f}.err')} AS \"ERROR_REL{n}\", {r5(f'{f}.err * sqrt({f}.oo)')} AS \"ERROR_MAGNITUDE{n}\","
                              f" {r5(length)} AS \"OBS_MAGNITUDE{n}\"")


# The change vector of the k-th lag: the folded vector turned by k places.
LAGS = S.Settings().lags


def _new_vectors(spark, sf_dir, lags=LAGS):
    v = V.vectors(spark, sf_dir)
    return v.select("vec_id", "phase", F.lit(1).cast("long").alias(S.NEW_FLAG), *[
        F.element_at("obs", (i + k) % len(DIM) + 1).alias(S.lag_column(c, n))
        for k, n in enumerate(lags) for i, c in enumerate(S.FITTED_MEAN)])


def _turned(k: int, n: int) -> str:
    columns = ", ".join(f"{V.FOLD_SQL[(i - 1 + k) % len(DIM)]} AS o{i}" for i in DIM)
    return f"obs{n} AS (SELECT vec_id AS oid, {columns} FROM embeddings)"


def _sigs(spark, sf_dir, phases=S.PHASES, count=V.SIGNATURE_COUNT):
    return fit.signature_norms(V.signatures(spark, sf_dir, phases, count))


def _rounded_fits(d, lags):
    return d.select("vec_id", *[
        bt(c) if "IDENTIFIER" in c else round5(bt(c)).alias(c) for n in lags for c in S.fit_columns(n)])


@check("signature_fit", "WITH " + ", ".join(f"{_turned(k, n)}, {fit_sql(f'obs{n}', prefix=f'p{n}_')}" for k, n in enumerate(LAGS))
       + " SELECT o.oid AS vec_id, " + ", ".join(_fit_columns(n, f"x{n}.f", f"obs{n}") for n in LAGS) + f" FROM obs{LAGS[0]} o "
       + " ".join(f"JOIN obs{n} ON obs{n}.oid = o.oid LEFT JOIN p{n}_fits x{n} ON x{n}.oid = o.oid" for n in LAGS))
def signature_fit(spark, sf_dir):
    settings = S.Settings(lags=LAGS)
    return _rounded_fits(fit.signature_fit(_new_vectors(spark, sf_dir), _sigs(spark, sf_dir), settings), LAGS)


@check("signature_fit_many", f"WITH {OBS}, {fit_sql('obs', count=72)} SELECT o.oid AS vec_id, {_fit_columns(50)}"
                             " FROM obs o LEFT JOIN fits ON fits.oid = o.oid")
def signature_fit_many(spark, sf_dir):
    """A table of 72 signatures: 62 268 subsets, searched by branch and bound."""
    settings = S.Settings(lags=(50,))
    return _rounded_fits(fit.signature_fit(_new_vectors(spark, sf_dir, (50,)), _sigs(spark, sf_dir, count=72), settings), (50,))


@check("signature_fit_single", f"WITH {OBS}, {fit_sql('obs', 1, 0.7)} SELECT o.oid AS vec_id, {r5(NORM)} AS \"OBS_MAGNITUDE\","
       f" {label('f.i')} AS \"IDENTIFIER\", {r5('f.x1')} AS \"SHIFT\", {r5('abs(f.x1 * f.n1)')} AS \"MAGNITUDE\","
       f" {r5('f.err')} AS \"ERROR_REL\", {r5('f.err * sqrt(f.oo)')} AS \"ERROR_MAGNITUDE\""
       " FROM obs o LEFT JOIN fits ON fits.oid = o.oid")
def signature_fit_single(spark, sf_dir):
    d = fit.signature_fit_single(
        V.vectors(spark, sf_dir), _sigs(spark, sf_dir), "obs", S.Settings(rel_err_limit=0.7))
    numbers = ["OBS_MAGNITUDE", "SHIFT", "MAGNITUDE", "ERROR_REL", "ERROR_MAGNITUDE"]
    return d.select("vec_id", "IDENTIFIER", *[round5(bt(c)).alias(c) for c in numbers])


@check("signature_candidates", f"""WITH {OBS}, {fit_sql('obs')},
n AS (SELECT oid, size, count(*) AS n FROM okay GROUP BY oid, size)
SELECT o.oid AS vec_id, {", ".join(f"CAST(coalesce((SELECT n FROM n WHERE n.oid = o.oid AND size = {k}), 0) AS BIGINT) AS candidates_{k}" for k in (1, 2, 3))}
FROM obs o""")
def signature_candidates(spark, sf_dir):
    d = fit.admissible_counts(V.vectors(spark, sf_dir), _sigs(spark, sf_dir), "obs")
    return d.select("vec_id", *[f"candidates_{k}" for k in (1, 2, 3)])
