"""Damage shifts and their rolling statistics."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt, new_rows_only, stored_value
from fleethealth.operators.skew import heavy_keys, over_series

# The helpers below travel with the job: executors need no installed package.
register_pickle_by_value(sys.modules[__name__])


def label_of(component: str) -> str:
    return f"{component} ETA"


def damage_shift(
    df: DataFrame, lags: Sequence[int] = (50, 100, 200, 400), components: Sequence[str] = S.COMPONENTS
) -> DataFrame:
    """Negated shift of the component's efficiency signature; last match wins."""
    out = {}
    stored, fresh = stored_value(df), new_rows_only(df)
    for lag in lags:
        for comp in components:
            name = S.damage_column(comp, lag)
            before = stored(name)
            value = F.lit(None).cast("double") if before is None else before
            for i in (1, 2, 3):
                hit = bt(f"VAR{i}_IDENTIFIER{lag}") == label_of(comp)
                value = F.when(hit, -bt(f"VAR{i}_SHIFT{lag}")).otherwise(value)
            out[name] = fresh(name, value)
    return df.withColumns(out)


def matches(component: str, lag: int) -> Column:
    """The component's signature is among the row's fitted ones."""
    hit = F.lit(False)
    for i in (1, 2, 3):
        hit = hit | F.coalesce(bt(f"VAR{i}_IDENTIFIER{lag}") == label_of(component), F.lit(False))
    return hit


@dataclass(frozen=True)
class Rolling:
    """Max, mean and share above each threshold of the last ``rows`` values."""

    value: str
    rows: int
    max_name: str
    mean_name: str
    fractions: dict[float, str]
    match: Column | None = None  # window over matching rows only; others get null

    @property
    def flag(self) -> str:
        return f"__match_{self.max_name}"


def _apply(
    df: DataFrame, s: Rolling, keys: Sequence[str], by: Sequence[Column], fresh: Callable[[str, Column], Column],
) -> DataFrame:
    """The statistics of one spec as window functions, for the chunks of a heavy key.

    Shares come from running counts: the count at a row minus the count ``rows``
    rows earlier is exact. The match flag joins the partition key, so nothing is
    filtered out and joined back.
    """
    w = Window.partitionBy(*map(bt, keys), s.flag).orderBy(*by)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    x = bt(s.value)
    counts = {f"__n_{s.max_name}": F.count(F.lit(1)).over(upto), f"__x_{s.max_name}": F.count(x).over(upto)}
    counts |= {f"__t_{n}": F.count(F.when(x > F.lit(float(t)), 1)).over(upto) for t, n in s.fractions.items()}
    last = lambda name: bt(name) - F.coalesce(F.lag(bt(name), s.rows).over(w), F.lit(0))
    known = F.col(s.flag) & (last(f"__x_{s.max_name}") > 0)
    frame = w.rowsBetween(-(s.rows - 1), 0)
    found = {s.max_name: F.max(x).over(frame), s.mean_name: F.avg(x).over(frame)}
    # Null values count in the denominator of a share.
    found |= {n: last(f"__t_{n}") / last(f"__n_{s.max_name}") for n in s.fractions.values()}
    return df.withColumns(counts).withColumns({n: fresh(n, F.when(known, v)) for n, v in found.items()}).drop(*counts)


def sliding(x: np.ndarray, begin: np.ndarray, rows: int, combine: np.ufunc, nothing: float) -> np.ndarray:
    """``combine`` over the last ``rows`` values of each series, constant work per value.

    Series (each from its ``begin`` to the next) are cut into blocks of ``rows``;
    a full window is the rest of one block and the start of the next one, so it
    combines a running value from the block's end and one from a block's start.
    Sums never subtract, so nothing cancels.
    """
    size = np.diff(np.append(begin, len(x)))
    blocks = -(-size // rows)
    at = np.repeat(np.cumsum(blocks) - blocks, size) * rows + (within := np.arange(len(x)) - np.repeat(begin, size))
    grid = np.full(int(blocks.sum()) * rows, nothing)
    grid[at] = x
    grid = grid.reshape(-1, rows)
    head = combine.accumulate(grid, axis=1).ravel()[at]
    tail = combine.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    both = (within >= rows) & ((within + 1) % rows != 0)
    head[both] = combine(tail[at[both] - rows + 1], head[both])
    return head


class _Series:
    """One spec over sorted rows that come batch by batch; keeps the last matches of the open key."""

    def __init__(self, rows: int, thresholds: Sequence[float]) -> None:
        self.rows, self.thresholds = rows, thresholds
        self.kept = np.empty(0)

    def advance(self, x: np.ndarray, flag: np.ndarray, run: np.ndarray, n_runs: int, first_goes_on: bool) -> np.ndarray:
        """(max, mean, shares) per row, nan where there is no match or no value.

        ``run``: number of each row's key within the batch; ``first_goes_on``: the
        first one continues the open key.
        """
        kept = self.kept if first_goes_on else np.empty(0)
        place = np.flatnonzero(flag)
        values = np.concatenate([kept, x[place]])
        series = np.concatenate([np.zeros(len(kept), int), run[place]])
        out = np.full((2 + len(self.thresholds), len(x)), np.nan)
        if len(place):
            begin = np.flatnonzero(np.append(True, series[1:] != series[:-1]))
            at = np.arange(len(values))
            start = np.maximum(np.repeat(begin, np.diff(np.append(begin, len(values)))), at - self.rows + 1)
            some = ~np.isnan(values)
            count = lambda c: (total := np.append(0, np.cumsum(c)))[at + 1] - total[start]
            known = count(some)
            top = sliding(np.where(some, values, -np.inf), begin, self.rows, np.maximum, -np.inf)
            total = sliding(np.where(some, values, 0.0), begin, self.rows, np.add, 0.0) + 0.0  # no -0.0
            with np.errstate(invalid="ignore", divide="ignore"):
                found = [top, total / known, *(count(values > t) / (at - start + 1) for t in self.thresholds)]
            for o, f in zip(out, found):
                o[place] = np.where(known > 0, f, np.nan)[len(kept):]
        # What the next batch may reach back to, if its first key is this batch's last.
        self.kept = values[series == n_runs - 1][-(self.rows - 1):] if self.rows > 1 else np.empty(0)
        return out


def _one_pass(df: DataFrame, specs: Sequence[Rolling], keys: Sequence[str], order: Sequence[str],
              fresh: Callable[[str, Column], Column]) -> DataFrame:
    """All statistics of all specs in one pass over rows sorted by key.

    Only keys, values and match flags go to Python. The function reads the sorted
    rows of a partition in turn and keeps the last matches of the open key, at most
    the longest window of each spec; it is declared non-deterministic so that the
    sort before it stays.
    """
    names = [n for s in specs for n in (s.max_name, s.mean_name, *s.fractions.values())]
    many, windows = len(keys), [(s.rows, tuple(s.fractions)) for s in specs]

    def scan(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        series = [_Series(*w) for w in windows]
        last = None
        for batch in batches:
            key, rest = batch[:many], batch[many:]
            n = len(batch[0])
            if not n:
                yield pd.DataFrame(columns=names, dtype=float)
                continue
            turn = np.zeros(n, bool)
            for k in key:
                code = pd.factorize(k)[0]
                turn[1:] |= code[1:] != code[:-1]
            run = np.cumsum(turn)
            first = tuple(None if pd.isna(k.iloc[0]) else k.iloc[0] for k in key)
            out = [s.advance(rest[2 * i].to_numpy(dtype=float, na_value=np.nan), rest[2 * i + 1].to_numpy(dtype=bool), run, int(run[-1]) + 1, first == last)
                   for i, s in enumerate(series)]
            last = tuple(None if pd.isna(k.iloc[-1]) else k.iloc[-1] for k in key)
            yield pd.DataFrame(np.concatenate(out).T, columns=names)

    scanned = F.pandas_udf(scan, T.StructType([T.StructField(n, T.DoubleType()) for n in names])).asNondeterministic()
    ordered = df.repartition(*map(bt, keys)).sortWithinPartitions(*map(bt, keys), *map(bt, order))
    args = [*map(bt, keys), *[c for s in specs for c in (bt(s.value).cast("double"), bt(s.flag))]]
    return ordered.withColumn("__stats", scanned(*args)).withColumns(
        {n: fresh(n, F.col("__stats").getField(n)) for n in names}).drop("__stats")


def rolling_stats(
    df: DataFrame,
    specs: Sequence[Rolling],
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    bounded: bool = False,
) -> DataFrame:
    """Add the statistics of every spec.

    If no key is heavy, the rows are partitioned and sorted by key once and one
    pass gives all statistics. Otherwise the matched subsets are handled one by
    one, those of heavy keys in chunks.
    """
    by = [bt(c) for c in order]
    fresh = new_rows_only(df)
    flags = {s.flag: F.lit(True) if s.match is None else s.match for s in specs}
    tagged = df.withColumns(flags)
    if bounded or heavy_keys(df, keys) is None:
        return _one_pass(tagged, specs, keys, order, fresh).drop(*flags)
    for s in specs:
        # The chunk column, if any, takes the place of further keys.
        stats = lambda d, parts, s=s: _apply(d, s, [p for p in parts if p != s.flag], by, fresh)
        tagged = over_series(tagged, [*keys, s.flag], by, s.rows - 1, stats)
    return tagged.drop(*flags)


def summary_stats(
    df: DataFrame,
    settings: S.Settings = S.Settings(),
    components: Sequence[str] = S.COMPONENTS,
    matched: bool = True,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    bounded: bool = False,
) -> DataFrame:
    """Rolling statistics of every lag and component."""
    present = set(df.columns)
    specs = [
        Rolling(S.damage_column(comp, lag), lag, f"{comp}_MAX{lag}", f"{comp}_MEAN{lag}",
                {t: S.fraction_column(comp, t, lag) for t in settings.thresholds},
                matches(comp, lag) if matched else None)
        for lag in settings.lags for comp in components
    ]
    absent = {s.value: F.lit(None).cast("double") for s in specs if s.value not in present}
    return rolling_stats(df.withColumns(absent) if absent else df, specs, keys, order, bounded)


def exceedance_count(df: DataFrame, limit: float = 0.07, name: str = "row_sum") -> DataFrame:
    """Number of fraction columns at or above ``limit``; null counts as below."""
    hits = F.lit(0)
    for c in df.columns:
        if "FRACTION_GT" in c:
            hits = hits + F.coalesce((bt(c) >= F.lit(float(limit))).cast("int"), F.lit(0))
    return df.withColumns({name: new_rows_only(df)(name, hits.cast("long"))})
