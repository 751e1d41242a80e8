"""Break-aware rolling means and long-lag trends over row-count windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth import schema as S
from fleethealth.functions import STORED, bt, new_rows_only, r5, stored_value
from fleethealth.operators.skew import over_series, running_sum, with_group

FLAGS = ("FlagSV", "FlagSisChg")
MAX_PUSHED_KEYS = 1_000
MAX_BROADCAST_ENGINES = 1_000_000


def _order(order: Sequence[str]) -> list[Column]:
    return [bt(c) for c in order]


def _window(parts: Sequence[str], by: Sequence[Column]):
    return Window.partitionBy(*map(bt, parts)).orderBy(*by)


def engines_with_new_data(df: DataFrame, keys: Sequence[str] = S.ENGINE) -> DataFrame:
    """All rows of engines that have at least one new row."""
    newest = with_group(df, keys, {"__new": F.max(bt(S.NEW_FLAG))})
    return newest.where(F.col("__new") == 1).drop("__new")


def distinct_new_engines(df: DataFrame, keys: Sequence[str] = S.ENGINE) -> DataFrame:
    return df.where(bt(S.NEW_FLAG) == 1).select(*map(bt, keys)).distinct()


def rows_of_engines(stored: DataFrame, new: DataFrame, keys: Sequence[str] = ("ESN",)) -> tuple[DataFrame, DataFrame]:
    """(rows of ``stored`` whose key has a row in ``new``, the others).

    A short list of keys becomes a filter that reaches the scan, where file and
    row-group statistics apply; a longer one of checked size is broadcast, so
    ``stored`` is not shuffled; only beyond that both sides are.
    """
    engines = new.select(*[bt(k).cast(stored.schema[k].dataType).alias(f"__n_{k}") for k in keys]).distinct()
    few = engines.limit(MAX_PUSHED_KEYS + 1).collect() if len(keys) == 1 else []
    if len(keys) == 1 and len(few) <= MAX_PUSHED_KEYS:
        known = [r[0] for r in few if r[0] is not None]
        mine = F.coalesce(bt(keys[0]).isin(known), F.lit(False)) if known else F.lit(False)
        return stored.where(bt(keys[0]).isin(known) if known else mine), stored.where(~mine)
    small = engines.limit(MAX_BROADCAST_ENGINES + 1).count() <= MAX_BROADCAST_ENGINES
    side = F.broadcast(engines) if small else engines
    same = reduce(lambda a, b: a & b, [bt(k) == bt(f"__n_{k}") for k in keys])
    return stored.join(side, same, "left_semi"), stored.join(side, same, "left_anti")


def reopened(
    df: DataFrame, reach: int, derived: Sequence[str], keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER, bounded: bool = False,
) -> DataFrame:
    """Stored rows up to ``reach`` rows behind a new one count as new again and
    lose their ``derived`` values (and all that are packed), since a late row changes
    their windows. Rows that follow no new row within reach stay as they are."""
    by = _order(order)

    def mark(d: DataFrame, parts: list[str]) -> DataFrame:
        return d.withColumn("__open", F.max(bt(S.NEW_FLAG)).over(_window(parts, by).rowsBetween(-reach, 0)))

    opened = over_series(df, keys, by, reach, mark, bounded)
    again = (F.col("__open") == 1) & (bt(S.NEW_FLAG) == 0)
    present = set(df.columns)
    cleared = {c: F.when(~again, bt(c)) for c in [*derived, STORED] if c in present}
    return opened.withColumns({S.NEW_FLAG: F.col("__open"), **cleared}).drop("__open")


def reopened_behind(
    df: DataFrame, keys: Sequence[str] = S.ENGINE, order: Sequence[str] = S.ENGINE_ORDER, bounded: bool = False
) -> DataFrame:
    """All rows behind an engine's first new one count as new: windows over
    matching rows only have no bound in rows."""
    seen = running_sum(df, keys, _order(order), {"__seen": bt(S.NEW_FLAG)}, bounded)
    return seen.withColumn(S.NEW_FLAG, (F.col("__seen") > 0).cast("long")).drop("__seen")


def masked_rolling_mean(
    df: DataFrame,
    values: Sequence[str] = S.E2E,
    flags: Sequence[str] = FLAGS,
    window: int = 21,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    suffix: str = "_MAV_NO_STEPS",
    bounded: bool = False,
) -> DataFrame:
    """Mean of the last ``window`` rows, null if any of them is flagged or null."""
    by = _order(order)
    clean = F.lit(True)
    for f in flags:
        clean = clean & (bt(f) == 0)
    fresh = new_rows_only(df)

    def means(d: DataFrame, parts: list[str]) -> DataFrame:
        w = _window(parts, by).rowsBetween(-(window - 1), 0)
        out = {}
        for c in values:
            masked = F.when(clean, bt(c))
            mean = F.when(F.count(masked).over(w) == window, r5(F.avg(masked).over(w)))
            out[c + suffix] = fresh(c + suffix, mean)
        return d.withColumns(out)

    return over_series(df, keys, by, window - 1, means, bounded)


def lag_delta(
    df: DataFrame,
    values: Sequence[str] = S.MEAN,
    lags: Sequence[int] = (50, 100, 200, 400),
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    bounded: bool = False,
) -> DataFrame:
    """Change over ``lag`` rows; a stored value stays where it cannot be derived."""
    by = _order(order)
    stored = stored_value(df)

    def deltas(d: DataFrame, parts: list[str]) -> DataFrame:
        w = _window(parts, by)
        out = {}
        for lag in lags:
            for c in values:
                name = S.lag_column(c, lag)
                change = r5(bt(c) - F.lag(bt(c), lag).over(w))
                before = stored(name)
                out[name] = change if before is None else F.coalesce(change, before)
        return d.withColumns(out)

    return over_series(df, keys, by, max(lags), deltas, bounded)


def segmented_rolling_mean(
    df: DataFrame,
    values: Sequence[str] = S.E2E,
    flags: Sequence[str] = FLAGS,
    window: int = 21,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    suffix: str = "_SEG_MEAN",
    extra: dict[str, Column] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Full-window mean inside segments that start at (and include) a flagged row.

    A window lies in one segment iff none of its rows but the first is flagged,
    so no segment number, and no unbounded window, is needed.
    """
    by = _order(order)
    broken = F.lit(False)
    for f in flags:
        broken = broken | (F.coalesce(bt(f), F.lit(0)) == 1)

    def means(d: DataFrame, parts: list[str]) -> DataFrame:
        w = _window(parts, by)
        full = w.rowsBetween(-(window - 1), 0)
        inner = w.rowsBetween(-(window - 2), 0)
        breaks = F.sum(F.when(broken, 1).otherwise(0)).over(inner) if window > 1 else F.lit(0)
        out = {}
        for c in values:
            out[c + suffix] = F.when(
                (breaks == 0) & (F.count(bt(c)).over(full) == window), r5(F.avg(bt(c)).over(full))
            )
        return d.withColumns(out)

    return over_series(df, keys, by, window - 1, means, bounded)


def since_break_mean(
    df: DataFrame, values: Sequence[str] = S.DELTA, suffix: str = "_E2E", **kw
) -> DataFrame:
    """Mean over the rows since the last break, if they span the full window."""
    return segmented_rolling_mean(df, values, suffix=suffix, **kw)


def stepfree_cumulative(
    df: DataFrame,
    values: Sequence[str] = S.E2E,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    suffix: str = "_MAV_NO_STEPS",
    bounded: bool = False,
) -> DataFrame:
    """Running sum of row-to-row changes of the means, steps left out.

    A change counts only where all means of both rows are complete.
    """
    by = _order(order)
    complete = F.lit(True)
    for c in values:
        complete = complete & bt(c).isNotNull()

    def changes(d: DataFrame, parts: list[str]) -> DataFrame:
        w = _window(parts, by)
        usable = complete & F.coalesce(F.lag(complete).over(w), F.lit(False))
        return d.select("*", *[
            F.when(usable, bt(c) - F.lag(bt(c)).over(w)).otherwise(F.lit(0.0)).alias(f"__d_{c}") for c in values
        ])

    stepped = over_series(df, keys, by, 1, changes, bounded)
    sums = {f"__c_{c}": bt(f"__d_{c}") for c in values}
    total = running_sum(stepped, keys, by, sums, bounded)
    done = total.withColumns({c + suffix: r5(bt(f"__c_{c}")) for c in values})
    return done.drop(*[f"__d_{c}" for c in values], *sums)


def robust_rolling_location(
    df: DataFrame,
    values: Sequence[str] = S.E2E,
    flags: Sequence[str] = FLAGS,
    window: int = 21,
    support: float = 0.75,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    suffix: str = "_ROBUST",
    bounded: bool = False,
) -> DataFrame:
    """Minimum-variance-subset location of the last ``window`` rows per column.

    Exact univariate MCD: of the sorted window the mean of the contiguous
    subset of h = floor(support * n) values with least variance. Variances
    closer than 1e-9 of the whole window's are a tie; the lower subset wins, so
    the choice does not depend on the unit of the values. Null if the window
    holds a break or a null; shorter windows at the start count.
    """
    by = _order(order)
    bad = F.lit(False)
    for f in flags:
        bad = bad | (F.coalesce(bt(f), F.lit(0)) == 1)
    for c in values:
        bad = bad | bt(c).isNull()

    def locate(d: DataFrame, parts: list[str]) -> DataFrame:
        w = _window(parts, by).rowsBetween(-(window - 1), 0)
        ok = F.max(F.when(bad, 1).otherwise(0)).over(w) == 0
        # A frame holds at most ``window`` values, however long the series is.
        framed = d.withColumns({f"__w_{c}": F.when(ok, F.collect_list(bt(c)).over(w)) for c in values})
        mcd = _mcd(support)
        return framed.withColumns({c + suffix: r5(mcd(bt(f"__w_{c}"))) for c in values}).drop(
            *[f"__w_{c}" for c in values])

    return over_series(df, keys, by, window - 1, locate, bounded)


def _mcd(support: float):
    """Least-variance location of each frame, a whole Arrow batch per numpy step.

    Frames are sorted and centred on their least value; sums of values and of
    squares up to each place then give every subset's mean and variance at once.
    The values of a batch stay one array: an object per frame fragments the memory
    of a worker, which then grows with the batches it has seen.
    """
    @F.arrow_udf("double")
    def locate(frames: pa.Array) -> pa.Array:
        out = np.full(len(frames), np.nan)
        sizes = frames.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        values, begin = frames.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
        for n in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == n)
            x = np.sort(values[begin[rows][:, None] + np.arange(n)], axis=1)
            least, x = x[:, :1], x - x[:, :1]
            h = max(int(n * support), 1)
            upto, squares = (np.pad(np.cumsum(v, axis=1), ((0, 0), (1, 0))) for v in (x, x * x))
            part = upto[:, h:] - upto[:, :-h]
            spread = squares[:, h:] - squares[:, :-h] - part * part / h
            whole = squares[:, -1] - upto[:, -1] ** 2 / n
            scale = np.divide(1e9, whole, out=np.zeros(len(x)), where=whole > 0)
            best = np.argmin(np.rint(spread * scale[:, None]), axis=1)
            out[rows] = least[:, 0] + part[np.arange(len(x)), best] / h
        return pa.array(out, mask=sizes == 0, from_pandas=True)

    return locate


def robust_cumulative(
    df: DataFrame,
    values: Sequence[str] = S.E2E,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    robust: str = "_ROBUST",
    suffix: str = "_CUMULATIVE",
    bounded: bool = False,
    **kw,
) -> DataFrame:
    """``robust_rolling_location`` and its running change: 0 at an engine's first
    row, carried on where this or the previous row has no location, else the
    previous sum plus the difference of the two locations."""
    located = robust_rolling_location(df, values, keys=keys, order=order, suffix=robust, bounded=bounded, **kw)
    return stepfree_cumulative(located, [c + robust for c in values], keys, order, suffix, bounded)
