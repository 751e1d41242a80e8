"""Keyed streaming state: waiting halves of a pair, phase matches, engine buffers.

Keys share a state by hash and, where state ends, by time slice: a call of Python
costs milliseconds, so it handles a bucket of keys in array steps, not one key. A
micro-batch writes the states it touched; an event-time timer removes those of a
slice. ``delay`` is the watermark: a row may come that much later than the newest
one. Rows beyond it are dropped.

Two operators answer at once and correct themselves: a row that comes later than
its successors re-opens only the rows it affects, and these are emitted again with
a higher ``revision``. ``latest_revisions`` keeps the last word on every row.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleethealth import schema as S
from fleethealth.functions import bt, micros, slice_of
from fleethealth.operators.phases import BACKWARD, MINUTE, SLICES_PER_TOLERANCE, Lookup

EVENT_TIME = "__event_time"
REVISION = "revision"
STATE = "data binary"
NO_TIME = np.iinfo(np.int64).min
BUCKET = "__bucket"
BUCKETS = 1024  # of keys; like the shuffle partitions fixed for the life of a checkpoint
PAIR_BUCKETS = 256  # wide rows: a call costs tens of milliseconds before it sees a row
PAIR_SLICE = 5 * 24 * 60 * MINUTE
KNOWN = "__known_"

# The helpers below travel with the job: executors need no installed package.
register_pickle_by_value(sys.modules[__name__])


def timed(source: DataFrame, time: str, delay: str) -> DataFrame:
    """``source`` with a watermark, unless its parts have one each. Watermarks need
    TIMESTAMP; the session runs in UTC, so the cast keeps the clock."""
    if EVENT_TIME in source.columns:
        return source
    return source.withColumn(EVENT_TIME, bt(time).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def merged_sources(sources: Iterable[DataFrame], time: str = S.TIME, delay: str = "1 day") -> DataFrame:
    """One stream of several sources, each with a watermark of its own.

    Spark takes the least of them (``spark.sql.streaming.multipleWatermarkPolicy``,
    which must be ``min`` when the query starts), so a source that lags, or is silent,
    holds back the timers and late-row limits of all keyed operators behind. Sources
    may name their columns in any order; all must have the same ones.
    """
    parts = [timed(s, time, delay) for s in sources]
    policy = parts[0].sparkSession.conf.get("spark.sql.streaming.multipleWatermarkPolicy")
    if policy != "min":
        raise ValueError(f"several sources need the watermark policy min, not {policy}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def _fields(source: DataFrame) -> list[T.StructField]:
    return [f for f in source.schema.fields if f.name != EVENT_TIME]


def _joined(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = [f for f in frames if len(f)]
    return pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*map(bt, keys)), F.lit(buckets)).cast("int").alias(BUCKET)


def _coded(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Number of each row's key, by first appearance."""
    return frame.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()


def _whole_numbers(source: DataFrame, keys: Sequence[str]) -> list[str]:
    """Long columns that may be null; pandas would turn a batch with nulls into doubles."""
    return [f.name for f in _fields(source) if isinstance(f.dataType, T.LongType) and f.nullable and f.name not in keys]


def _filled(source: DataFrame, longs: Sequence[str]) -> DataFrame:
    """``source`` with these columns filled, and whether each was known."""
    return source.withColumns({f"{KNOWN}{c}": bt(c).isNotNull() for c in longs} | {c: F.coalesce(bt(c), F.lit(0)) for c in longs})


def _emptied(df: DataFrame, longs: Sequence[str]) -> DataFrame:
    """Undo ``_filled``."""
    return df.withColumns({c: F.when(F.col(f"{KNOWN}{c}"), bt(c)) for c in longs}).drop(*[f"{KNOWN}{c}" for c in longs])


def _known_fields(longs: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(f"{KNOWN}{c}", T.BooleanType()) for c in longs]


def latest_revisions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest emission of every row; one aggregate, merged before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c != REVISION]
    newest = df.groupBy(*map(bt, keys)).agg(F.max_by(F.struct(*map(bt, rest)), bt(REVISION)).alias("__row"))
    return newest.select(*map(bt, keys), "__row.*").select(*[bt(c) for c in df.columns if c != REVISION])


# -- waiting halves ----------------------------------------------------------

def paired_stream(
    source: DataFrame, delay: str = "1 day", pair: Sequence[str] = S.PAIR, engine: str = "ESN", time: str = S.TIME,
    buckets: int = PAIR_BUCKETS,
) -> DataFrame:
    """Rows of pairs with exactly two engines, whatever micro-batches the halves came in.

    The first half waits in state until the other one comes or the watermark
    passes the pair's time; then it finds no other and goes with its time slice. A
    pair leaves once, as soon as it has two engines: more than two in the
    micro-batch that completes it void it, later ones find it closed. Rows without
    a key or an engine are in no pair.
    """
    pair = list(pair)
    longs = _whole_numbers(source, [*pair, engine])
    schema = T.StructType(_fields(source) + _known_fields(longs))
    columns = schema.names

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # Keys of closed pairs, rows of waiting halves.
        closed, waiting = pickle.loads(state.get[0]) if state.exists else (None, None)
        rows = _joined(frames)[columns]
        # A timer holds for one call only, so it is set anew.
        state.setTimeoutTimestamp(max((int(key[-1]) + 1) * PAIR_SLICE // 1000, state.getCurrentWatermarkMs() + 1))
        n_closed = 0 if closed is None else len(closed)
        both = rows if waiting is None else pd.concat([waiting, rows], ignore_index=True)
        keys = both[pair] if closed is None else pd.concat([closed, both[pair]], ignore_index=True)
        code = _coded(keys, pair)[n_closed:]  # closed pairs have the first numbers
        member = both[engine].notna().to_numpy()
        engines = np.bincount(np.unique(np.stack([code[member], pd.factorize(both.loc[member, engine])[0]]), axis=1)[0],
                              minlength=int(code.max()) + 1)[code]
        fresh = code >= n_closed
        done = fresh & (engines >= 2)
        newly = both.loc[done, pair].drop_duplicates()
        left = both[fresh & ~done]
        state.update((pickle.dumps((
            newly if closed is None else pd.concat([closed, newly], ignore_index=True), left if len(left) else None)),))
        if (out := fresh & (engines == 2)).any():
            yield both[out]

    known = bt(engine).isNotNull()
    for k in pair:
        known = known & bt(k).isNotNull()
    sliced = _filled(timed(source.where(known), time, delay), longs).select(
        "*", bucket_of(pair, buckets), slice_of(micros(time), PAIR_SLICE).alias("__slice"))
    found = sliced.groupBy(BUCKET, "__slice").applyInPandasWithState(
        advance, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return _emptied(found, longs)


# -- phase matches -----------------------------------------------------------

def phase_matches_stream(
    source: DataFrame, driver: str = "cruise", lookups: Sequence[Lookup] = BACKWARD, keys: Sequence[str] = S.INSTALLATION,
    time: str = S.TIME, value: str = "row_sum", delay: str = "1 hour", buckets: int = BUCKETS,
) -> DataFrame:
    """Every driver row with the nearest strictly earlier row of each lookup phase,
    null where none is within its tolerance; emitted on arrival and again when a
    better lookup comes late.

    State is kept per bucket of installations and time slice (as in ``phase_asof``,
    lookups near a border are copied over it): the lookups' times and, per driver
    row, the one match it has, never pairs. It goes when the watermark passes the slice.
    ``copy`` numbers driver rows of one time, so every row keeps its identity.
    """
    reach = int(max(x.minutes for x in lookups) * MINUTE)
    width = reach * SLICES_PER_TOLERANCE
    known = bt(S.PHASE).isin([driver, *[x.phase for x in lookups]])
    for k in keys:
        known = known & bt(k).isNotNull()
    us = F.col("__us")
    base = timed(source.where(known), time, delay).select(
        *map(bt, keys), bt(S.PHASE).alias("__phase"), bt(value).cast("long").alias("__value"), micros(time).alias("__us"), EVENT_TIME)
    home = slice_of(us, width)
    near = (F.col("__phase") != driver) & (F.pmod(us, F.lit(width)) >= width - reach)
    # Rows without a time have no slice and no match; only drivers among them count.
    spread = base.where(us.isNotNull() | (F.col("__phase") == driver)).withColumn(
        "__slice", F.explode(F.when(near, F.array(home, home + 1)).otherwise(F.array(home))))
    keys, names = list(keys), [x.suffix for x in lookups]
    plain = [(x.suffix, x.phase, x.minutes * MINUTE) for x in lookups]
    fields = ([source.schema[k] for k in keys]
              + [T.StructField(n, T.LongType()) for n in ("__us", "copy", "__value")]
              + [T.StructField(f"{p}{n}", T.LongType()) for n in names for p in ("__us_", "__value_")]
              + [T.StructField(REVISION, T.LongType())])

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _joined(frames)
        phase, amount = rows["__phase"].to_numpy(), rows["__value"].to_numpy(dtype=float)
        when = rows["__us"].fillna(NO_TIME).to_numpy(dtype=np.int64)
        # Installations; lookups: (installations, times, values) per phase; drivers: installation, time, copy, value,
        # revision and one (time, value) per lookup.
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        own_keys, looked, old = pickle.loads(state.get[0]) if state.exists else (None, [none] * len(plain), None)
        named = rows[keys] if own_keys is None else pd.concat([own_keys, rows[keys]], ignore_index=True)
        codes = _coded(named, keys)  # those of the state come first and keep their numbers
        whose = codes[len(codes) - len(rows):]
        timeless = key[-1] is None or pd.isna(key[-1])
        # Installation and time in one number: times of a slice span less than ``width + reach``.
        begin = 0 if timeless else int(key[-1]) * width - reach
        place = lambda of, us: of * (width + reach) + (us - begin)
        seen = []
        for (of, times, values), (_, name, _) in zip(looked, plain):
            own = phase == name
            of, times, values = np.append(of, whose[own]), np.append(times, when[own]), np.append(values, amount[own])
            order = np.lexsort((np.where(np.isnan(values), -np.inf, values), times, of))
            of, times, values = of[order], times[order], values[order]
            last = np.append((times[1:] != times[:-1]) | (of[1:] != of[:-1]), True)[:len(times)]  # of equal times the largest value
            seen.append((of[last], times[last], values[last]))
        own = phase == driver
        fresh = {"of": whose[own], "us": when[own], "value": amount[own], "revision": np.zeros(own.sum(), np.int64)}
        drivers = fresh if old is None else {c: np.append(old[c], fresh[c]) for c in fresh}
        n_old = 0 if old is None else len(old["us"])
        drivers["copy"] = pd.DataFrame({c: drivers[c] for c in ("of", "us")}).groupby(["of", "us"]).cumcount().to_numpy()
        changed = np.arange(len(drivers["us"])) >= n_old
        for (of, times, values), (suffix, _, limit) in zip(seen, plain):
            found, worth = np.full(len(changed), NO_TIME), np.full(len(changed), np.nan)
            if len(times) and not timeless:
                at = np.searchsorted(place(of, times), place(drivers["of"], drivers["us"]), "left") - 1
                hit = (at >= 0) & (of[at] == drivers["of"])
                hit[hit] = drivers["us"][hit] - times[at[hit]] < limit
                found[hit], worth[hit] = times[at[hit]], values[at[hit]]
            if n_old:
                before = old[suffix]
                changed[:n_old] |= (before[0] != found[:n_old]) | ~((before[1] == worth[:n_old]) | (np.isnan(before[1]) & np.isnan(worth[:n_old])))
            drivers[suffix] = (found, worth)
        drivers["revision"] = drivers["revision"] + changed
        unique = named.drop_duplicates(ignore_index=True)
        if not timeless:
            state.update((pickle.dumps((unique, seen, drivers)),))
            state.setTimeoutTimestamp(max((int(key[-1]) + 1) * width // 1000, state.getCurrentWatermarkMs() + 1))
        if changed.any():
            out = unique.iloc[drivers["of"][changed]].reset_index(drop=True)
            moment = lambda a: pd.Series(a[changed], dtype="Int64").mask(a[changed] == NO_TIME)
            amounts = lambda a: pd.Series(np.nan_to_num(a[changed]).astype(np.int64), dtype="Int64").mask(np.isnan(a[changed]))
            more = {"__us": moment(drivers["us"]), "copy": drivers["copy"][changed], "__value": amounts(drivers["value"])}
            for n in names:
                more |= {f"__us_{n}": moment(drivers[n][0]), f"__value_{n}": amounts(drivers[n][1])}
            yield out.assign(**more, **{REVISION: drivers["revision"][changed]})

    found = spread.withColumn(BUCKET, bucket_of(keys, buckets)).groupBy(BUCKET, "__slice").applyInPandasWithState(
        advance, T.StructType(fields), STATE, "append", GroupStateTimeout.EventTimeTimeout)
    clock = lambda c, n: F.timestamp_micros(F.col(c)).cast("timestamp_ntz").alias(n)
    tag = driver.replace("-", "")
    return found.select(
        *map(bt, keys), clock("__us", f"{time}_{tag}"), "copy", F.col("__value").alias(f"{value}_{tag}"),
        *[c for n in names for c in (clock(f"__us_{n}", f"{time}_{n}"), F.col(f"__value_{n}").alias(f"{value}_{n}"))], REVISION)


# -- engine buffers ----------------------------------------------------------

def _rounded(x: np.ndarray) -> np.ndarray:
    return np.rint(x * 1e5) / 1e5


def _trailing_mean(x: np.ndarray, window: int) -> np.ndarray:
    """Mean of the last ``window`` values, nan if one is nan or there are fewer; summed oldest first."""
    out = np.full(len(x), np.nan)
    n = len(x) - window + 1
    if n > 0:
        total = x[:n].copy()
        for j in range(1, window):
            total += x[j:j + n]
        out[window - 1:] = _rounded(total / window)
    return out


def engine_history_stream(
    source: DataFrame, values: Sequence[str], lags: Sequence[int], window: int, flags: Sequence[str] = (),
    keys: Sequence[str] = S.ENGINE, order: Sequence[str] = S.ENGINE_ORDER, delay: str = "1 day", suffix: str = "_MEAN",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rolling means and lag deltas of arriving rows, with a buffer per engine.

    The buffer holds the rows newer than the watermark, which late ones may still
    precede, and before them the max(lag) + window - 1 rows that their results
    reach back to; nothing of it is written for buckets of engines without new rows. A late
    row takes its place in the buffer and the rows behind it whose mean or delta it
    changes, at most window + max(lag) of them, are emitted again. ``order`` starts
    with the time; rows with a null time or key are left out.
    """
    need = max(lags) + window - 1
    keys = list(keys)
    longs = _whole_numbers(source, [*keys, order[0]])
    fields = _fields(source) + _known_fields(longs)
    columns = [f.name for f in fields]
    named = {(v, n): S.lag_column(f"{v}{suffix}", n) for v in values for n in lags}
    results = [f"{v}{suffix}" for v in values] + [S.lag_column(f"{v}{suffix}", n) for n in lags for v in values]
    schema = T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in results]
                          + [T.StructField(REVISION, T.LongType())])
    ranks = [c for o in order for c in ([f"{KNOWN}{o}", o] if o in longs else [o])]

    def score(rows: dict[str, np.ndarray], within: np.ndarray) -> dict[str, np.ndarray]:
        """``within``: place of each row in its engine's buffer."""
        number = lambda c: np.where(rows[f"{KNOWN}{c}"].astype(bool), rows[c], np.nan) if c in longs else rows[c].astype(float)
        clean = np.ones(len(within), bool)
        for f in flags:
            clean &= number(f) == 0
        out = {}
        for v in values:
            mean = _trailing_mean(np.where(clean, number(v), np.nan), window)
            mean[within < window - 1] = np.nan
            out[f"{v}{suffix}"] = mean
            for lag in lags:
                change = np.full(len(mean), np.nan)
                change[lag:] = _rounded(mean[lag:] - mean[:max(len(mean) - lag, 0)])
                change[within < lag] = np.nan
                out[named[v, lag]] = change
        return out

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _joined(frames)[columns]
        fresh = {c: rows[c].to_numpy() for c in columns}
        # Per buffered row its engine's ``whole`` (the buffer begins where the series does) and revision.
        held = pickle.loads(state.get[0]) if state.exists else None
        n_old = 0 if held is None else len(held[REVISION])
        both = fresh if held is None else {c: np.concatenate([held[c], fresh[c]]) for c in columns}
        engine = _coded(pd.DataFrame({k: both[k] for k in keys}), keys)
        rank = [pd.factorize(both[c], sort=True)[0] for c in reversed(ranks)]  # nulls first, as Spark sorts
        place = np.lexsort([*rank, engine])
        both, engine, old = {c: a[place] for c, a in both.items()}, engine[place], place < n_old
        begin = np.flatnonzero(np.append(True, engine[1:] != engine[:-1]))
        size = np.diff(np.append(begin, len(engine)))
        within = np.arange(len(engine)) - np.repeat(begin, size)
        per_engine = lambda ufunc, of: np.repeat(ufunc.reduceat(of, begin), size)
        scored = score(both, within)
        changed, whole, revision = ~old, np.ones(len(place), bool), np.zeros(len(place), np.int64)
        if held is not None:
            whole[old], revision[old] = held["__whole"][place[old]], held[REVISION][place[old]]
            whole, revision = per_engine(np.logical_and, whole), per_engine(np.maximum, revision)
            # Rows too near the buffer's start keep what was found when it reached further back.
            fixed = np.flatnonzero(old & ~whole & (within < need))
            for c in results:
                scored[c][fixed] = held[c][place[fixed]]
                before, now = held[c][place[old]], scored[c][old]
                changed[old] |= ~((before == now) | (np.isnan(before) & np.isnan(now)))
        revision = revision + per_engine(np.logical_or, ~old)
        mark = np.datetime64(state.getCurrentWatermarkMs(), "ms")
        beyond = both[order[0]] > mark
        first_open = per_engine(np.minimum, np.where(beyond, within, np.repeat(size, size)))
        cut = np.minimum(np.maximum(0, first_open - need), np.repeat(size, size) - 1)  # one row remembers the engine
        kept = within >= cut
        everything = {**both, **scored, REVISION: revision}
        state.update((pickle.dumps({c: a[kept] for c, a in {**everything, "__whole": whole & (cut == 0)}.items()}),))
        yield pd.DataFrame({c: a[changed] for c, a in everything.items()})

    known = bt(order[0]).isNotNull()
    for k in keys:
        known = known & bt(k).isNotNull()
    found = (_filled(timed(source.where(known), order[0], delay), longs).withColumn(BUCKET, bucket_of(keys, buckets))
             .groupBy(BUCKET).applyInPandasWithState(advance, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout))
    return _emptied(found, longs).select(*[bt(f.name) for f in _fields(source)], *results, REVISION)
