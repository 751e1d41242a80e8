"""Row filters, casts and schema alignment."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt, r5

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns else None)


def drop_sentinel(
    df: DataFrame, columns: Sequence[str] = S.REQUIRED_READINGS, sentinel: float = S.SENTINEL
) -> DataFrame:
    """Sentinel readings become null; rows missing a required reading go."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    cleaned = df.select(*[
        F.nullif(bt(c), F.lit(sentinel)).cast(df.schema[c].dataType).alias(c) if c in numeric else bt(c)
        for c in df.columns
    ])
    return cleaned.dropna("any", subset=[c for c in columns if c in df.columns])


def range_filter(
    df: DataFrame,
    limits: Mapping[str, Mapping[str, tuple[float, float]]] = S.RANGE_LIMITS,
    phase: str | Column = S.PHASE,
) -> DataFrame:
    """Keep rows whose readings lie within the inclusive limits of their phase.

    ``phase`` is a column (name) or, as a literal Column, one phase for all rows.
    The condition is a plain conjunction per phase, so it reaches the scan.
    A phase without limits is an error.
    """
    key = F.lower(bt(phase) if isinstance(phase, str) else phase)
    ok = None
    for name, columns in limits.items():
        tests = [bt(c).between(F.lit(float(lo)), F.lit(float(hi)))
                 for c, (lo, hi) in columns.items() if c in df.columns]
        branch = reduce(lambda a, b: a & b, tests, key == F.lit(name.lower()))
        ok = branch if ok is None else ok | branch
    unknown = F.raise_error(F.concat(F.lit("no limits for phase: "), F.coalesce(key, F.lit("null"))))
    known = key.isin([n.lower() for n in limits])
    return df.where(F.when(known, True).otherwise(unknown.cast("boolean"))).where(ok)


def kelvin_to_celsius(df: DataFrame, columns: Sequence[str] = S.KELVIN_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: bt(c) - F.lit(S.KELVIN_OFFSET) for c in present})


def cast_and_round(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type columns by name; readings become doubles rounded to 5 places."""
    chosen = set(columns or df.columns)
    out = []
    for c in df.columns:
        if c not in chosen:
            out.append(bt(c))
            continue
        t = S.column_type(c)
        cast = bt(c).cast(t)
        out.append((r5(cast) if isinstance(t, T.DoubleType) else cast).alias(c))
    return df.select(*out)


def enforce_schema(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Add missing columns (typed null or default), cast the others leniently."""
    defaults = defaults or {}
    wanted = {f.name: f.dataType for f in schema}
    present = {f.name: f.dataType for f in df.schema}
    recast = {n: bt(n).try_cast(t) for n, t in wanted.items() if n in present and present[n] != t}
    added = {n: F.lit(defaults.get(n)).cast(t) for n, t in wanted.items() if n not in present}
    return df.withColumns({**recast, **added}) if recast or added else df


def init_columns(
    df: DataFrame, columns: Sequence[str], since: datetime | None = None, time: str = S.TIME
) -> DataFrame:
    """(Re)set derived columns: null for ``*DEL*``, 0 for ids and flags.

    With ``since`` only rows at or after it are reset.
    """
    due = F.lit(True) if since is None else bt(time) >= F.lit(since).cast("timestamp_ntz")
    fresh = {}
    for c in columns:
        t = S.column_type(c)
        start = F.lit(None).cast(t) if "DEL" in c else F.lit(0).cast(t)
        old = bt(c) if c in df.columns else F.lit(None).cast(t)
        fresh[c] = F.when(due, start).otherwise(old)
    return df.withColumns(fresh)


def cast_by_pattern(df: DataFrame, pattern: str = r"VAR\d+_IDENTIFIER\d+", to: str = "string") -> DataFrame:
    return df.select(*[
        bt(c).cast(to).alias(c) if re.fullmatch(pattern, c) else bt(c) for c in df.columns
    ])


def new_flag(
    df: DataFrame, checkpoint: datetime | None, time: str = S.TIME, inclusive: bool = False
) -> DataFrame:
    """1 for rows past the checkpoint; without a checkpoint every row is new."""
    if checkpoint is None:
        flag = F.lit(1)
    else:
        ts = F.lit(checkpoint).cast("timestamp_ntz")
        flag = F.when(bt(time) >= ts if inclusive else bt(time) > ts, 1).otherwise(0)
    return df.withColumn(S.NEW_FLAG, flag.cast("long"))


def only_new(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a row-set-changing transform to new rows, pass the others through.

    Row-local operators use ``functions.new_rows_only`` instead and need no union.
    """
    is_new = bt(S.NEW_FLAG) == 1
    done = df.where(is_new).transform(fn)
    return df.where(~is_new).unionByName(done, allowMissingColumns=True)


def clean_reports(
    df: DataFrame, times: Sequence[str] = S.TIME_COLUMNS, keep: Sequence[str] = ("days_since_prev",),
    fmt: str = TIME_FORMAT,
) -> DataFrame:
    """Parse time strings (bad ones drop the row) and round readings."""
    out = []
    for f in df.schema:
        c = bt(f.name)
        if f.name in times:
            out.append(to_ntz(f.name, fmt, f.dataType).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep:
            out.append(r5(c.cast("double")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out).dropna("any", subset=list(times))


def to_ntz(name: str, fmt: str, current: T.DataType = T.StringType()) -> Column:
    """Lenient parse to TIMESTAMP_NTZ; null where the text does not fit."""
    if not isinstance(current, T.StringType):
        return bt(name).cast("timestamp_ntz")
    return F.try_to_timestamp(bt(name), F.lit(fmt)).cast("timestamp_ntz")


def parse_mixed_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """With seconds, else without seconds, else any ISO form, else null."""
    return df.withColumns({
        c: F.coalesce(
            to_ntz(c, "yyyy-MM-dd HH:mm:ss"),
            to_ntz(c, "yyyy-MM-dd HH:mm"),
            bt(c).try_cast("timestamp_ntz"),
        )
        for c in columns
    })
