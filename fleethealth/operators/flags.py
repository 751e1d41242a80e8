"""Day gaps, shop-visit flags and sister-engine changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fleethealth import schema as S
from fleethealth.functions import bt, micros, new_rows_only, rounded
from fleethealth.operators.skew import over_series

MICROS_PER_DAY = 86_400_000_000.0


def _series(df: DataFrame, keys: Sequence[str], context: str) -> list[str]:
    """In batch context new rows do not see the stored ones."""
    split = context == "batch" and S.NEW_FLAG in df.columns
    return [*keys, S.NEW_FLAG] if split else list(keys)


def days_since_prev(
    df: DataFrame,
    keys: Sequence[str] = (S.PHASE, "ESN", "ACID", "ENGPOS"),
    order: Sequence[str] = S.ENGINE_ORDER,
    name: str = "days_since_prev",
    context: str = "batch",
    bounded: bool = False,
) -> DataFrame:
    """Days (1 decimal) since the previous report of the installation, first 0."""
    by = [bt(c) for c in order]
    fresh = new_rows_only(df)

    def gaps(d: DataFrame, parts: list[str]) -> DataFrame:
        w = Window.partitionBy(*map(bt, parts)).orderBy(*by)
        us = micros(order[0])
        days = rounded((us - F.lag(us).over(w)) / F.lit(MICROS_PER_DAY), 1)
        return d.withColumns({name: fresh(name, F.coalesce(days, F.lit(0.0)))})

    return over_series(df, _series(df, keys, context), by, 1, gaps, bounded)


def engine_flags(
    df: DataFrame,
    min_sv_dur: float = 40.0,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    gap: str = "days_since_prev",
    sister: str = "SISTER_ESN",
    context: str = "batch",
    bounded: bool = False,
) -> DataFrame:
    """FlagSV: first row of an engine or a gap above ``min_sv_dur``.
    FlagSisChg: the sister engine differs from the previous row's (missing differs)."""
    by = [bt(c) for c in order]
    fresh = new_rows_only(df)

    def flag(d: DataFrame, parts: list[str]) -> DataFrame:
        w = Window.partitionBy(*map(bt, parts)).orderBy(*by)
        first = F.lag(F.lit(1)).over(w).isNull()
        visit = F.when(first | (bt(gap) > F.lit(float(min_sv_dur))), 1).otherwise(0)
        change = F.when(first | (F.lag(bt(sister)).over(w) == bt(sister)), 0).otherwise(1)
        return d.withColumns({
            "FlagSV": fresh("FlagSV", visit.cast("long")),
            "FlagSisChg": fresh("FlagSisChg", change.cast("long")),
        })

    return over_series(df, _series(df, keys, context), by, 1, flag, bounded)
