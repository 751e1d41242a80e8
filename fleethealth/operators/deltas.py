"""Percent deltas and differences between the two engines of an aircraft."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth import schema as S
from fleethealth.functions import bt, norm, new_rows_only, r5, rounded
from fleethealth.operators.skew import _matches, heavy_keys, split_heavy

PAIR_TIES = ("DSCID", "ENGPOS", "operator", "datestored")


def percent_delta(df: DataFrame, parameters: Sequence[S.Parameter] = S.PARAMETERS) -> DataFrame:
    """(measured - nominal) * 100 / nominal on new rows; zero nominal gives null."""
    present = set(df.columns)
    missing = [c for p in parameters for c in (p.measured, p.nominal) if c not in present]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    fresh = new_rows_only(df)
    out = {}
    for p in parameters:
        value = F.try_divide((bt(p.measured) - bt(p.nominal)) * F.lit(100.0), bt(p.nominal))
        out[f"{p.name}__DEL_PC"] = fresh(f"{p.name}__DEL_PC", r5(value))
    return df.withColumns(out)


def row_norm(df: DataFrame, columns: Sequence[str], name: str = "norm", ord: float = 2) -> DataFrame:
    return df.withColumn(name, rounded(norm(columns, ord), 8))


def observed_magnitude(
    df: DataFrame, lags: Sequence[int], columns: Sequence[str] = S.MEAN, prefix: str = "OBSERVED_MAGNITUDE"
) -> DataFrame:
    """L2 norm of the lag columns, one result per lag."""
    return df.withColumns({
        f"{prefix}{lag}": rounded(norm([S.lag_column(c, lag) for c in columns]), 8) for lag in lags
    })


def _is_new(df: DataFrame) -> Column:
    return bt(S.NEW_FLAG) == 1 if S.NEW_FLAG in df.columns else F.lit(True)


def _pair_keys(df: DataFrame, pair: Sequence[str]) -> list[str]:
    return [*pair, S.NEW_FLAG] if S.NEW_FLAG in df.columns else list(pair)


def _known_keys(pair: Sequence[str]) -> Column:
    ok = F.lit(True)
    for k in pair:
        ok = ok & bt(k).isNotNull()
    return ok


def pair_groups_only(df: DataFrame, pair: Sequence[str] = S.PAIR, engine: str = "ESN") -> DataFrame:
    """New rows whose group holds exactly two distinct engines; old rows pass."""
    keys = _pair_keys(df, pair)
    df = df.where(~_is_new(df) | _known_keys(pair))

    def by_window(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*map(bt, keys))
        ranked = d.withColumn("__dr", F.dense_rank().over(w.orderBy(bt(engine))))
        nulls = F.max(F.when(bt(engine).isNull(), 1).otherwise(0)).over(w)  # a null rank is no engine
        return (ranked.withColumn("__engines", F.max("__dr").over(w) - nulls)
                .where(~_is_new(d) | (F.col("__engines") == 2)).drop("__dr", "__engines"))

    hot = heavy_keys(df, keys)
    if hot is None:
        return by_window(df)
    light, heavy = split_heavy(df, keys, hot)
    valid = (heavy.where(_is_new(df)).groupBy(*[bt(k).alias(f"__h_{k}") for k in keys])
             .agg(F.count_distinct(bt(engine)).alias("__engines")).where(F.col("__engines") == 2))
    paired = heavy.where(_is_new(df)).join(hot.hint(valid), _matches(keys), "left_semi")
    return by_window(light).unionByName(heavy.where(~_is_new(df))).unionByName(paired)


def sister_delta(
    df: DataFrame,
    values: Sequence[str] = S.DELTA,
    pair: Sequence[str] = S.PAIR,
    engine: str = "ESN",
    ties: Sequence[str] = PAIR_TIES,
    sister: str = "SISTER_ESN",
    suffix: str = "_E2E",
    bounded: bool = False,
) -> DataFrame:
    """Own value minus the sister engine's, for groups with exactly two engines.

    Within a group ordered by engine the first row's sister is the second row,
    every later row's sister is the first. New rows outside a valid group go.
    One shuffle and no self join; a heavy group is reduced to its two leading
    rows, which are then broadcast to the group's rows.
    """
    df = df.where(~_is_new(df) | _known_keys(pair))
    keys = _pair_keys(df, pair)
    columns = set(df.columns)
    present = [c for c in values if c in columns]
    ties = [c for c in ties if c in columns]
    keep_old = new_rows_only(df)
    lead = F.struct(bt(engine), *[bt(c) for c in ties], *[bt(c) for c in present if c not in ties])
    order = [bt(engine), *map(bt, ties), *map(bt, present)]

    def finish(d: DataFrame, is_first: Column) -> DataFrame:
        other = lambda c: F.when(is_first, F.col("__second")[c]).otherwise(F.col("__first")[c])
        fresh = {sister: other(engine).cast("long")}
        for c in values:
            fresh[c + suffix] = r5(bt(c) - other(c)) if c in present else F.lit(None).cast("double")
        fresh = {n: keep_old(n, v) for n, v in fresh.items()}
        helpers = ("__dr", "__rn", "__first", "__second", "__engines")
        return d.withColumns(fresh).drop(*helpers, *[f"__h_{k}" for k in keys])

    def by_window(d: DataFrame) -> DataFrame:
        w = Window.partitionBy(*map(bt, keys))
        full = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ranked = d.select(
            "*",
            F.row_number().over(w.orderBy(*order)).alias("__rn"),
            F.first(lead).over(full).alias("__first"),
            F.nth_value(lead, 2).over(full).alias("__second"),
            F.dense_rank().over(w.orderBy(bt(engine))).alias("__dr"),
        )
        counted = ranked.withColumn("__engines", F.max("__dr").over(w))
        return finish(counted.where(~_is_new(d) | (F.col("__engines") == 2)), F.col("__rn") == 1)

    # Null engines count as no engine at all.
    df = df.where(~_is_new(df) | bt(engine).isNotNull())
    hot = None if bounded else heavy_keys(df, keys)
    if hot is None:
        return by_window(df)
    light, heavy = split_heavy(df, keys, hot)
    fresh = heavy.where(_is_new(df))
    by = [bt(k).alias(f"__h_{k}") for k in keys]
    engines = fresh.groupBy(*by).agg(F.count_distinct(bt(engine)).alias("__engines"))
    leaders = (
        first_two(fresh, keys, order).groupBy(*by)
        .agg(F.max(F.when(F.col("__rn") == 1, lead)).alias("__first"),
             F.max(F.when(F.col("__rn") == 2, lead)).alias("__second"))
        .join(engines.where(F.col("__engines") == 2), [f"__h_{k}" for k in keys])
    )
    paired = finish(fresh.join(hot.hint(leaders), _matches(keys)), lead.eqNullSafe(F.col("__first")))
    nothing = F.lit(None).cast(fresh.select(lead.alias("x")).schema["x"].dataType)
    old = heavy.where(~_is_new(df)).withColumns({"__first": nothing, "__second": nothing})
    return by_window(light).unionByName(paired).unionByName(finish(old, F.lit(False)))


def first_two(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*map(bt, keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 2)
