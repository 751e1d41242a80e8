"""The full chain: increment of reports in, stage table and alerts out.

All phases and engines go through one plan. Shuffles: one for the dedup, one for
the pairs, on (phase, engine) one shared by flags, means and lags, one for the
statistics and one for the newest-n cut, one on (installation, slice) for the
phase match.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from fleethealth import schema as S
from fleethealth.functions import STORED, bt, packed, unpacked
from fleethealth.operators import clean, deltas, fit, flags, history, phases, stats, trend
from fleethealth.operators.skew import heavy_keys
from fleethealth.session import release
from fleethealth.sources.state import low_watermark


@dataclass
class Result:
    stage: DataFrame
    merged: DataFrame
    summary: DataFrame
    checkpoint: DataFrame


@dataclass(frozen=True)
class Spread:
    """Which groups of the increment are known to be small (checked on the raw scan)."""

    engines: bool = True
    pairs: bool = True


def check_spread(new: DataFrame) -> Spread:
    """Two keys-only scans of the increment; later stages need no further checks
    because history adds at most ``n_points`` rows per engine. Series of a heavy
    engine are cut into chunks by every stage."""
    return Spread(heavy_keys(new, S.ENGINE) is None, heavy_keys(new, S.PAIR) is None)


def ingest(
    new: DataFrame,
    stored: DataFrame | None,
    settings: S.Settings,
    checkpoint: datetime | None,
    spread: Spread = Spread(),
    by_origin: bool = False,
) -> DataFrame:
    """Clean the increment, merge it with the stored rows and flag new rows.

    The newest ``n_points`` stored rows per engine are context; new rows are
    never cut, however many there are. New is what lies past the checkpoint or,
    ``by_origin``, what is not stored yet, however late it comes; then derived
    columns of stored rows come packed, and new rows have none.
    """
    # Time and engine first: the dedup sorts by these columns and rarely looks past them.
    query_columns = [S.TIME, "ESN", S.PHASE, *[c for c in S.REPORT_COLUMNS if c not in (S.TIME, "ESN")]]
    cleaned = (
        new.select(*query_columns)
        .transform(clean.drop_null_rows)
        .transform(clean.range_filter)
        .transform(clean.kelvin_to_celsius)
        .transform(clean.cast_and_round)
    )
    if by_origin:
        return _by_origin(cleaned, stored, settings, query_columns)
    context = None if stored is None else history.latest_n(stored, settings.n_points, bounded=True)
    merged = history.merged(context, cleaned, query_columns)
    staged = clean.enforce_schema(merged, S.stage_schema(settings)).select(*map(bt, S.stage_columns(settings)))
    flagged = clean.new_flag(staged, checkpoint)
    return flags.days_since_prev(flagged, bounded=spread.engines) if settings.context == "batch" else flagged


def _by_origin(cleaned: DataFrame, stored: DataFrame | None, settings: S.Settings, columns: list[str]) -> DataFrame:
    flagged = lambda d, new, *more: d.select(*map(bt, columns), F.lit(new).cast("long").alias(S.NEW_FLAG), *more)
    if stored is None:
        return flagged(history.merged(None, cleaned, columns), 1)
    context = history.newest(stored, settings.n_points, bounded=True).dropna("any", subset=columns)
    derived = [c for c in S.stage_columns(settings) if c not in columns and c != S.NEW_FLAG]
    old = flagged(context, 0, F.struct(*map(bt, derived)).alias(STORED))
    none = F.lit(None).cast(old.schema[STORED].dataType).alias(STORED)
    return old.unionByName(flagged(history.unseen(context, cleaned, columns), 1, none))


def _narrowed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Of the packed columns of stored rows only those still to be taken up."""
    if STORED not in df.columns:
        return df
    fields = F.struct(*[bt(STORED).getField(c).alias(c) for c in columns])
    return df.withColumn(STORED, F.when(bt(STORED).isNotNull(), fields))


#: Columns that a stage of the chain is done with, packed until the end.
_READINGS, _CHANGES, _FITS = "__readings", "__changes", "__fits"


def run_stages(
    df: DataFrame, signatures: DataFrame, settings: S.Settings = S.Settings(), spread: Spread = Spread(),
    snapshots: str | None = None, late_rows: bool = False,
) -> DataFrame:
    """Ingested rows to the fully widened stage table.

    In history context day gaps are taken here,
    between paired reports: unpaired ones are not stored, so a gap to them would
    depend on where the input was cut. With ``snapshots`` (a shared folder) the
    trend and fit stage is written there and read back: the Python fit is then
    never repeated, whatever happens to the stages after it. The shuffles that made
    it go when it is there. With ``late_rows``
    stored rows behind a new one are scored again (history context): means, lags
    and fits as far as windows and lags reach, statistics to the end.

    With snapshots all columns are wanted in the end, and those that are only carried
    along travel in structs: a window or sort costs time for every column of a row,
    and most of 200 are not its business.
    """
    if late_rows and settings.context != "history":
        raise ValueError("late rows need the history context")

    def snap(d: DataFrame, name: str) -> DataFrame:
        if not snapshots:
            return d
        d.write.parquet(f"{snapshots}/{name}")
        release(d.sparkSession)
        return d.sparkSession.read.schema(d.schema).parquet(f"{snapshots}/{name}")

    pack = packed if snapshots else lambda d, *_: d
    fits = [c for lag in settings.lags for c in S.fit_columns(lag) if "IDENTIFIER" not in c]
    paired = (
        df.transform(deltas.percent_delta)
        .transform(pack, ["equipmentid", *S.MEASURED, *S.NOMINAL, *S.AMBIENT], _READINGS)
        .transform(deltas.sister_delta, bounded=spread.pairs)
    )
    if late_rows:
        paired = trend.reopened(
            paired, settings.window - 1 + max(settings.lags), S.trend_columns(settings), bounded=spread.engines)
    if settings.context == "history":
        paired = flags.days_since_prev(paired, context="history", bounded=spread.engines)
    trends = (
        paired.transform(flags.engine_flags, settings.min_sv_dur, context=settings.context, bounded=spread.engines)
        .transform(trend.masked_rolling_mean, window=settings.window, bounded=spread.engines)
        .transform(pack, ["datestored", "days_since_prev", *S.DELTA, "SISTER_ESN", *S.E2E, "FlagSV", "FlagSisChg"], _CHANGES)
        .transform(trend.lag_delta, lags=settings.lags, bounded=spread.engines)
    )
    shifted = (
        trends.transform(fit.signature_fit, signatures, settings)
        .transform(_narrowed, S.score_columns(settings))
        .transform(snap, "fit")
        .transform(stats.damage_shift, settings.lags)
        .transform(pack, [*S.MEAN, *S.lag_columns(settings.lags), *fits], _FITS)
    )
    if late_rows:
        shifted = trend.reopened_behind(shifted, bounded=spread.engines)
    staged = (
        shifted.transform(stats.summary_stats, settings, bounded=spread.engines)
        .transform(stats.exceedance_count, settings.fraction_limit)
    )
    return unpacked(staged, S.stage_columns(settings), (_READINGS, _CHANGES, _FITS))


def evaluate(
    stage: DataFrame, settings: S.Settings = S.Settings(), bounded: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Matched flights with their alert flag, and the summary per installation."""
    merged = matched(stage, settings, bounded)
    return merged, phases.alert_summary(merged)


def matched(
    stage: DataFrame, settings: S.Settings = S.Settings(), bounded: bool = False, only_new: bool = False
) -> DataFrame:
    """Flights with the counts of their phases and the alert flag; ``only_new``:
    those of which at least one report is new."""
    lookups = (
        phases.Lookup("takeoff", "take-off", settings.takeoff_minutes),
        phases.Lookup("climb", "climb", settings.climb_minutes),
    )
    if not only_new:
        found = phases.phase_asof(stage, lookups=lookups, bounded=bounded)
    else:
        carried = stage.withColumn("__match", F.struct(bt("row_sum"), bt(S.NEW_FLAG)))
        pairs = phases.phase_asof(carried, lookups=lookups, value="__match", bounded=bounded)
        names = ("takeoff", "climb", "cruise")
        fresh = F.greatest(*[F.col(f"__match_{n}.{S.NEW_FLAG}") for n in names]) == 1
        found = pairs.where(fresh).withColumns({f"row_sum_{n}": F.col(f"__match_{n}.row_sum") for n in names}).drop(
            *[f"__match_{n}" for n in names])
    return found.transform(phases.alert_flag, settings.min_exceedances)


def run_increment(
    new: DataFrame,
    signatures: DataFrame,
    stored: DataFrame | None = None,
    settings: S.Settings = S.Settings(),
    checkpoint: datetime | None = None,
    check_skew: bool = True,
    snapshots: str | None = None,
) -> Result:
    spread = check_spread(new) if check_skew else Spread()
    stage = run_stages(ingest(new, stored, settings, checkpoint, spread), signatures, settings, spread, snapshots)
    # An installation has at most as many rows as its engine in three phases.
    merged, summary = evaluate(stage, settings, bounded=spread.engines)
    # Retention is for what is stored, after everything new has been scored.
    return Result(history.latest_n(stage, settings.n_points, bounded=spread.engines), merged, summary, low_watermark(new))


def trend_movers(stage: DataFrame, lag: int) -> DataFrame:
    """Engines by the largest change of their step-free means over ``lag`` rows."""
    moved = F.greatest(*[F.abs(F.col(S.lag_column(c, lag))) for c in S.MEAN])
    return (stage.groupBy(S.PHASE, "ESN")
            .agg(F.max(moved).alias("largest_move"), F.count(moved).alias("reports"))
            .where(F.col("largest_move").isNotNull()))
