"""Matching the flight phases of one flight and deciding on alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth import schema as S
from fleethealth.functions import bt, micros, slice_of
from fleethealth.operators.skew import heavy_keys, nearest_events, with_group

MINUTE = 60_000_000
SLICES_PER_TOLERANCE = 16


@dataclass(frozen=True)
class Lookup:
    """Rows of ``phase`` matched to the driving rows within ``minutes`` (exclusive)."""

    suffix: str
    phase: str
    minutes: float


BACKWARD = (Lookup("takeoff", "take-off", 55), Lookup("climb", "climb", 30))
FORWARD = (Lookup("climb", "climb", 30), Lookup("cruise", "cruise", 55))


def phase_asof(
    df: DataFrame,
    driver: str = "cruise",
    lookups: Sequence[Lookup] = BACKWARD,
    forward: bool = False,
    keys: Sequence[str] = S.INSTALLATION,
    time: str = S.TIME,
    value: str = "row_sum",
    driver_suffix: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Nearest strictly earlier (later) report of each lookup phase.

    Only the single nearest report is tested against the tolerance. Since a
    match never lies further away than that, time is cut into slices of 16
    tolerances and each lookup row near a slice border is copied over it: one
    shuffle on (installation, slice) for all phases, and an installation of any
    size spreads over its slices. A slice that is heavy itself is cut into ranges
    with the last lookup of each carried on (``nearest_events``). ``bounded`` says
    that the rows per installation are known to be few.
    """
    suffix = driver_suffix or driver.replace("-", "")
    reach = int(max(x.minutes for x in lookups) * MINUTE)
    width = reach * SLICES_PER_TOLERANCE
    us, home = F.col("__us"), F.col("__home")
    known = reduce(lambda a, b: a & b, [bt(k).isNotNull() for k in keys])
    wanted = [driver, *[x.phase for x in lookups]]
    base = (df.where(known & bt(S.PHASE).isin(wanted))
            .select(*map(bt, keys), bt(S.PHASE), bt(time), bt(value), micros(time).alias("__us"))
            .withColumn("__home", slice_of(us, width)))
    offset = F.pmod(us, F.lit(width))
    near = offset < reach if forward else offset >= width - reach
    other = home - 1 if forward else home + 1
    slices = F.when((bt(S.PHASE) != driver) & near, F.array(home, other)).otherwise(F.array(home))
    spread = base.withColumn("__slice", F.explode(slices))
    event = F.struct(us.alias("us"), bt(time).alias("time"), bt(value).alias("value"))
    events = {f"__{x.suffix}": F.when((bt(S.PHASE) == x.phase) & us.isNotNull(), event) for x in lookups}
    hits = nearest_events(spread, [*keys, "__slice"], "__us", events, forward, bounded).where(bt(S.PHASE) == driver)
    times = {suffix: bt(time)}
    values = {suffix: bt(value)}
    for x in lookups:
        hit = F.col(f"__{x.suffix}")
        close = F.abs(us - hit["us"]) < F.lit(int(x.minutes * MINUTE))
        times[x.suffix] = F.when(close, hit["time"])
        values[x.suffix] = F.when(close, hit["value"])
    first = [x.suffix for x in lookups]
    names = [suffix, *first] if forward else [*first, suffix]
    return hits.select(
        *map(bt, keys),
        *[times[n].alias(f"{time}_{n}") for n in names],
        *[values[n].alias(f"{value}_{n}") for n in names],
    )


def phase_asof_forward(df: DataFrame, lookups: Sequence[Lookup] = FORWARD, **kw) -> DataFrame:
    """Take-off driven: nearest later climb and cruise report."""
    return phase_asof(df, "take-off", lookups, forward=True, **kw)


def next_report(
    df: DataFrame, driver: Column, target: Column, name: str, keys: Sequence[str],
    us: str, payload: Sequence[str], slice_hours: int = 24, bounded: bool = False,
) -> DataFrame:
    """Add ``name``: the next target row strictly after each driver row, at any distance.

    Within a time slice ``nearest_events`` finds it; beyond, the earliest target
    of the following slices does, taken from one row per (key, slice).
    """
    width = slice_hours * 60 * MINUTE
    event = F.struct(bt(us).alias("us"), *[bt(c) for c in payload])
    sliced = df.withColumn("__slice", slice_of(bt(us), width))
    inside = nearest_events(
        sliced, [*keys, "__slice"], us, {"__in": F.when(target, event)}, forward=True, bounded=bounded)
    firsts = sliced.groupBy(*map(bt, keys), "__slice").agg(F.min(F.when(target, event)).alias("__first"))
    later = (Window.partitionBy(*map(bt, keys)).orderBy(F.col("__slice").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    after = firsts.withColumn("__after", F.min("__first").over(later)).drop("__first")
    joined = inside.join(after, [*keys, "__slice"], "left")
    hit = F.when(driver, F.coalesce(F.col("__in"), F.col("__after")))
    return joined.withColumn(name, hit).drop("__in", "__after", "__slice")


def phase_asof_chain(
    df: DataFrame,
    span_minutes: float = 60,
    keys: Sequence[str] = S.INSTALLATION,
    time: str = S.TIME,
    value: str = "row_sum",
) -> DataFrame:
    """take-off -> next climb -> next cruise after that climb; a total span
    above ``span_minutes`` voids both matches."""
    known = reduce(lambda a, b: a & b, [bt(k).isNotNull() for k in keys])
    base = df.where(known & bt(time).isNotNull()).select(
        *map(bt, keys), bt(S.PHASE), bt(time), bt(value), micros(time).alias("__us"))
    is_phase = lambda p: bt(S.PHASE) == p
    few = heavy_keys(base, keys) is None  # then no slice is heavy either
    climbs = next_report(
        base, is_phase("climb"), is_phase("cruise"), "__cruise", keys, "__us", [time, value], bounded=few)
    chain = next_report(
        climbs, is_phase("take-off"), is_phase("climb"), "__climb", keys, "__us", [time, value, "__cruise"], bounded=few)
    climb, cruise = F.col("__climb"), F.col("__climb.__cruise")
    short = F.coalesce((cruise["us"] - F.col("__us")) <= F.lit(int(span_minutes * MINUTE)), F.lit(True))
    return chain.where(is_phase("take-off")).select(
        *map(bt, keys),
        bt(time).alias(f"{time}_takeoff"),
        F.when(short, climb[time]).alias(f"{time}_climb"),
        F.when(short, cruise[time]).alias(f"{time}_cruise"),
        bt(value).alias(f"{value}_takeoff"),
        F.when(short, climb[value]).alias(f"{value}_climb"),
        F.when(short, cruise[value]).alias(f"{value}_cruise"),
    )


def alert_flag(df: DataFrame, min_exceedances: int = 3, time: str = "reportdatetime_takeoff") -> DataFrame:
    """DN_FIRE iff all three phases reach ``min_exceedances``."""
    sums = [bt(f"row_sum_{p}") for p in ("takeoff", "climb", "cruise")]
    fire = reduce(lambda a, b: a & b, [F.coalesce(s >= min_exceedances, F.lit(False)) for s in sums])
    return df.withColumns({
        "merge_sum": F.when(fire, sums[0] + sums[1] + sums[2]),
        "DN_FIRE": F.when(fire, F.lit("YES")).otherwise(F.lit("NO")),
        "DN_FIRE_TIME": F.when(fire, F.date_format(bt(time), "yyyy-MM-dd HH:mm:ss")),
    })


def alert_summary(
    df: DataFrame, keys: Sequence[str] = S.INSTALLATION, time: str = "reportdatetime_takeoff"
) -> DataFrame:
    """Per installation: fired or not, how often, first and last alert."""
    fired = bt("DN_FIRE") == "YES"
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    known = reduce(lambda a, b: a & b, [bt(k).isNotNull() for k in keys])
    # Only fixed-width buffers, so this stays a hash aggregate on both sides of the shuffle.
    found = df.where(known).groupBy(*map(bt, keys)).agg(
        F.count(F.when(fired, 1)).alias("__n"),
        F.min(F.when(fired, bt(time))).alias("__first"), F.max(F.when(fired, bt(time))).alias("__last"))
    return found.select(
        *map(bt, keys),
        F.when(F.col("__n") > 0, "YES").otherwise("NO").alias("DN_FIRED"), F.col("__n").alias("DN_FIRES"),
        stamp(F.col("__first")).alias("First DN fire"), stamp(F.col("__last")).alias("Last DN fire"))


VALID_SETS = ((53, 54, 52), (53, 52), (53, 54), (54, 52))


def report_ref_set(
    df: DataFrame,
    keys: Sequence[str] = S.INSTALLATION,
    code: str = "DSCID",
    time: str = S.TIME,
    valid: Sequence[Sequence] = VALID_SETS,
    span_minutes: float = 60,
) -> DataFrame:
    """Tag all rows of a group with its first time if its set of codes is valid
    and it spans less than ``span_minutes``."""
    codes = sorted({c for s in valid for c in s})
    aggs = {f"__has{i}": F.max(F.when(bt(code) == c, 1).otherwise(0)) for i, c in enumerate(codes)}
    aggs["__other"] = F.max(F.when(bt(code).isin(codes), 0).otherwise(1))
    aggs |= {"__t0": F.min(bt(time)), "__u0": F.min(micros(time)), "__u1": F.max(micros(time))}
    one_of = F.lit(False)
    for s in valid:
        exact = F.col("__other") == 0
        for i, c in enumerate(codes):
            exact = exact & (F.col(f"__has{i}") == (1 if c in s else 0))
        one_of = one_of | exact
    short = (F.col("__u1") - F.col("__u0")) < F.lit(int(span_minutes * MINUTE))
    return with_group(df, keys, aggs).withColumn(
        "report_ref", F.when(one_of & short, F.col("__t0"))).drop(*aggs)


def report_ref_seq(
    df: DataFrame,
    keys: Sequence[str] = S.INSTALLATION,
    code: str = "DSCID",
    time: str = S.TIME,
    ties: Sequence[str] = (),
    triples: Sequence[Sequence] = ((53, 54, 52),),
    pairs: Sequence[Sequence] = ((53, 54), (53, 52), (54, 52)),
    triple_minutes: float = 120,
    pair_minutes: float = 60,
) -> DataFrame:
    """As ``report_ref_set`` on the time-ordered codes of 2- and 3-row groups;
    rows of any other group size keep their own time."""
    stats = {"__n": F.count(F.lit(1)), "__t0": F.min(bt(time)),
             "__u0": F.min(micros(time)), "__u1": F.max(micros(time))}
    sized = with_group(df, keys, stats)
    small = F.col("__n").isin(2, 3)
    # Only groups of two or three rows meet again, so no key can be heavy here.
    w = (Window.partitionBy(*map(bt, keys)).orderBy(bt(time), *map(bt, ties))
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    seq = sized.where(small).select("*", *[F.nth_value(bt(code), i).over(w).alias(f"__c{i}") for i in (1, 2, 3)])

    def is_one(sequences, n) -> Column:
        ok = F.lit(False)
        for s in sequences:
            ok = ok | reduce(lambda a, b: a & b, [F.col(f"__c{i + 1}") == c for i, c in enumerate(s)])
        return (F.col("__n") == n) & ok

    span = F.col("__u1") - F.col("__u0")
    good = ((is_one(triples, 3) & (span <= int(triple_minutes * MINUTE)))
            | (is_one(pairs, 2) & (span <= int(pair_minutes * MINUTE))))
    tagged = seq.withColumn("report_ref", F.when(good, F.col("__t0")))
    rest = sized.where(~small).withColumn("report_ref", bt(time))
    cols = [*map(bt, df.columns), F.col("report_ref")]
    return tagged.select(*cols).unionByName(rest.select(*cols))


COMBINED = ("ESN", "operator", "ACID", "ENGPOS", "DSCID", S.TIME, "row_sum")


def combine_phases(df: DataFrame, columns: Sequence[str] = COMBINED) -> DataFrame:
    """The columns of the alert stage, all phases stacked."""
    return df.select(*map(bt, columns))


def common_installations(
    df: DataFrame, keys: Sequence[str] = S.INSTALLATION, phases: Sequence[str] = S.PHASES
) -> DataFrame:
    """Installations that report in every phase; null keys never qualify."""
    known = reduce(lambda a, b: a & b, [bt(k).isNotNull() for k in keys])
    seen = {f"__p{i}": F.max(F.when(bt(S.PHASE) == p, 1).otherwise(0)) for i, p in enumerate(phases)}
    all_seen = reduce(lambda a, b: a & b, [F.col(n) == 1 for n in seen])
    return (df.where(known).groupBy(*map(bt, keys)).agg(*[v.alias(n) for n, v in seen.items()])
            .where(all_seen).drop(*seen))
