"""Windows, ranks and group aggregates that survive a hot key.

A Spark window gathers one key into one task. That is the plan we want while
keys are small, so each operator first asks ``heavy_keys`` which keys hold more
than hotKeyRows rows, whatever the size of the table. Usually there are none and
the plain one-shuffle plan runs. A list of up to 1000 keys is broadcast, a longer
one is joined by a shuffle. Rows of a heavy key take an exact detour that splits
the key over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth.functions import bt, slice_of
from fleethealth.session import ensure_checkpoint_dir

HOT_ROWS_CONF = "spark.fleethealth.hotKeyRows"
DEFAULT_HOT_ROWS = 1_000_000
HASH_BUCKETS = 4096
MAX_BROADCAST_KEYS = 1000

CHUNK = "__chunk"
HALO = "__halo"
_POS = "__pos"
_MID = "__mid"
_MID_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


@dataclass(frozen=True)
class Heavy:
    """Heavy keys (columns prefixed ``__h_``) and how many there are."""

    keys: DataFrame
    count: int

    def hint(self, df: DataFrame) -> DataFrame:
        """Broadcast a table of about one row per heavy key if they are few."""
        return F.broadcast(df) if self.count <= MAX_BROADCAST_KEYS else df


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> Heavy | None:
    """Keys with more rows than the limit, or None.

    First pass: row counts of 4096 hash buckets, a map-side aggregate whose
    shuffle is a few kB per task. A key cannot be heavy unless its bucket is;
    only rows of such buckets are counted per key.
    """
    hashed = df.select(F.pmod(F.xxhash64(*map(bt, keys)), F.lit(HASH_BUCKETS)).alias("b"), *map(bt, keys))
    limit = hot_rows(df)
    suspects = [r["b"] for r in hashed.groupBy("b").count().where(F.col("count") > limit).collect()]
    if not suspects:
        return None
    heavy = (
        hashed.where(F.col("b").isin(suspects))
        .groupBy(*map(bt, keys)).agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > limit)
        .select(*[bt(k).alias(f"__h_{k}") for k in keys])
    )
    rows = heavy.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not rows:
        return None
    if len(rows) <= MAX_BROADCAST_KEYS:
        return Heavy(df.sparkSession.createDataFrame(rows, heavy.schema), len(rows))
    ensure_checkpoint_dir(df.sparkSession)
    kept = heavy.checkpoint()
    return Heavy(kept, kept.count())


def _matches(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [bt(k).eqNullSafe(bt(f"__h_{k}")) for k in keys])


def split_heavy(df: DataFrame, keys: Sequence[str], hot: Heavy) -> tuple[DataFrame, DataFrame]:
    cond = _matches(keys)
    return (
        df.join(hot.hint(hot.keys), cond, "left_anti"),
        df.join(hot.hint(hot.keys), cond, "left_semi"),
    )


def _sorted_ranges(df: DataFrame, sort: Sequence[Column]) -> tuple[DataFrame, Column, Column]:
    """Rows in sorted ranges, the number of a row's range and its index there.

    Range partitions are even however the rows are spread over keys and times;
    rows equal in ``sort`` share one. The sorted rows are checkpointed: numbers
    then survive a lost executor, and all reads see the same ranges.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn(_MID, F.monotonically_increasing_id())
        .checkpoint()
    )
    return ranged, F.shiftright(F.col(_MID), _MID_BITS), F.col(_MID).bitwiseAND(F.lit((1 << _MID_BITS) - 1))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], hot: Heavy) -> DataFrame:
    """0-based position of each row within its key, from a distributed sort."""
    ranged, pid, idx = _sorted_ranges(df, [bt(k) for k in keys] + list(order))
    # One row per (key, partition): at most partitions + keys rows.
    parts = ranged.groupBy(*map(bt, keys), pid.alias("__h_pid")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(idx).alias("__first")
    )
    w = Window.partitionBy(*map(bt, keys)).orderBy("__h_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *[bt(k).alias(f"__h_{k}") for k in keys], "__h_pid", "__first",
        F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__start"),
    )
    return (
        ranged.withColumn("__pid", pid)
        .join(hot.hint(starts), _matches(keys) & (F.col("__pid") == F.col("__h_pid")))
        .withColumn(_POS, F.col("__start") + idx - F.col("__first"))
        .drop("__pid", _MID, "__h_pid", "__first", "__start", *[f"__h_{k}" for k in keys])
    )


def nearest_events(
    df: DataFrame, keys: Sequence[str], us: str, events: dict[str, Column], forward: bool = False, bounded: bool = False
) -> DataFrame:
    """Add per name the latest event strictly before each row (``forward``: the
    earliest one after it) along ``us`` within ``keys``, at any distance.

    An event is a struct that starts with ``us``, null on rows that are none. A
    growing frame finds it with O(1) work per row. A heavy key is cut into sorted
    ranges of time: inside a range the frame does the same, the last event of each
    range is one row, and a scan over these rows carries the last one into the
    ranges behind. Rows of one microsecond stay in one range, so what is carried in is strictly earlier.
    """
    along = -bt(us) if forward else bt(us)
    pick = F.min if forward else F.max

    def inside(d: DataFrame, parts: Sequence[str]) -> DataFrame:
        w = Window.partitionBy(*map(bt, parts)).orderBy(along).rangeBetween(Window.unboundedPreceding, -1)
        return d.select("*", *[pick(e).over(w).alias(n) for n, e in events.items()])

    hot = None if bounded else heavy_keys(df, keys)
    if hot is None:
        return inside(df, keys)
    light, heavy = split_heavy(df, keys, hot)
    ranged, pid, _ = _sorted_ranges(heavy, [*map(bt, keys), along])
    ranged = ranged.withColumn("__pid", pid).drop(_MID)
    by = [bt(k).alias(f"__h_{k}") for k in keys]
    last = ranged.groupBy(*by, F.col("__pid").alias("__h_pid")).agg(*[pick(e).alias(n) for n, e in events.items()])
    w = (Window.partitionBy(*[bt(f"__h_{k}") for k in keys]).orderBy("__h_pid")
         .rowsBetween(Window.unboundedPreceding, -1))
    carried = last.select(
        *[bt(f"__h_{k}") for k in keys], "__h_pid", *[pick(bt(n)).over(w).alias(f"__c_{n}") for n in events])
    joined = inside(ranged, [*keys, "__pid"]).join(
        hot.hint(carried), _matches(keys) & (F.col("__pid") == F.col("__h_pid")))
    found = joined.select(*map(bt, df.columns), *[F.coalesce(bt(n), bt(f"__c_{n}")).alias(n) for n in events])
    return inside(light, keys).unionByName(found)


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], lookback: int, hot: Heavy) -> DataFrame:
    """Cut each key into equal chunks and prefix each with ``lookback`` halo rows."""
    rows = max(lookback + 1, hot_rows(df) // 4)
    pos = F.col(_POS)
    home = slice_of(pos, rows)
    spill = (pos % F.lit(rows)) >= F.lit(rows - lookback)
    homes = F.when(spill, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        number_rows(df, keys, order, hot)
        .withColumn("__home", home)
        .withColumn(CHUNK, F.explode(homes))
        .withColumn(HALO, F.col(CHUNK) != F.col("__home"))
        .drop("__home")
    )


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    lookback: int,
    fn: Callable[[DataFrame, list[str]], DataFrame],
    bounded: bool = False,
) -> DataFrame:
    """Apply row-preserving ``fn(df, partition_columns)`` to ordered series.

    ``fn`` may look back at most ``lookback`` rows. ``bounded`` says that the
    rows per key are known to be few (e.g. after ``latest_n``).
    """
    hot = None if bounded else heavy_keys(df, keys)
    if hot is None:
        return fn(df, list(keys))
    light, heavy = split_heavy(df, keys, hot)
    parts = fn(chunked(heavy, keys, order, lookback, hot), [*keys, CHUNK])
    done = parts.where(~F.col(HALO)).drop(CHUNK, HALO, _POS)
    return fn(light, list(keys)).unionByName(done)


def with_group(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Attach aggregates of each row's group."""
    w = Window.partitionBy(*map(bt, keys))
    hot = heavy_keys(df, keys)
    if hot is None:
        return df.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
    light, heavy = split_heavy(df, keys, hot)
    per_key = heavy.groupBy(*[bt(k).alias(f"__h_{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggs.items()])
    joined = heavy.join(hot.hint(per_key), _matches(keys)).drop(*[f"__h_{k}" for k in keys])
    return light.select("*", *[a.over(w).alias(n) for n, a in aggs.items()]).unionByName(joined)


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 64, bounded: bool = False
) -> DataFrame:
    """First ``n`` rows per key.

    ``row_number <= n`` is limited per map task before the shuffle. A heavy key
    is first cut to ``n`` rows in each of ``salts`` parts.
    """
    def limit(d: DataFrame, by: list[Column]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return d.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")

    by = [bt(k) for k in keys]
    hot = None if bounded else heavy_keys(df, keys)
    if hot is None:
        return limit(df, by)
    light, heavy = split_heavy(df, keys, hot)
    spread = heavy.withColumn("__salt", F.pmod(F.xxhash64(*map(bt, df.columns)), F.lit(salts)))
    cut = limit(limit(spread, [*by, F.col("__salt")]).drop("__salt"), by)
    return limit(light, by).unionByName(cut)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: dict[str, Column], bounded: bool = False
) -> DataFrame:
    """Cumulative sums along each series; a heavy key adds up chunk totals first."""
    def cumulate(d: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*map(bt, by)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return d.select("*", *[F.sum(c).over(w).alias(n) for n, c in columns.items()])

    hot = None if bounded else heavy_keys(df, keys)
    if hot is None:
        return cumulate(df, list(keys))
    light, heavy = split_heavy(df, keys, hot)
    parts = chunked(heavy, keys, order, 0, hot)
    totals = parts.groupBy(*[bt(k).alias(f"__h_{k}") for k in keys], F.col(CHUNK).alias("__h_c")).agg(
        *[F.sum(c).alias(f"__t_{n}") for n, c in columns.items()]
    )
    w = (Window.partitionBy(*[bt(f"__h_{k}") for k in keys]).orderBy("__h_c")
         .rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select(
        *[bt(f"__h_{k}") for k in keys], "__h_c",
        *[F.sum(bt(f"__t_{n}")).over(w).alias(f"__s_{n}") for n in columns],
    )
    inside = cumulate(parts, [*keys, CHUNK])
    joined = inside.join(starts, _matches(keys) & (F.col(CHUNK) == F.col("__h_c")))
    kept = [c for c in inside.columns if c not in columns and c not in (CHUNK, HALO, _POS)]
    done = joined.select(
        *map(bt, kept),
        *[F.coalesce(bt(f"__s_{n}") + bt(n), bt(f"__s_{n}"), bt(n)).alias(n) for n in columns],
    )
    return cumulate(light, list(keys)).unionByName(done)
