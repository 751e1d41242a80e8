"""Increments and history: dedup, newest-n, merge, append, retention."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth import schema as S
from fleethealth.functions import bt, micros, slice_of
from fleethealth.operators.skew import first_n, running_sum


def latest_n(
    df: DataFrame, n: int = 650, keys: Sequence[str] = S.ENGINE, order: Sequence[str] = S.ENGINE_ORDER,
    bounded: bool = False,
) -> DataFrame:
    """Newest ``n`` rows per key."""
    return first_n(df, keys, [bt(c).desc() for c in order], n, bounded=bounded)


def latest_n_clean(
    df: DataFrame, n: int, keys: Sequence[str] = S.ENGINE, order: Sequence[str] = S.ENGINE_ORDER
) -> DataFrame:
    """As ``latest_n`` after dropping null keys / times and exact duplicates."""
    return latest_n(dedup_rows(df.dropna("any", subset=[*keys, order[0]])), n, keys, order)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates; aggregated map-side, so copies never travel."""
    return df.dropDuplicates()


def dedup_keep(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``prefer``.

    ``row_number = 1`` is limited in each map task, so a key with a huge number
    of copies sends one row per task.
    """
    w = Window.partitionBy(*map(bt, keys)).orderBy(*prefer)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def union_by_name(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_keep_history(
    history: DataFrame, new: DataFrame, columns: Sequence[str], prefer: Sequence[Column] = ()
) -> DataFrame:
    """history + new; of rows equal in ``columns`` the history row stays."""
    both = union_by_name(history.withColumn("__src", F.lit(0)), new.withColumn("__src", F.lit(1)))
    return dedup_keep(both, columns, [F.col("__src"), *prefer]).drop("__src")


def dedup_report_key(
    stored: DataFrame, fresh: DataFrame, keys: Sequence[str] = S.REPORT_KEY, prefer: Sequence[Column] = ()
) -> DataFrame:
    """One row per report key, the stored version wins."""
    return dedup_keep_history(stored, fresh, keys, prefer)


def merged(history: DataFrame | None, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """History plus new rows, complete rows only, deduplicated."""
    if history is None:
        return new.dropna("any", subset=list(columns)).dropDuplicates(list(columns))
    complete = [d.dropna("any", subset=list(columns)) for d in (history, new)]
    return dedup_keep_history(*complete, columns=columns)


def unseen(stored: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Complete rows of ``new``, each once, that equal no row of ``stored`` in ``columns``.

    One hash aggregate over both: no sort, and nothing of ``stored`` but these columns travels.
    """
    complete = [d.select(*map(bt, columns)).dropna("any").withColumn("__src", F.lit(src)) for src, d in enumerate((new, stored))]
    rows = union_by_name(*complete).groupBy(*map(bt, columns)).agg(F.max("__src").alias("__src"))
    return rows.where(F.col("__src") == 0).drop("__src")


def newest(df: DataFrame, n: int, keys: Sequence[str] = S.ENGINE, order: Sequence[str] = S.ENGINE_ORDER, bounded: bool = False) -> DataFrame:
    """As ``latest_n``, where mostly nothing is to cut: a keys-only count comes first."""
    longer = df.groupBy(*map(bt, keys)).count().where(F.col("count") > n)
    return df if longer.isEmpty() else latest_n(df, n, keys, order, bounded)


def merge_history(
    history: DataFrame | None,
    new: DataFrame,
    columns: Sequence[str],
    n: int = 650,
    keys: Sequence[str] = S.ENGINE,
    order: Sequence[str] = S.ENGINE_ORDER,
    bounded: bool = False,
) -> DataFrame:
    """History plus new rows, complete rows only, deduplicated, newest ``n``.

    Duplicates go before the cut, so they do not use up the budget of ``n``.
    """
    return latest_n(merged(history, new, columns), n, keys, order, bounded)


def append_unique(base: DataFrame, new: DataFrame, time: str = S.TIME) -> DataFrame:
    """Rows of ``new`` (aligned to ``base``) not yet present, with a valid time."""
    aligned = new.select(*[bt(c).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    fresh = aligned.where(bt(time).isNotNull()).distinct()
    b, f = base.distinct().alias("b"), fresh.alias("f")
    same = reduce(lambda x, y: x & y, [F.col(f"f.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in base.columns])
    return base.unionByName(f.join(b, same, "left_anti"))


def append_dedup_normalized(base: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """Append, then keep the first of rows equal after trim + lower-case."""
    both = base.withColumn("__src", F.lit(0)).unionByName(new.withColumn("__src", F.lit(1)))
    cells = {f"__n_{c}": F.lower(F.trim(bt(c).cast("string"))) for c in base.columns}
    kept = dedup_keep(both.withColumns(cells), list(cells), [F.col("__src"), *map(bt, order)])
    return kept.drop("__src", *cells)


def row_bytes(columns: Sequence[str]) -> Column:
    """Bytes of a row as delimited text: cells plus one separator each."""
    sizes = [F.coalesce(F.octet_length(bt(c).cast("string")), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, sizes, F.lit(len(columns))).cast("long")


def retain_within_bytes(
    df: DataFrame, limit: int, time: str = S.TIME, ties: Sequence[str] = (), size: Column | None = None
) -> DataFrame:
    """Drop the oldest rows until the rest fits ``limit`` bytes.

    Sizes are totalled per day; only the one day in which the budget runs out
    is totalled per second, and only that second is cumulated row by row, in
    chunks if it is hot. The two total tables are bounded by the calendar, never by the rows.
    """
    sized = (df.where(bt(time).isNotNull())
             .withColumn("__bytes", row_bytes(df.columns) if size is None else size)
             .withColumn("__us", micros(time)))
    drop = ["__bytes", "__us"]
    day, second = (slice_of(F.col("__us"), w) for w in (86_400_000_000, 1_000_000))
    cut_day, used_days = _cut(sized, day, limit)
    if cut_day is None:
        return sized.drop(*drop)
    newer, inside = sized.where(day > cut_day), sized.where(day == cut_day)
    cut_second, used_seconds = _cut(inside, second, limit - used_days)
    # One second may hold very many rows, so even this sum is cut into chunks if need be.
    order = [bt(time).desc(), *[bt(c).desc() for c in ties]]
    alone = inside.where(second == cut_second).withColumn("__second", second)
    last = (running_sum(alone, ["__second"], order, {"__sum": F.col("__bytes")})
            .where(F.col("__sum") <= limit - used_days - used_seconds).drop("__sum", "__second"))
    return newer.unionByName(inside.where(second > cut_second)).unionByName(last).drop(*drop)


def _cut(df: DataFrame, bucket: Column, limit: int) -> tuple[int | None, int]:
    """Newest bucket in which the running size passes ``limit``, and the size of all newer ones."""
    totals = df.groupBy(bucket.alias("b")).agg(F.sum("__bytes").alias("n"))
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    over = (totals.withColumn("upto", F.sum("n").over(w)).where(F.col("upto") > limit)
            .orderBy(F.col("b").desc()).first())
    return (None, 0) if over is None else (over["b"], over["upto"] - over["n"])
