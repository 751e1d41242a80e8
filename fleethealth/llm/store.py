"""Intermediate tables in the shared folder, and row numbers built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleethealth.session import scratch_dir


#: Rows of an Arrow batch; with texts of a few kB that is a few MB in every worker.
BATCH_ROWS = "2000"


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` itself, with the session set to Arrow batches of ``BATCH_ROWS``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    The lineage ends there: a lost executor re-reads files instead of running
    the stages before again, and every later read sees the same rows.
    """
    path = scratch_dir(df.sparkSession, name)
    small_batches(df).write.options(**{"compression": "zstd"} | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` dealt into sorted ranges of about equal size.

    Rows that tie in ``order`` are parted by where they were read, so that even
    one repeated key is spread over ranges.
    """
    keyed = df.withColumn("__read", F.monotonically_increasing_id())
    by = [*order, F.col("__read")]
    return keyed.repartitionByRange(*by).sortWithinPartitions(*by).drop("__read")


def numbered(df: DataFrame, order: Sequence[Column], name: str, number: str = "row") -> DataFrame:
    """Rows with their 0-based place in ``order``, without a single-task sort.

    Sorted ranges are written with the index inside the range; the offset of a
    range is the sum of the counts before it (one small row per range).
    """
    mid = F.monotonically_increasing_id()
    rows = staged(
        ranged(df, order).select(
            "*", F.shiftright(mid, 33).alias("__range"), mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("__at")),
        name)
    return rows.join(F.broadcast(range_starts(rows, F.count(F.lit(1)))), "__range").select(
        *df.columns, (F.col("__before") + F.col("__at")).alias(number))


def range_starts(rows: DataFrame, total: Column) -> DataFrame:
    """(__range, __before): what all earlier ranges hold. A row per range, so at
    most as many as there are partitions."""
    w = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("__range").agg(total.alias("__n"))
    return sizes.select("__range", F.coalesce(F.sum("__n").over(w), F.lit(0)).cast("long").alias("__before"))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int = 1) -> Iterator[pa.Table]:
    """Sorted Arrow batches regrouped so that no key spans two tables.

    Every yielded table has at least ``least`` rows except the last.
    """
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.num_rows
        if held < least:
            continue
        table = pa.Table.from_batches(kept)
        last = [table.column(k)[held - 1].as_py() for k in keys]
        cut = held - 1
        # Walk back in doubling steps: the last key's run is usually short.
        same = lambda i: [table.column(k)[i].as_py() for k in keys] == last
        step = 1
        while cut > 0 and same(max(cut - step, 0)):
            cut, step = max(cut - step, 0), step * 2
        while cut > 0 and same(cut - 1):
            cut -= 1
        if cut:
            yield table.slice(0, cut)
            kept = table.slice(cut).to_batches()
            held -= cut
    if held:
        yield pa.Table.from_batches(kept)
