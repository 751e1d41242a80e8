"""Structured Streaming entry points.

Row-count windows are not available on streams, so the chain runs inside
``foreachBatch`` on the micro-batch plus the stored history of its engines; pairs,
phase matches and engine buffers are keyed state (``stateful``), dedup is a plain
streaming operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fleethealth import schema as S
from fleethealth.plans.store import FleetStore
from fleethealth.streaming import state
from fleethealth.streaming.stateful import EVENT_TIME, paired_stream, timed


def start_incremental(
    source: DataFrame, root: str, signatures: DataFrame, settings: S.Settings = S.Settings(context="history"),
    delay: str = "1 day", buckets: int = 64,
) -> StreamingQuery:
    """Run the full chain on each micro-batch; ``FleetStore(spark, root, ...)`` holds
    history, flights and summary, a version per micro-batch.

    The halves of a pair may come in different micro-batches and in any order:
    they wait up to ``delay``. What a pair's reports change behind them is scored
    and matched again.
    """
    def increment(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        store = FleetStore(batch.sparkSession, root, settings, buckets)
        store.apply(batch, signatures, batch_id, batch_id - 1 if batch_id else None)
        batch.unpersist()

    halves = paired_stream(source, delay)
    with state.state_partitions(source.sparkSession):
        return (halves.writeStream.foreachBatch(increment)
                .option("checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start())


def dedup_stream(
    source: DataFrame, keys: Sequence[str], time: str = S.TIME, delay: str = "14 days"
) -> DataFrame:
    """Drop repeated reports that arrive within ``delay`` of each other.

    State is kept per key only until the watermark passes.
    """
    return timed(source, time, delay).dropDuplicatesWithinWatermark(list(keys)).drop(EVENT_TIME)
