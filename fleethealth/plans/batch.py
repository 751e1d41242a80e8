"""One batch run: checkpoint, scan, chain, outputs, next checkpoint."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from fleethealth import schema as S
from fleethealth.plans.store import FleetStore
from fleethealth.sources import reports as R
from fleethealth.sources.state import low_watermark

RUN_SCHEMA = T.StructType([
    T.StructField("run", T.LongType()), T.StructField("checkpoint", T.TimestampNTZType()),
    T.StructField("folder", T.StringType())])
SUMMARY_NAMES = {"First DN fire": "first_fire", "Last DN fire": "last_fire"}


def last_run(spark: SparkSession, root: str) -> Row | None:
    """Number, checkpoint and folder of the last run that ended."""
    try:
        return spark.read.schema(RUN_SCHEMA).parquet(f"{root}/runs").orderBy(F.desc("run")).first()
    except Exception as e:  # no run yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def store_of(spark: SparkSession, root: str, settings: S.Settings = S.Settings()) -> FleetStore:
    """History and flights of all runs; a run's number is its version."""
    return FleetStore(spark, f"{root}/store", settings)


def run_batch(
    spark: SparkSession, reports: DataFrame, signatures: DataFrame, root: str, settings: S.Settings = S.Settings(),
) -> Row:
    """Read what came since the checkpoint (inclusively, so late halves of a pair
    are met again), run the chain on it and the stored history of its engines,
    store the result, write the summary below ``root`` and record the next checkpoint.

    The record is written last: a run that fails is done again by the next one
    and leaves nothing that is read.
    """
    before = last_run(spark, root)
    run = 1 if before is None else before["run"] + 1
    mark = None if before is None else before["checkpoint"]
    new = reports if mark is None else R.since_checkpoint(reports, mark, mark)
    folder = f"{root}/run-{run:06d}-{uuid.uuid4().hex[:8]}"
    store = store_of(spark, root, settings)
    store.apply(new, signatures, run, None if before is None else before["run"], mark)
    store.summary(run).withColumnsRenamed(SUMMARY_NAMES).write.parquet(f"{folder}/summary")
    mark = low_watermark(new).first()["checkpoint"] or mark
    spark.createDataFrame([(run, mark, folder)], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return last_run(spark, root)
