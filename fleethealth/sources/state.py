"""Checkpoint times and output tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt

CHECKPOINT_SCHEMA = T.StructType([T.StructField("checkpoint", T.TimestampNTZType())])


def low_watermark(df: DataFrame, time: str = S.TIME) -> DataFrame:
    """Next checkpoint: the least of the phases' newest times (before filtering)."""
    newest = df.groupBy(bt(S.PHASE)).agg(F.max(bt(time)).alias("newest"))
    return newest.agg(F.min("newest").alias("checkpoint"))


def latest_timestamp(df: DataFrame, column: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Newest parseable time of a text column; an error if there is none."""
    parsed = F.try_to_timestamp(bt(column), F.lit(fmt)).cast("timestamp_ntz")
    found = df.agg(F.max(parsed).alias("latest"))
    nothing = F.raise_error(F.lit(f"no valid timestamp in {column}")).cast("timestamp_ntz")
    return found.select(F.coalesce(F.col("latest"), nothing).alias("latest"))


def read_checkpoint(spark: SparkSession, path: str) -> datetime | None:
    try:
        row = spark.read.schema(CHECKPOINT_SCHEMA).parquet(path).first()
    except Exception as e:  # no checkpoint written yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return row["checkpoint"] if row else None


def write_checkpoint(spark: SparkSession, path: str, value: datetime) -> None:
    spark.createDataFrame([(value,)], CHECKPOINT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def write_stage(df: DataFrame, path: str, sort_by: Sequence[str] = (S.TIME,), fmt: str = "parquet") -> str:
    """One folder per phase. Rows are sorted inside each task's files only."""
    out = df.sortWithinPartitions(S.PHASE, *[c for c in sort_by if c in df.columns])
    writer = out.write.partitionBy(S.PHASE).mode("errorifexists")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def tap(df: DataFrame, path: str) -> DataFrame:
    """Snapshot of a stage: written once, then read back, so later stages (and
    recomputation after a lost executor) start from the files."""
    write_stage(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_outputs(
    root: str, stage: DataFrame, match: Callable[[DataFrame], DataFrame], summarise: Callable[[DataFrame], DataFrame],
) -> dict[str, str]:
    """History per phase, matched flights and the alert summary.

    Each is written once and read back for the next, so nothing is computed twice.
    """
    paths = {n: f"{root}/{n}" for n in ("history", "merged", "summary")}
    spark = stage.sparkSession
    merged = match(tap(stage, paths["history"]))
    merged.write.mode("errorifexists").parquet(paths["merged"])
    summary = summarise(spark.read.schema(merged.schema).parquet(paths["merged"]))
    summary.write.mode("errorifexists").parquet(paths["summary"])
    return paths
