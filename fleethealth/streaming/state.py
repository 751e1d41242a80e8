"""Settings and working tables of foreachBatch jobs.

A micro-batch that is retried after a failure overwrites only its own tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[None]:
    """Number of state stores of a query started inside the block.

    It is fixed for the life of a query's checkpoint, so size it for the
    cluster: by default one per core. Each store costs a commit per micro-batch.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def version(root: str, batch_id: int, name: str) -> str:
    return f"{root}/v-{batch_id:08d}/{name}"


def save(df: DataFrame, root: str, batch_id: int, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write this batch's version and return it as read back (lineage ends here)."""
    path = version(root, batch_id, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

