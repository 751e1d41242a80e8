"""A table in hash buckets of which a version writes only those it changed.

``data/<version>/__bucket=<b>`` holds a bucket, a manifest per version names the
folder of every bucket. Readers ask for buckets, so a change to a few keys reads
and writes a few buckets; everything else stays where an earlier version put it.
A version counts when its manifest is there: one that failed before is not seen,
and doing it again replaces it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleethealth.functions import bt

BUCKET = "__bucket"
MANIFEST = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType())])


@dataclass(frozen=True)
class BucketStore:
    """``count`` bounds the manifest and the lists below; it is fixed for the life of the store."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str] = ("ESN",)
    count: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[bt(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.count)).cast("int")

    def touched(self, df: DataFrame) -> list[int]:
        """Buckets of the keys of ``df``: at most ``count`` numbers."""
        return sorted(r["b"] for r in df.select(self.bucket().alias("b")).distinct().collect())

    def manifest(self, version: int | None) -> dict[int, str]:
        if version is None or version < 0:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/{version:08d}").collect()
        return {r["bucket"]: r["folder"] for r in rows}

    def read(self, version: int | None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The given (or all) buckets as of ``version``; no other file is opened."""
        known = self.manifest(version)
        wanted = sorted(known) if buckets is None else sorted(set(buckets) & set(known))
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{known[b]}/{BUCKET}={b}" for b in wanted])

    def write(self, version: int, df: DataFrame, buckets: Sequence[int], before: int | None) -> None:
        """Replace ``buckets`` by the rows of ``df``, which are all theirs; the rest
        is as in version ``before``. Files are sorted by key, so that their
        statistics tell readers which keys they hold."""
        folder = f"{self.root}/data/{version:08d}-{uuid.uuid4().hex[:8]}"
        rows = df.select(*[bt(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).withColumn(BUCKET, self.bucket())
        (rows.repartition(bt(BUCKET)).sortWithinPartitions(BUCKET, *map(bt, self.keys))
         .write.partitionBy(BUCKET).parquet(folder))
        # A bucket without rows has no folder.
        full = [r[BUCKET] for r in self.spark.read.parquet(folder).select(BUCKET).distinct().collect()] if _exists(
            self.spark, folder, f"{BUCKET}=*") else []
        self._record(version, {b: f for b, f in self.manifest(before).items() if b not in set(buckets)} | {b: folder for b in full})

    def carry(self, version: int, before: int | None) -> None:
        """A version that changes nothing."""
        self._record(version, self.manifest(before))

    def _record(self, version: int, known: dict[int, str]) -> None:
        self.spark.createDataFrame(sorted(known.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/manifest/{version:08d}")

    def vacuum(self, *versions: int | None) -> int:
        """Delete data folders that none of ``versions`` names; how many."""
        used = {f.rsplit("/", 1)[-1] for v in versions for f in self.manifest(v).values()}
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        data = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        fs = data.getFileSystem(conf)
        if not fs.exists(data):
            return 0
        old = [f.getPath() for f in fs.listStatus(data) if f.getPath().getName() not in used]
        return sum(bool(fs.delete(p, True)) for p in old)


def delete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def _exists(spark: SparkSession, folder: str, pattern: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0
