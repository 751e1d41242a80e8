"""Token ids as Parquet lists in ascending document order.

Files hold ``doc_id``, ``range``, ``range_start``, ``n_tokens`` and ``ids``.
Sorted numbers are delta encoded, ids dictionary encoded; row groups are small
and every page is in the column and offset index, so that a reader of some
documents, or of the counts only, touches few pages. A range is one sorted
file; the place of a document in the whole stream is the sum of the ranges
before it plus ``range_start``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleethealth.llm.store import range_starts, ranged, small_batches
from fleethealth.llm.tokens import id_lists, tokenizer

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("range", T.IntegerType()),
    T.StructField("range_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
])
#: Fixed values of the file layout; every one is a setting of the Parquet writer.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#range_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "1000",
    "compression": "zstd",
}


def encode(df: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``SCHEMA`` in ascending key order, ``end_id`` behind each text.

    Null text is empty; null keys come first; rows of one key are ordered by
    the hash of their text.
    """
    slim = small_batches(df).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = ranged(slim, [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]).select(
        "doc_id", F.spark_partition_id().alias("range"), "text")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = tokenizer(path), 0
        for batch in batches:
            encoded = [words.encode(x) + end for x in batch["text"].to_pylist()]
            sizes = np.array([len(x) // 4 for x in encoded], dtype=np.int64)
            before = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["range"], pa.array(before), pa.array(sizes), id_lists(encoded)],
                names=SCHEMA.names)

    return rows.mapInArrow(run, SCHEMA)


def write(df: DataFrame, folder: str, path: str, end_id: int, **columns: str) -> None:
    encode(df, path, end_id, **columns).write.options(**LAYOUT).parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The files with ``start``, the number of ids of all documents before.

    Selecting no ``ids`` reads no ids; filters on ``doc_id`` skip pages.
    """
    rows = spark.read.schema(SCHEMA).parquet(folder)
    starts = range_starts(rows.select(F.col("range").alias("__range"), "n_tokens"), F.sum("n_tokens"))
    return rows.join(F.broadcast(starts), F.col("range") == F.col("__range")).select(
        "doc_id", (F.col("__before") + F.col("range_start")).alias("start"), "n_tokens", "ids")


def digest(read_back: DataFrame) -> DataFrame:
    """Checksum of the ids as they came from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            at = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy().astype("<u4", copy=False))).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_back.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
