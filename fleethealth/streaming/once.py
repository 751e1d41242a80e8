"""Reports of several sources, each exactly once, however late a repeat or a first delivery comes.

Watermarked dedup forgets a key when the watermark passes and drops whatever comes
later, a first delivery too. Here the keys of all reports stay in a table of report
days, and each micro-batch is checked against the days that it names: first by a
Bloom filter of the micro-batch's keys in the scan, then by an exact join. The work
of a micro-batch follows its rows and the days they are of, not the age of the stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from fleethealth import schema as S
from fleethealth.functions import bt
from fleethealth.operators.membership import bits_for, key_filter, may_contain

SOURCE = "__source"
BATCH, DAY = "__batch", "__day"
MAX_DAYS = 1000  # a micro-batch of more days reads all of them

MARKS = T.StructType([T.StructField(SOURCE, T.StringType()), T.StructField("newest", T.TimestampNTZType())])


@dataclass(frozen=True)
class OnceStore:
    """Rows, keys and marks of the micro-batches, one folder each.

    A micro-batch that is done again replaces its own folders and looks at earlier
    ones only, so it finds the same rows. ``schema`` is that of the reports without
    the source, ``keys`` tell one report from another; ``time`` need not be a key,
    but a repeat must carry the same time.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str]
    time: str = S.TIME

    def _names(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, self.time]))

    def rows(self, last: int) -> DataFrame:
        """All reports up to micro-batch ``last``, each once."""
        plain = T.StructType([*self.schema.fields, T.StructField(BATCH, T.IntegerType())])
        return self.spark.read.schema(plain).parquet(f"{self.root}/rows").where(bt(BATCH) <= last).drop(BATCH)

    def stored_keys(self, before: int) -> DataFrame:
        """Keys of the micro-batches before ``before``, with the day of the report."""
        fields = [self.schema[n] for n in self._names()]
        if before <= 0:
            return self.spark.createDataFrame([], T.StructType([*fields, T.StructField(DAY, T.DateType())]))
        plain = T.StructType([*fields, T.StructField(BATCH, T.IntegerType()), T.StructField(DAY, T.DateType())])
        return self.spark.read.schema(plain).parquet(f"{self.root}/keys").where(bt(BATCH) < before).drop(BATCH)

    def repeats(self, batch: DataFrame, before: int) -> DataFrame:
        """Keys of ``batch``, which has one row of each, that an earlier micro-batch stored."""
        days = [r[DAY] for r in batch.select(self._day()).distinct().limit(MAX_DAYS + 1).collect()]
        stored = self.stored_keys(before)
        if len(days) <= MAX_DAYS:
            known = bt(DAY).isin([d for d in days if d is not None])
            stored = stored.where(known | bt(DAY).isNull() if None in days else known)
        bits = bits_for(batch.count())
        words = key_filter(batch, self._names(), bits).scalar()
        near = stored.where(may_contain(words, [bt(n) for n in self._names()], bits)).drop(DAY)
        asked = batch.select(*[bt(n).alias(f"__k_{n}") for n in self._names()])
        return asked.join(near, self._same(), "left_semi")

    def apply(self, batch: DataFrame, version: int) -> None:
        """Store the new reports of ``batch`` (with a column ``__source``) as micro-batch ``version``.

        Of rows with one key in a micro-batch the least by its other columns stays,
        whichever source it is of. Newest times count all rows, before any is dropped.
        """
        batch = batch.persist()
        first = F.min(F.struct(*[bt(c) for c in self.schema.names if c not in self._names()], bt(SOURCE))).alias("__first")
        once = batch.groupBy(*map(bt, self._names())).agg(first).select(*map(bt, self._names()), "__first.*")
        once = once.select(*map(bt, self.schema.names)).persist()
        fresh = once.join(self.repeats(once, version), self._same(), "left_anti") if version else once
        rows = f"{self.root}/rows/{BATCH}={version}"
        fresh.write.mode("overwrite").parquet(rows)
        written = self.spark.read.schema(self.schema).parquet(rows)
        # Files of one day each; a day with many reports is split, small ones are joined.
        (written.select(*map(bt, self._names()), self._day()).hint("rebalance", bt(DAY))
         .write.mode("overwrite").partitionBy(DAY).parquet(f"{self.root}/keys/{BATCH}={version}"))
        newest = batch.groupBy(bt(SOURCE)).agg(F.max(bt(self.time)).alias("newest"))
        (self.marks(version - 1).unionByName(newest).groupBy(SOURCE).agg(F.max("newest").alias("newest"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/{version:08d}"))
        once.unpersist()
        batch.unpersist()

    def marks(self, version: int) -> DataFrame:
        """Newest time of every source heard of so far, a row per source."""
        if version < 0:
            return self.spark.createDataFrame([], MARKS)
        return self.spark.read.schema(MARKS).parquet(f"{self.root}/marks/{version:08d}")

    def low_watermark(self, version: int, sources: Sequence[str]) -> DataFrame:
        """Next checkpoint: the least of the sources' newest times, null while one is silent."""
        known = self.marks(version).where(bt(SOURCE).isin(list(sources)))
        heard = F.count("newest") == len(set(sources))
        return known.agg(F.when(heard, F.min("newest")).alias("checkpoint"))

    def _day(self) -> Column:
        return bt(self.time).cast("date").alias(DAY)

    def _same(self) -> Column:
        return reduce(lambda a, b: a & b, [bt(f"__k_{n}").eqNullSafe(bt(n)) for n in self._names()])


def start_once(
    sources: Mapping[str, DataFrame], root: str, keys: Sequence[str], time: str = S.TIME
) -> tuple[StreamingQuery, OnceStore]:
    """Read all ``sources`` (name -> stream of the same columns) as one and keep each report once.

    No source waits for another: a late row is taken whenever it comes. What a
    checkpoint may move to is ``OnceStore.low_watermark``.
    """
    streams = [s.withColumn(SOURCE, F.lit(n)) for n, s in sources.items()]
    union = reduce(lambda a, b: a.unionByName(b), streams)
    store = OnceStore(union.sparkSession, root, T.StructType([f for f in union.schema.fields if f.name != SOURCE]), tuple(keys), time)
    query = (union.writeStream.foreachBatch(lambda batch, i: store.apply(batch, i))
             .option("checkpointLocation", f"{root}/_stream").trigger(availableNow=True).start())
    return query, store
