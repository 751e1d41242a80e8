"""The fleet's stored state: newest reports and matched flights, in engine buckets.

An increment reads the buckets of its engines, drops other engines' rows in the
scan or before any shuffle, runs the chain on what is left and replaces these
buckets. Its work follows the engines that report, not the fleet.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T

from fleethealth import schema as S
from fleethealth.functions import bt
from fleethealth.operators import phases, trend
from fleethealth.operators.history import newest
from fleethealth.plans import chain
from fleethealth.session import release
from fleethealth.sources.buckets import BucketStore, delete

FLIGHT = (*S.INSTALLATION, f"{S.TIME}_cruise")
_PHASES = ("takeoff", "climb", "cruise")
FLIGHT_SCHEMA = T.StructType(
    [T.StructField(c, S.column_type(c)) for c in S.INSTALLATION]
    + [T.StructField(f"{S.TIME}_{p}", T.TimestampNTZType()) for p in _PHASES]
    + [T.StructField(n, T.LongType()) for n in (*[f"row_sum_{p}" for p in _PHASES], "merge_sum")]
    + [T.StructField(n, T.StringType()) for n in ("DN_FIRE", "DN_FIRE_TIME")])


@dataclass(frozen=True)
class FleetStore:
    """Versions are numbered by the caller; ``before`` is the one to start from."""

    spark: SparkSession
    root: str
    settings: S.Settings
    buckets: int = 64

    def _store(self, name: str, schema: T.StructType) -> BucketStore:
        return BucketStore(self.spark, f"{self.root}/{name}", schema, ("ESN",), self.buckets)

    def _history(self) -> BucketStore:
        return self._store("history", S.stage_schema(self.settings))

    def _flights(self) -> BucketStore:
        return self._store("flights", FLIGHT_SCHEMA)

    def history(self, version: int) -> DataFrame:
        """The newest ``n_points`` rows of every engine and phase."""
        return self._history().read(version)

    def flights(self, version: int) -> DataFrame:
        """All flights so far, each as it was matched last."""
        return self._flights().read(version)

    def summary(self, version: int) -> DataFrame:
        """Alert summary of all flights so far."""
        return phases.alert_summary(self.flights(version))

    def apply(
        self, new: DataFrame, signatures: DataFrame, version: int, before: int | None, checkpoint: datetime | None = None
    ) -> None:
        """Score ``new`` against the stored rows of its engines and store the result.

        In history context all rows not stored yet are new, however late, and what
        they change behind them is scored again; in batch context those past the
        checkpoint are. Every flight with a new report is matched, before retention cuts any.
        """
        stored, flights = self._history(), self._flights()
        late = self.settings.context == "history"
        touched = stored.touched(new)
        if not touched:
            stored.carry(version, before)
            flights.carry(version, before)
            return
        work = f"{self.root}/work/{version:08d}"
        delete(self.spark, work)  # of an attempt that failed
        known = stored.manifest(before).keys() & set(touched)
        context, others = trend.rows_of_engines(stored.read(before, touched), new) if known else (None, None)
        spread = chain.check_spread(new)
        rows = chain.ingest(new, context, self.settings, checkpoint, spread, by_origin=late)
        if not (late and spread.engines and spread.pairs):  # more than one job reads them
            rows = self._written(rows, f"{work}/stages/ingested")
        stage = chain.run_stages(rows, signatures, self.settings, spread, snapshots=f"{work}/stages", late_rows=late and bool(known))
        stage = self._written(stage, f"{work}/stage")
        delete(self.spark, f"{work}/stages")
        kept = newest(stage, self.settings.n_points, bounded=spread.engines)
        stored.write(version, kept if others is None else kept.unionByName(others), touched, before)
        release(self.spark)
        found = self._written(chain.matched(stage, self.settings, spread.engines, only_new=True), f"{work}/flights")
        renewed = found.select(*[bt(k).alias(f"__f_{k}") for k in FLIGHT]).distinct()
        same = [bt(k).eqNullSafe(bt(f"__f_{k}")) for k in FLIGHT]
        known = flights.read(before, touched).join(renewed, same, "left_anti")
        flights.write(version, known.unionByName(found.select(*map(bt, FLIGHT_SCHEMA.names))), touched, before)
        delete(self.spark, work)
        # The version before stays: this one may have to be made again from it.
        for store in (stored, flights):
            store.vacuum(version, before)
        release(self.spark)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        """``df`` as read back; the shuffles that made it are not needed any more."""
        df.write.mode("overwrite").parquet(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)
