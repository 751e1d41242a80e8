"""Report scans and typed readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt, null_if_nan, r5
from fleethealth.operators.clean import TIME_FORMAT, to_ntz

# Join keys of the measured and nominal tables and their public names.
SOURCE_KEYS = {
    "EngineSerialNumber": "ESN",
    "StartDatetime": "reportdatetime",
    "OperatorCode": "operator",
    "EngineId": "equipmentid",
    "AircraftIdentifier": "ACID",
    "EnginePosition": "ENGPOS",
}
STORED = "FirstReceivedDatetime"
DELETED = "deleted"


def scan_reports(
    measured: DataFrame,
    nominal: DataFrame,
    phase: str,
    nominal_temperatures: DataFrame | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    live_only: bool = True,
    keys: Mapping[str, str] = SOURCE_KEYS,
    time: str = "StartDatetime",
    measured_columns: Sequence[str] = S.MEASURED + S.AMBIENT,
    nominal_columns: Sequence[str] = S.NOMINAL,
    temperature_columns: Sequence[str] = S.KELVIN_COLUMNS,
) -> DataFrame:
    """Measured reports joined with their nominal readings on the six keys.

    The time and ``deleted`` predicates are put on every side before the join,
    so each scan prunes by itself. With ``nominal_temperatures`` (cruise) the
    three temperatures come from that table. No final sort.
    """
    def side(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        tests = []
        if live_only:
            tests.append(bt(DELETED) == 0)
        if start is not None:
            tests.append(bt(time) >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            tests.append(bt(time) <= F.lit(end).cast("timestamp_ntz"))
        kept = df.where(reduce(lambda a, b: a & b, tests)) if tests else df
        return kept.select(*[bt(c) for c in [*keys, *columns]])

    split = nominal_temperatures is not None
    from_main = [c for c in nominal_columns if not (split and c in temperature_columns)]
    stored = [STORED] if STORED in measured.columns else []
    joined = side(measured, [*stored, *measured_columns]).join(side(nominal, from_main), list(keys))
    if split:
        joined = joined.join(side(nominal_temperatures, temperature_columns), list(keys))
    return joined.select(
        F.lit(phase).alias(S.PHASE),
        *[bt(k).alias(v) for k, v in keys.items()],
        *[bt(STORED).alias("datestored") for _ in stored],
        F.lit(S.PHASE_CODES[phase]).cast("long").alias("DSCID"),
        *map(bt, measured_columns),
        *map(bt, nominal_columns),
    )


def since_checkpoint(
    df: DataFrame, checkpoint: datetime | None, as_of: datetime, days: int = 14, time: str = S.TIME
) -> DataFrame:
    """Rows at or after the checkpoint, else of the last ``days`` days."""
    start = checkpoint if checkpoint is not None else as_of - timedelta(days=days)
    return df.where(bt(time) >= F.lit(start).cast("timestamp_ntz"))


def time_range(df: DataFrame, start: datetime, end: datetime, time: str = S.TIME) -> DataFrame:
    return df.where(bt(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def preview(df: DataFrame, order: Sequence[str], n: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order."""
    return df.orderBy(*map(bt, order)).limit(n).select(*map(bt, columns or df.columns))


def read_history(
    spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Typed CSV read: type by column name, readings rounded, bad times dropped."""
    typed = schema or S.struct_of(columns)
    times = [f.name for f in typed if isinstance(f.dataType, T.TimestampNTZType)]
    text = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in times else f.dataType) for f in typed
    ])
    raw = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return raw.select(*[
        to_ntz(f.name, TIME_FORMAT).alias(f.name) if f.name in times
        else null_if_nan(r5(bt(f.name))).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else bt(f.name)
        for f in typed
    ]).dropna("any", subset=times or None)


INDEX_COLUMNS = ("Unnamed: 0", "Column1")


def read_csv_trimmed(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    times: Sequence[str] = S.TIME_COLUMNS,
    drop: Sequence[str] = INDEX_COLUMNS,
) -> DataFrame:
    """All-string read; names and cells trimmed, known columns cast leniently."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    out = []
    for c in raw.columns:
        name = c.strip()
        if name in drop:
            continue
        cell = F.trim(bt(c))
        if name in times:
            cell = F.try_to_timestamp(cell, F.lit(TIME_FORMAT)).cast("timestamp_ntz")
        elif name in types:
            cell = cell.try_cast(types[name])
            if types[name] == "double":
                cell = null_if_nan(r5(cell))  # a missing reading, as NULL everywhere
        out.append(cell.alias(name))
    return raw.select(*out).dropna("any", subset=list(times))


def read_stage(spark: SparkSession, path: str, phases: Sequence[str] | None = None) -> DataFrame:
    """A stage written partitioned by phase; the filter prunes whole folders."""
    df = spark.read.parquet(path)
    return df.where(bt(S.PHASE).isin(list(phases))) if phases else df


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files of a stage; the phase is taken from the file name."""
    pattern = "(" + "|".join(S.PHASES) + ")"
    name = F.lower(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1))
    raw = spark.read.schema(schema).option("header", True).csv(path)
    return raw.select(F.regexp_extract(name, pattern, 1).alias(S.PHASE), "*")
