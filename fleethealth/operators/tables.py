"""Maintenance of catalog tables.

Plain parquet tables know no row-level UPDATE / DELETE / MERGE. Every mutation
is therefore a DataFrame -> DataFrame function plus one commit. A table without
partitions is written to a fresh folder and then pointed at it; ``vacuum``
removes folders left behind. In a partitioned table only partitions that hold a
changed row are written, by Spark's dynamic partition overwrite; their rows are
found by a join on the partition values, however many those are. A job that
fails leaves the old state in place.
"""

from __future__ import annotations

import time as clock
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fleethealth import schema as S
from fleethealth.functions import bt
from fleethealth.operators.history import dedup_keep
from fleethealth.operators.history import latest_n
from fleethealth.session import scratch_dir


def quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.replace("`", "").split("."))


def catalog_exists(spark: SparkSession, catalog: str) -> bool:
    """True for a configured catalog; one that fails to resolve is absent."""
    return catalog == "spark_catalog" or spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


def schema_exists(spark: SparkSession, schema: str) -> bool:
    return spark.catalog.databaseExists(schema)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_table(spark: SparkSession, table: str, schema: T.StructType, location: str,
                 partition_by: Sequence[str] = ()) -> None:
    """Empty external parquet table below ``location``."""
    first = _version(location)
    writer = spark.createDataFrame([], schema).write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", first).saveAsTable(table)
    spark.sql(f"ALTER TABLE {quote(table)} SET TBLPROPERTIES ('fleethealth.root' = '{location}')")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote(table)}")


def append_table(df: DataFrame, table: str) -> None:
    """Append by column name; a frame without columns is a no-op."""
    if not df.columns:
        return
    target = df.sparkSession.table(table)
    aligned = df.select(*[
        bt(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.schema
    ])
    aligned.write.mode("append").insertInto(table)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


# -- pure mutations ----------------------------------------------------------

def upserted(base: DataFrame, updates: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """Rows of ``updates`` replace base rows of equal key (null equals null), others are added.

    Of several updates of one key the first by ``prefer`` counts.
    """
    order = list(prefer) or [bt(c).desc_nulls_last() for c in updates.columns if c not in keys]
    one = dedup_keep(updates, keys, order or [F.lit(0)])
    fresh = one.select(*[bt(k).alias(f"__u_{k}") for k in keys])
    kept = base.join(fresh, _equal(keys, "__u_"), "left_anti")
    return kept.unionByName(one.select(*map(bt, base.columns)))


def aged_new_flag(df: DataFrame, until: datetime, time: str = S.TIME) -> DataFrame:
    """NEW_FLAG = 0 for rows up to ``until``."""
    old = bt(time) <= F.lit(until).cast("timestamp_ntz")
    return df.withColumn(S.NEW_FLAG, F.when(old, F.lit(0).cast("long")).otherwise(bt(S.NEW_FLAG)))


def pruned(df: DataFrame, n: int, keys: Sequence[str] = ("ESN",), order: Sequence[str] = (S.TIME,)) -> DataFrame:
    return latest_n(df, n, keys, order)


def without_later(df: DataFrame, after: datetime, time: str = S.TIME) -> DataFrame:
    """Drop rows later than ``after``; rows without a time stay."""
    return df.where(~F.coalesce(bt(time) > F.lit(after).cast("timestamp_ntz"), F.lit(False)))


def without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(columns))


# -- commits -----------------------------------------------------------------

def _version(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def _root(spark: SparkSession, table: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {quote(table)} ('fleethealth.root')").first()["value"]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _equal(columns: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [bt(c).eqNullSafe(bt(prefix + c)) for c in columns])


def _within(base: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of ``base`` in the partitions of ``touched``.

    Values without null are compared by plain equality, which lets Spark prune
    partitions at run time; only partitions with a null need the other join.
    """
    known = reduce(lambda a, b: a & b, [bt(p).isNotNull() for p in parts])
    plain = base.where(known).join(touched.where(known).select(*map(bt, parts)), list(parts), "left_semi")
    other = touched.where(~known).select(*[bt(p).alias(f"__t_{p}") for p in parts])
    odd = base.where(~known).join(other, _equal(parts, "__t_"), "left_semi")
    return plain.select(*map(bt, base.columns)).unionByName(odd)


def _replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite the partitions that ``df`` has rows of, and no other."""
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, "static")
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*map(bt, spark.table(table).columns)).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)


def _folders(df: DataFrame, parts: Sequence[str]) -> list:
    """Partition values and folder of every partition of ``df``; metadata, one row per partition."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]+$", "").alias("__folder")
    return df.select(*map(bt, parts), folder).distinct().collect()


def _drop_partitions(spark: SparkSession, table: str, rows: Sequence, parts: Sequence[str]) -> None:
    """Take emptied partitions out of the catalog, a hundred per statement, and remove their folders."""
    literal = lambda v: "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    specs = ["PARTITION (" + ", ".join(f"`{p}` = {literal(r[p])}" for p in parts) + ")" for r in rows]
    for i in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {quote(table)} DROP IF EXISTS {', '.join(specs[i:i + 100])}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for r in rows:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["__folder"]))
        path.getFileSystem(conf).delete(path, True)
    spark.catalog.refreshTable(table)


def commit(df: DataFrame, table: str) -> None:
    """Make ``df`` the whole new state."""
    spark, name = df.sparkSession, quote(table)
    path = _version(_root(spark, table))
    parts = partition_columns(spark, table)
    if not parts:
        df.write.mode("errorifexists").parquet(path)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        return
    # Written aside first: which partitions end up empty is then read, not computed again.
    aside = scratch_dir(spark, "commit")
    df.write.parquet(aside)
    state = spark.read.schema(df.schema).parquet(aside)
    base = spark.table(table)
    after = state.select(*[bt(p).alias(f"__a_{p}") for p in parts]).distinct()
    emptied = _folders(base.select("*", "_metadata").join(after, _equal(parts, "__a_"), "left_anti"), parts)
    _replace_partitions(state, table)
    _drop_partitions(spark, table, emptied, parts)


def _rewrite(spark: SparkSession, table: str, hit: Column, change: Callable[[DataFrame], DataFrame]) -> None:
    """Apply row-wise ``change``, which leaves rows outside ``hit`` as they are."""
    base, parts = spark.table(table), partition_columns(spark, table)
    if not parts:
        return commit(change(base), table)
    touched = base.where(hit).select(*map(bt, parts)).distinct()
    _rewrite_partitions(spark, table, touched, change(_within(base, touched, parts)), parts)


def _rewrite_partitions(spark: SparkSession, table: str, touched: DataFrame, state: DataFrame, parts: Sequence[str]) -> None:
    base = spark.table(table)
    after = state.select(*[bt(p).alias(f"__a_{p}") for p in parts]).distinct()
    gone = touched.join(after, _equal(parts, "__a_"), "left_anti").select(*[bt(p).alias(f"__t_{p}") for p in parts])
    emptied = _folders(base.select("*", "_metadata").join(gone, _equal(parts, "__t_"), "left_semi"), parts)
    _replace_partitions(state, table)
    _drop_partitions(spark, table, emptied, parts)


def upsert(updates: DataFrame, table: str, keys: Sequence[str] = ("ESN", S.TIME)) -> None:
    """Insert or replace by key. If the partition columns are part of the key,
    only the partitions that receive updates are read and written."""
    spark = updates.sparkSession
    base, parts = spark.table(table), partition_columns(spark, table)
    if not parts or not set(parts) <= set(keys):
        return commit(upserted(base, updates, keys), table)
    touched = updates.select(*map(bt, parts)).distinct()
    _replace_partitions(upserted(_within(base, touched, parts), updates, keys), table)


def age_new_flag(spark: SparkSession, table: str, until: datetime) -> None:
    old = (bt(S.TIME) <= F.lit(until).cast("timestamp_ntz")) & ~bt(S.NEW_FLAG).eqNullSafe(F.lit(0))
    _rewrite(spark, table, old, lambda d: aged_new_flag(d, until))


def prune_old_rows(spark: SparkSession, table: str, n: int, **kw) -> None:
    base, parts = spark.table(table), partition_columns(spark, table)
    kept = pruned(base, n, **kw)
    if not parts:
        return commit(kept, table)
    # A partition changes if fewer of its rows are kept than it has.
    aside = scratch_dir(spark, "kept")
    kept.write.parquet(aside)
    kept = spark.read.schema(base.schema).parquet(aside)
    count = lambda d, name: d.groupBy(*map(bt, parts)).agg(F.count(F.lit(1)).alias(name))
    left = count(kept, "__kept").select("__kept", *[bt(p).alias(f"__k_{p}") for p in parts])
    touched = count(base, "__all").join(left, _equal(parts, "__k_"), "left").where(
        F.col("__all") > F.coalesce("__kept", F.lit(0))).select(*map(bt, parts))
    _rewrite_partitions(spark, table, touched, _within(kept, touched, parts), parts)


def delete_after(spark: SparkSession, table: str, after: datetime) -> None:
    _rewrite(spark, table, bt(S.TIME) > F.lit(after).cast("timestamp_ntz"), lambda d: without_later(d, after))


def delete_null_rows(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    missing = reduce(lambda a, b: a | b, [bt(c).isNull() for c in columns])
    _rewrite(spark, table, missing, lambda d: without_nulls(d, columns))


def vacuum(spark: SparkSession, table: str, keep_hours: float = 168.0) -> int:
    """Remove folders that no state of the last ``keep_hours`` used; returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(_root(spark, table))
    fs = root.getFileSystem(conf)
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote(table)}").collect()}
    current = jvm.org.apache.hadoop.fs.Path(detail["Location"]).getName()
    limit, gone = (clock.time() - keep_hours * 3600) * 1000, 0
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("v-") and name != current and f.getModificationTime() < limit:
            gone += fs.delete(f.getPath(), True)
    return gone


def truncate_table(spark: SparkSession, table: str) -> None:
    """Empty state, same schema."""
    parts = partition_columns(spark, table)
    if parts:
        _drop_partitions(spark, table, _folders(spark.table(table), parts), parts)
    else:
        commit(spark.table(table).limit(0), table)


def clone_table(spark: SparkSession, table: str, target: str, location: str) -> None:
    source = spark.table(table)
    create_table(spark, target, source.schema, location, partition_columns(spark, table))
    commit(source, target)
