"""Catalog table maintenance: each query mutates a table and reads it back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from fleethealth.checks import views as V
from fleethealth.checks.registry import check
from fleethealth.functions import bt
from fleethealth.operators import tables
from fleethealth.session import scratch_dir

COLUMNS = 'event_id, user_id AS "ESN", ts AS reportdatetime, value, CAST(1 AS BIGINT) AS "NEW_FLAG"'
BASE = f"SELECT {COLUMNS} FROM events"
MARK = datetime(2024, 1, 20, 12)
MARK_SQL = "TIMESTAMP '2024-01-20 12:00:00'"


def _rows(spark, sf_dir):
    return V.table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("ESN"), F.col("ts").alias("reportdatetime"), "value",
        F.lit(1).cast("long").alias("NEW_FLAG"))


def _name(spark) -> tuple[str, str]:
    schema = f"fleethealth_{uuid.uuid4().hex[:10]}"
    root = scratch_dir(spark, schema)
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{root}'")
    return f"{schema}.reports", f"{root}/reports"


def _filled(spark, sf_dir) -> str:
    table, location = _name(spark)
    rows = _rows(spark, sf_dir)
    tables.create_table(spark, table, rows.schema, location)
    tables.append_table(rows, table)
    return table


@check("table_lifecycle", """SELECT true AS catalog_found, true AS schema_found, false AS before, true AS created,
count(*) AS stored, false AS dropped FROM events""")
def table_lifecycle(spark, sf_dir):
    table, location = _name(spark)
    rows = _rows(spark, sf_dir)
    before = tables.table_exists(spark, table)
    tables.create_table(spark, table, rows.schema, location)
    tables.append_table(rows, table)
    out = tables.read_table(spark, table).agg(F.count(F.lit(1)).alias("stored")).select(
        F.lit(tables.catalog_exists(spark, "spark_catalog")).alias("catalog_found"),
        F.lit(tables.schema_exists(spark, table.split(".")[0])).alias("schema_found"),
        F.lit(before).alias("before"), F.lit(tables.table_exists(spark, table)).alias("created"), "stored")
    gone, location = _name(spark)
    tables.create_table(spark, gone, rows.schema, location)
    tables.drop_table(spark, gone)
    return out.withColumn("dropped", F.lit(tables.table_exists(spark, gone)))


@check("append_table", f"{BASE} UNION ALL {BASE} WHERE value > 10")
def append_table(spark, sf_dir):
    table = _filled(spark, sf_dir)
    tables.append_table(_rows(spark, sf_dir).where(bt("value") > 10), table)
    tables.append_table(_rows(spark, sf_dir).limit(0), table)
    return spark.table(table)


@check("read_table", BASE)
def read_table(spark, sf_dir):
    return tables.read_table(spark, _filled(spark, sf_dir))


@check("upsert", f"""SELECT event_id, user_id AS "ESN", ts AS reportdatetime,
CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value,
CAST(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END AS BIGINT) AS "NEW_FLAG" FROM events
UNION ALL SELECT event_id, user_id + 1000000, ts, value, CAST(0 AS BIGINT) FROM events WHERE event_type = 'signup'""")
def upsert(spark, sf_dir):
    table = _filled(spark, sf_dir)
    e = V.table(spark, sf_dir, "events")
    row = lambda d, esn, value: d.select(
        "event_id", esn.alias("ESN"), F.col("ts").alias("reportdatetime"), value.alias("value"),
        F.lit(0).cast("long").alias("NEW_FLAG"))
    changed = row(e.where(bt("event_type") == "purchase"), bt("user_id"), bt("value") * 2)
    added = row(e.where(bt("event_type") == "signup"), bt("user_id") + 1_000_000, bt("value"))
    tables.upsert(changed.unionByName(added).unionByName(changed), table)
    return spark.table(table)


@check("age_new_flag", f"""SELECT event_id, user_id AS "ESN", ts AS reportdatetime, value,
CAST(CASE WHEN ts <= {MARK_SQL} THEN 0 ELSE 1 END AS BIGINT) AS "NEW_FLAG" FROM events""")
def age_new_flag(spark, sf_dir):
    table = _filled(spark, sf_dir)
    tables.age_new_flag(spark, table, MARK)
    return spark.table(table)


@check("prune_old_rows", f"""SELECT event_id, "ESN", reportdatetime, value, "NEW_FLAG" FROM (SELECT *,
row_number() OVER (PARTITION BY "ESN" ORDER BY reportdatetime DESC) AS rn FROM ({BASE}) b) x WHERE rn <= 20""")
def prune_old_rows(spark, sf_dir):
    table = _filled(spark, sf_dir)
    tables.prune_old_rows(spark, table, 20)
    return spark.table(table)


@check("delete_after", f"{BASE} WHERE ts <= {MARK_SQL}")
def delete_after(spark, sf_dir):
    table = _filled(spark, sf_dir)
    tables.delete_after(spark, table, MARK)
    return spark.table(table)


@check("delete_null_rows", f"{BASE} WHERE value <= 50")
def delete_null_rows(spark, sf_dir):
    table, location = _name(spark)
    rows = _rows(spark, sf_dir).withColumn("value", F.when(bt("value") <= 50, bt("value")))
    tables.create_table(spark, table, rows.schema, location)
    tables.append_table(rows, table)
    tables.delete_null_rows(spark, table, ["value"])
    return spark.table(table)


@check("truncate_table", BASE.replace(" value,", " value + 1 AS value,"))
def truncate_table(spark, sf_dir):
    """Truncated, then filled again with all rows of another value."""
    table = _filled(spark, sf_dir)
    tables.truncate_table(spark, table)
    tables.append_table(_rows(spark, sf_dir).withColumn("value", bt("value") + 1), table)
    return spark.table(table)


def _by_day(spark, sf_dir) -> str:
    """All rows, partitioned by day; one day in ten has no partition value."""
    table, location = _name(spark)
    rows = _dated(_rows(spark, sf_dir))
    tables.create_table(spark, table, rows.schema, location, ["day"])
    tables.append_table(rows, table)
    return table


def _dated(rows):
    day = F.dayofmonth("reportdatetime")
    return rows.withColumn("day", F.when(day % 10 != 0, day))


DAY_SQL = "CASE WHEN day(ts) % 10 <> 0 THEN CAST(day(ts) AS INT) END AS day"


@check("upsert_partitioned", f"""SELECT event_id, user_id AS "ESN", ts AS reportdatetime,
CASE WHEN event_type = 'purchase' AND day(ts) % 2 = 0 THEN value * 2 ELSE value END AS value,
CAST(CASE WHEN event_type = 'purchase' AND day(ts) % 2 = 0 THEN 0 ELSE 1 END AS BIGINT) AS "NEW_FLAG", {DAY_SQL} FROM events
UNION ALL SELECT event_id, user_id + 1000000, ts, value, CAST(0 AS BIGINT), 40 FROM events WHERE event_type = 'signup'""")
def upsert_partitioned(spark, sf_dir):
    table = _by_day(spark, sf_dir)
    rows = _rows(spark, sf_dir).withColumn("NEW_FLAG", F.lit(0).cast("long"))
    kind = V.table(spark, sf_dir, "events").select(bt("event_id").alias("__e"), "event_type")
    typed = _dated(rows).join(kind, bt("event_id") == bt("__e")).drop("__e")
    changed = typed.where((bt("event_type") == "purchase") & (F.dayofmonth("reportdatetime") % 2 == 0)).withColumn(
        "value", bt("value") * 2)
    added = typed.where(bt("event_type") == "signup").withColumn("ESN", bt("ESN") + 1_000_000).withColumn("day", F.lit(40))
    tables.upsert(changed.unionByName(added).drop("event_type"), table, ["ESN", "reportdatetime", "day"])
    return spark.table(table)


@check("maintain_partitioned", f"""SELECT event_id, "ESN", reportdatetime, value, "NEW_FLAG", day FROM (SELECT *,
row_number() OVER (PARTITION BY "ESN" ORDER BY reportdatetime DESC) AS rn FROM (SELECT event_id, user_id AS "ESN",
ts AS reportdatetime, value, CAST(0 AS BIGINT) AS "NEW_FLAG", {DAY_SQL} FROM events
WHERE ts <= {MARK_SQL}) b) x WHERE rn <= 10""")
def maintain_partitioned(spark, sf_dir):
    """Aging, deletion and pruning of a partitioned table, one after the other."""
    table = _by_day(spark, sf_dir)
    tables.age_new_flag(spark, table, MARK)
    tables.delete_after(spark, table, MARK)
    tables.prune_old_rows(spark, table, 10)
    return spark.table(table)


@check("clone_table", BASE)
def clone_table(spark, sf_dir):
    table = _filled(spark, sf_dir)
    target, location = _name(spark)
    tables.clone_table(spark, table, target, location)
    tables.truncate_table(spark, table)  # the copy does not depend on its source
    return spark.table(target)
