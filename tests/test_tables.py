"""Table maintenance contract."""

import uuid

import pytest
from helpers import at

from fleethealth import schema as S
from fleethealth.operators import tables
from fleethealth.session import scratch_dir

COLUMNS = ["ESN", "reportdatetime", "NEW_FLAG"]


@pytest.fixture
def table(spark):
    schema = f"t_{uuid.uuid4().hex[:8]}"
    root = scratch_dir(spark, schema)
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{root}'")
    tables.create_table(spark, f"{schema}.r", S.struct_of(COLUMNS), f"{root}/r")
    yield f"{schema}.r"
    spark.sql(f"DROP DATABASE {schema} CASCADE")


@pytest.fixture
def five(frame):
    return frame({"ESN": [1, 1, 1, 2, 2], "reportdatetime": [at(0), at(1), at(2), at(0), at(1)], "NEW_FLAG": [1] * 5})


def test_exists_and_drop(spark, table):
    assert tables.table_exists(spark, table) and tables.schema_exists(spark, table.split(".")[0])
    assert tables.catalog_exists(spark, "spark_catalog") and not tables.catalog_exists(spark, "nowhere")
    assert not tables.table_exists(spark, table + "_none")
    tables.drop_table(spark, table)
    assert not tables.table_exists(spark, table)


def test_append_read_and_empty(spark, table, five):
    tables.append_table(five.select("NEW_FLAG", "reportdatetime", "ESN"), table)
    tables.append_table(spark.createDataFrame([], S.T.StructType([])), table)
    assert tables.read_table(spark, table).count() == 5


def test_upsert_inserts_then_updates(spark, table, five, frame):
    tables.upsert(five, table)
    assert spark.table(table).count() == 5
    tables.upsert(frame({"ESN": [1], "reportdatetime": [at(0)], "NEW_FLAG": [0]}), table)
    assert spark.table(table).count() == 5
    assert spark.table(table).where("NEW_FLAG = 0").count() == 1


def test_age_prune_delete(spark, table, five):
    tables.append_table(five, table)
    tables.age_new_flag(spark, table, at(1))
    assert spark.table(table).where("NEW_FLAG = 0").count() == 4
    tables.prune_old_rows(spark, table, 2, keys=["ESN"])
    assert spark.table(table).count() == 4
    tables.delete_after(spark, table, at(1))
    assert spark.table(table).count() == 3


def test_null_rows_truncate_clone(spark, table, frame):
    tables.append_table(frame({"ESN": [1, 2], "reportdatetime": [at(0), at(1)], "NEW_FLAG": [1, None]}), table)
    tables.delete_null_rows(spark, table, ["NEW_FLAG"])
    assert spark.table(table).count() == 1
    copy = table + "_copy"
    tables.clone_table(spark, table, copy, scratch_dir(spark, "copy"))
    tables.truncate_table(spark, table)
    assert (spark.table(table).count(), spark.table(copy).count()) == (0, 1)
    assert spark.table(table).columns == COLUMNS


@pytest.fixture
def by_engine(spark, table, frame):
    name = table + "_by_esn"
    tables.create_table(spark, name, S.struct_of(["reportdatetime", "NEW_FLAG", "ESN"]), scratch_dir(spark, "p"), ["ESN"])
    tables.append_table(frame({"ESN": [1, 1, 2], "reportdatetime": [at(0), at(1), at(1)], "NEW_FLAG": [1] * 3}), name)
    return name


def state(spark, name):
    return sorted((r["ESN"], r["reportdatetime"], r["NEW_FLAG"]) for r in spark.table(name).collect())


def test_partitioned_table_keeps_its_partitions(spark, by_engine):
    tables.age_new_flag(spark, by_engine, at(0))
    assert tables.partition_columns(spark, by_engine) == ["ESN"]
    assert state(spark, by_engine) == [(1, at(0), 0), (1, at(1), 1), (2, at(1), 1)]
    tables.append_table(spark.table(by_engine).where("ESN = 2"), by_engine)
    assert len(state(spark, by_engine)) == 4
    tables.delete_after(spark, by_engine, at(0))  # partition 2 is gone as a whole
    assert state(spark, by_engine) == [(1, at(0), 0)]
    tables.truncate_table(spark, by_engine)
    assert state(spark, by_engine) == []


def test_upsert_rewrites_only_touched_partitions(spark, by_engine, frame):
    files = lambda esn: {r[0] for r in spark.table(by_engine).where(f"ESN = {esn}").select("_metadata.file_path").collect()}
    one, two = files(1), files(2)
    tables.upsert(frame({"ESN": [1, 3], "reportdatetime": [at(1), at(5)], "NEW_FLAG": [0, 0]}), by_engine)
    assert state(spark, by_engine) == [(1, at(0), 1), (1, at(1), 0), (2, at(1), 1), (3, at(5), 0)]
    assert files(2) == two and files(1).isdisjoint(one)


def test_partition_values_with_special_characters(spark, table, frame):
    name = table + "_by_operator"
    tables.create_table(spark, name, S.struct_of(["ESN", "NEW_FLAG", "reportdatetime", "operator"]),
                        scratch_dir(spark, "o"), ["operator"])
    odd = ["a:b c", "it's 50%", "x/y=z"]
    tables.append_table(frame({"ESN": [1, 2, 3], "NEW_FLAG": [1] * 3, "reportdatetime": [at(0)] * 3, "operator": odd}), name)
    tables.age_new_flag(spark, name, at(0))
    assert sorted((r["operator"], r["NEW_FLAG"]) for r in spark.table(name).collect()) == sorted((o, 0) for o in odd)


def test_upsert_into_many_partitions(spark, table, frame):
    name = table + "_many"
    tables.create_table(spark, name, S.struct_of(["reportdatetime", "NEW_FLAG", "ESN"]), scratch_dir(spark, "m"), ["ESN"])
    rows = spark.range(2000).selectExpr("timestamp_ntz'2024-03-01 00:00:00' AS reportdatetime", "1L AS NEW_FLAG",
                                        "CASE WHEN id > 0 THEN id END AS ESN").repartition(4, "ESN")
    tables.append_table(rows, name)
    tables.upsert(rows.selectExpr("reportdatetime", "0L AS NEW_FLAG", "ESN"), name)
    assert spark.table(name).groupBy("NEW_FLAG").count().collect() == [(0, 2000)]
    assert spark.table(name).where("ESN IS NULL").count() == 1


def test_maintenance_leaves_other_partitions_alone(spark, by_engine, frame):
    tables.append_table(frame({"ESN": [None, 4], "reportdatetime": [at(9), at(0)], "NEW_FLAG": [1, None]}), by_engine)
    files = lambda: {r[0]: r[1] for r in spark.table(by_engine).select("ESN", "_metadata.file_path").distinct().collect()}
    before = files()
    tables.delete_after(spark, by_engine, at(8))  # the partition without a value is emptied
    tables.delete_null_rows(spark, by_engine, ["NEW_FLAG"])
    assert files() == {k: before[k] for k in (1, 2)}
    tables.append_table(frame({"ESN": [None], "reportdatetime": [at(1)], "NEW_FLAG": [1]}), by_engine)
    assert spark.table(by_engine).where("ESN IS NULL").count() == 1  # nothing old comes back
    tables.age_new_flag(spark, by_engine, at(0))
    assert files()[2] == before[2] and files()[1] != before[1]
    kept = files()
    tables.prune_old_rows(spark, by_engine, 1, keys=["ESN"])
    assert files()[2] == kept[2] and spark.table(by_engine).count() == 3


def test_upsert_replaces_a_null_key(spark, table, frame):
    row = lambda flag: frame({"ESN": [None], "reportdatetime": [at(0)], "NEW_FLAG": [flag]})
    tables.upsert(row(1), table)
    tables.upsert(row(0), table)
    assert [r["NEW_FLAG"] for r in spark.table(table).collect()] == [0]


def test_vacuum_removes_old_states(spark, table, five):
    for _ in range(3):
        tables.upsert(five, table)
    assert tables.vacuum(spark, table) == 0
    assert tables.vacuum(spark, table, keep_hours=0) == 3
    assert spark.table(table).count() == 5
