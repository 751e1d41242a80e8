"""Several sources with one low watermark, and repeats later than any watermark."""

import time as clock

import pytest
from helpers import at
from pyspark.sql import functions as F

from fleethealth.functions import bt
from fleethealth.operators.membership import MAX_BITS, MIN_BITS, bits_for, key_filter, may_contain
from fleethealth.session import scratch_dir
from fleethealth.streaming import once, state, stateful

ROWS = "ESN long, phase string, reportdatetime timestamp_ntz, x double"


def source(spark, batches, schema=ROWS):
    """One file per micro-batch, in this order."""
    path = scratch_dir(spark, "source")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        clock.sleep(0.02)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_a_filter_misses_no_key_and_lets_few_others_pass(spark):
    keys = spark.range(3000).selectExpr("if(id = 7, null, id) AS a", "if(id % 5 = 0, null, cast(id AS string)) AS b")
    bits = bits_for(3000)
    words = key_filter(keys, ["a", "b"], bits)
    assert [len(r["words"]) for r in words.collect()] == [bits // 64]
    other = spark.range(100_000, 120_000).selectExpr("id AS a", "cast(id AS string) AS b")
    passed = lambda df: df.where(may_contain(words.scalar(), [bt("a"), bt("b")], bits)).count()
    assert passed(keys) == 3000
    assert passed(other) < 20_000 * 0.03
    none = key_filter(keys.limit(0), ["a", "b"], MIN_BITS)
    assert other.where(may_contain(none.scalar(), [bt("a"), bt("b")], MIN_BITS)).count() == 0


def test_the_size_of_a_filter_is_bounded():
    assert bits_for(0) == bits_for(1) == MIN_BITS and bits_for(10**12) == MAX_BITS
    assert all(bits_for(n) >= 10 * n and bits_for(n) & (bits_for(n) - 1) == 0 for n in (500, 4096, 10**6))


FIRST = [
    [(1, "cruise", at(0), 1.0), (1, "cruise", at(0), 0.5), (2, "cruise", at(1), None), (None, "cruise", at(1), 2.0)],
    [(1, "cruise", at(30), 1.0)],
    [(1, "cruise", at(0), 0.1), (None, "cruise", at(1), 2.0), (3, "cruise", at(0), 3.0)],  # late: two repeats, one first
    [],
    [(5, "cruise", None, 1.0)],
    [(5, "cruise", None, 2.0), (5, "cruise", at(2), 2.0)],
]
SECOND = [[(1, "climb", at(0), 1.0)], [], [(1, "climb", at(0), 9.0), (2, "climb", at(4), 1.0)]]
WANT = [(1, "climb", at(0), 1.0), (1, "cruise", at(0), 0.5), (1, "cruise", at(30), 1.0), (2, "climb", at(4), 1.0),
        (2, "cruise", at(1), None), (3, "cruise", at(0), 3.0), (5, "cruise", None, 1.0), (5, "cruise", at(2), 2.0),
        (None, "cruise", at(1), 2.0)]
KEYS = ["ESN", "phase", "reportdatetime"]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("days", [1000, 0])
def test_late_repeats_go_and_late_first_reports_stay(spark, monkeypatch, days):
    monkeypatch.setattr(once, "MAX_DAYS", days)
    root = scratch_dir(spark, "once")
    query, store = once.start_once({"a": source(spark, FIRST), "b": source(spark, SECOND)}, root, KEYS)
    query.awaitTermination()
    last = query.lastProgress["batchId"]
    assert collected(store.rows(last)) == sorted(WANT, key=repr)
    mark = lambda version, names: store.low_watermark(version, names).first()["checkpoint"]
    assert mark(last, ["a", "b"]) == at(4) and mark(last, ["a"]) == at(30)
    assert mark(1, ["a", "b"]) == at(0)  # the slow source holds it back
    assert mark(last, ["a", "b", "silent"]) is None and mark(-1, ["a"]) is None


def test_a_micro_batch_done_again_gives_the_same_rows(spark):
    frames = [spark.createDataFrame(rows, ROWS).withColumn(once.SOURCE, F.lit("a")) for rows in FIRST]
    store = once.OnceStore(spark, scratch_dir(spark, "again"), spark.createDataFrame([], ROWS).schema, KEYS)
    for i, frame in enumerate(frames):
        store.apply(frame, i)
        before = collected(store.rows(i)), collected(store.stored_keys(i + 1)), collected(store.marks(i))
        store.apply(frame, i)
        assert (collected(store.rows(i)), collected(store.stored_keys(i + 1)), collected(store.marks(i))) == before
    assert collected(store.rows(2)) != collected(store.rows(5))


def test_only_the_days_of_a_micro_batch_are_read_and_the_filter_is_built_once(spark):
    frame = spark.range(2000).select(
        F.col("id").alias("ESN"), F.lit("cruise").alias("phase"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 100 AS int))").alias("reportdatetime"),
        F.lit(1.0).alias("x"))
    store = once.OnceStore(spark, scratch_dir(spark, "days"), frame.schema, KEYS)
    store.apply(frame.withColumn(once.SOURCE, F.lit("a")), 0)
    few = frame.where("ESN IN (3, 103, 5)")
    repeats = store.repeats(few, 1)
    assert len(repeats.collect()) == 3
    plan = repeats._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(line for line in lines if "FileScan parquet" in line and "__day" in line)
    assert "PartitionFilters" in scan and "2024-01-04" in scan and "2024-01-05" not in scan
    # The keys' filter is there, and built once for all its probes.
    assert any("Filter" in line and "ubquery" in line and "xxhash64" in line for line in lines)
    assert sum("ReusedSubquery" in line for line in lines) >= 3


PAIRS = "phase string, ACID string, reportdatetime timestamp_ntz, ESN long"


def test_a_slow_source_holds_the_watermark_back(spark):
    fast = [[("cruise", "A", at(d), e) for d in (0, 40) for e in (1, 2)], [("cruise", "A", at(41), e) for e in (1, 2)]]
    slow = [[("climb", "B", at(0), 1)], [("climb", "B", at(0.1), 1)], [("climb", "B", at(0), 2)], [("climb", "B", at(0.1), 2)]]

    def climbs(stream):
        out = scratch_dir(spark, "pairs")
        with state.state_partitions(spark, 2):
            query = (stateful.paired_stream(stream, "1 day").writeStream.format("parquet").option("path", out)
                     .option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start())
        query.awaitTermination()
        return query, spark.read.parquet(out).where("phase = 'climb'").count()

    parts = lambda: [source(spark, fast, PAIRS), source(spark, slow, PAIRS)]
    query, found = climbs(stateful.merged_sources(parts(), delay="1 day"))
    assert found == 4
    assert query.lastProgress["eventTime"]["watermark"].startswith("2024-02-29T02:24")  # the slow one's newest, less a day
    a, b = parts()
    assert climbs(a.unionByName(b))[1] == 0  # one mark for all: the slow source's halves come too late


def test_another_policy_is_refused(spark):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="policy"):
            stateful.merged_sources([source(spark, [[]], PAIRS)])
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
