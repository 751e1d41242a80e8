"""Engine pairs, phase matching, alerts and group tags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.registry import check, r5
from fleethealth.checks.row_queries import FLAGGED, MARK
from fleethealth.checks.source_queries import ROW_SUM_SQL, write_outputs, write_outputs_sql
from fleethealth.functions import bt
from fleethealth.operators import clean, deltas, history, phases, trend

ITEM_TIES = ["l_linenumber", "l_partkey", "l_shipdate"]
PAIR_ORDER = "l_suppkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_quantity"


def _items(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", *ITEM_TIES, "l_extendedprice", "l_quantity")


_PAIRED = """SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) = 2"""


@check("sister_delta", f"""WITH p AS (SELECT *, row_number() OVER w AS rn,
nth_value(l_suppkey, 1) OVER w2 AS s1, nth_value(l_suppkey, 2) OVER w2 AS s2,
nth_value(l_extendedprice, 1) OVER w2 AS e1, nth_value(l_extendedprice, 2) OVER w2 AS e2,
nth_value(l_quantity, 1) OVER w2 AS q1, nth_value(l_quantity, 2) OVER w2 AS q2
FROM lineitem WHERE l_orderkey IN ({_PAIRED})
WINDOW w AS (PARTITION BY l_orderkey ORDER BY {PAIR_ORDER}),
w2 AS (PARTITION BY l_orderkey ORDER BY {PAIR_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, CASE WHEN rn = 1 THEN s2 ELSE s1 END AS "SISTER_ESN",
{r5('l_extendedprice - CASE WHEN rn = 1 THEN e2 ELSE e1 END')} AS "l_extendedprice_E2E",
{r5('l_quantity - CASE WHEN rn = 1 THEN q2 ELSE q1 END')} AS "l_quantity_E2E",
CAST(NULL AS DOUBLE) AS "absent_E2E" FROM p""")
def sister_delta(spark, sf_dir):
    d = deltas.sister_delta(
        _items(spark, sf_dir), ["l_extendedprice", "l_quantity", "absent"], ["l_orderkey"], "l_suppkey", ITEM_TIES)
    return d.drop("l_shipdate", "l_extendedprice", "l_quantity")


@check("pair_groups_only", f"""SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN ({_PAIRED})""")
def pair_groups_only(spark, sf_dir):
    d = deltas.pair_groups_only(_items(spark, sf_dir), ["l_orderkey"], "l_suppkey")
    return d.select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")


def flights(spark, sf_dir):
    """Reports with a row_sum; one engine per user."""
    return V.reports(spark, sf_dir).select(
        "ESN", "phase", "reportdatetime", F.expr(ROW_SUM_SQL).alias("row_sum"))


FLIGHTS = (f'fl AS (SELECT "ESN", phase, reportdatetime, {ROW_SUM_SQL} AS row_sum FROM ({V.REPORTS_SQL}) r)')
BACK = (phases.Lookup("takeoff", "take-off", 24 * 60), phases.Lookup("climb", "climb", 12 * 60))
AHEAD = (phases.Lookup("climb", "climb", 12 * 60), phases.Lookup("cruise", "cruise", 24 * 60))


def _near(alias: str, hours: int, forward: bool = False) -> str:
    gap = f"{alias}.reportdatetime - d.reportdatetime" if forward else f"d.reportdatetime - {alias}.reportdatetime"
    near = f"({gap}) < INTERVAL {hours} HOUR"
    return (f"CASE WHEN {near} THEN {alias}.reportdatetime END AS reportdatetime_{alias},"
            f" CASE WHEN {near} THEN {alias}.row_sum END AS row_sum_{alias}")


def _asof(alias: str, phase: str, op: str, table: str = "fl") -> str:
    return (f"ASOF LEFT JOIN (SELECT * FROM {table} WHERE phase = '{phase}') {alias}"
            f' ON d."ESN" = {alias}."ESN" AND d.reportdatetime {op} {alias}.reportdatetime')


MERGED = f"""m AS (SELECT d."ESN", d.reportdatetime AS reportdatetime_cruise, d.row_sum AS row_sum_cruise,
{_near('takeoff', 24)}, {_near('climb', 12)} FROM (SELECT * FROM fl WHERE phase = 'cruise') d
{_asof('takeoff', 'take-off', '>')} {_asof('climb', 'climb', '>')})"""


@check("phase_asof", f"WITH {FLIGHTS}, {MERGED} SELECT * FROM m")
def phase_asof(spark, sf_dir):
    return phases.phase_asof(flights(spark, sf_dir), lookups=BACK, keys=["ESN"])


@check("phase_asof_forward", f"""WITH {FLIGHTS} SELECT d."ESN", d.reportdatetime AS reportdatetime_takeoff,
d.row_sum AS row_sum_takeoff, {_near('climb', 12, True)}, {_near('cruise', 24, True)}
FROM (SELECT * FROM fl WHERE phase = 'take-off') d
{_asof('climb', 'climb', '<')} {_asof('cruise', 'cruise', '<')}""")
def phase_asof_forward(spark, sf_dir):
    return phases.phase_asof_forward(flights(spark, sf_dir), AHEAD, keys=["ESN"], driver_suffix="takeoff")


@check("phase_asof_chain", f"""WITH {FLIGHTS},
c AS (SELECT d.*, climb.reportdatetime AS ct, climb.row_sum AS cs FROM (SELECT * FROM fl WHERE phase = 'take-off') d
{_asof('climb', 'climb', '<')}),
x AS (SELECT c.*, cruise.reportdatetime AS rt, cruise.row_sum AS rs FROM c
ASOF LEFT JOIN (SELECT * FROM fl WHERE phase = 'cruise') cruise ON c."ESN" = cruise."ESN" AND c.ct < cruise.reportdatetime)
SELECT "ESN", reportdatetime AS reportdatetime_takeoff, row_sum AS row_sum_takeoff,
CASE WHEN far THEN NULL ELSE ct END AS reportdatetime_climb, CASE WHEN far THEN NULL ELSE cs END AS row_sum_climb,
CASE WHEN far THEN NULL ELSE rt END AS reportdatetime_cruise, CASE WHEN far THEN NULL ELSE rs END AS row_sum_cruise
FROM (SELECT *, coalesce(rt - reportdatetime > INTERVAL 72 HOUR, false) AS far FROM x) y""")
def phase_asof_chain(spark, sf_dir):
    return phases.phase_asof_chain(flights(spark, sf_dir), 72 * 60, ["ESN"])


FIRE = "coalesce(row_sum_takeoff >= 3 AND row_sum_climb >= 3 AND row_sum_cruise >= 3, false)"
ALERTS = f"""al AS (SELECT *, CASE WHEN {FIRE} THEN row_sum_takeoff + row_sum_climb + row_sum_cruise END AS merge_sum,
CASE WHEN {FIRE} THEN 'YES' ELSE 'NO' END AS "DN_FIRE",
CASE WHEN {FIRE} THEN strftime(reportdatetime_takeoff, '%Y-%m-%d %H:%M:%S') END AS "DN_FIRE_TIME" FROM m)"""
SUMMARY = """SELECT {keys}, max("DN_FIRE") AS "DN_FIRED", CAST(sum(CASE "DN_FIRE" WHEN 'YES' THEN 1 ELSE 0 END) AS BIGINT)
AS "DN_FIRES", min("DN_FIRE_TIME") AS "First DN fire", max("DN_FIRE_TIME") AS "Last DN fire" FROM al GROUP BY {keys}"""


check("write_outputs", write_outputs_sql())(write_outputs)


@check("alert_flag", f"WITH {FLIGHTS}, {MERGED}, {ALERTS} SELECT * FROM al")
def alert_flag(spark, sf_dir):
    return phases.alert_flag(phase_asof(spark, sf_dir))


@check("alert_summary", f"WITH {FLIGHTS}, {MERGED}, {ALERTS} {SUMMARY.format(keys=chr(34) + 'ESN' + chr(34))}")
def alert_summary(spark, sf_dir):
    return phases.alert_summary(alert_flag(spark, sf_dir), ["ESN"])


LATE = datetime(2024, 1, 30, 12)
LATE_FLAG = FLAGGED.replace("TIMESTAMP '2024-01-20 12:00:00'", "TIMESTAMP '2024-01-30 12:00:00'")


def _recent(spark, sf_dir):
    return clean.new_flag(V.reports(spark, sf_dir).select("event_id", "ESN", "phase", "reportdatetime"), LATE)


@check("engines_with_new_data", f"""WITH r AS ({LATE_FLAG} FROM ({V.REPORTS_SQL}) e)
SELECT event_id, "ESN", phase, reportdatetime, "NEW_FLAG" FROM r
WHERE (phase, "ESN") IN (SELECT phase, "ESN" FROM r WHERE "NEW_FLAG" = 1)""")
def engines_with_new_data(spark, sf_dir):
    return trend.engines_with_new_data(_recent(spark, sf_dir))


@check("distinct_new_engines", f"""SELECT DISTINCT phase, "ESN" FROM ({LATE_FLAG} FROM ({V.REPORTS_SQL}) e) r
WHERE "NEW_FLAG" = 1""")
def distinct_new_engines(spark, sf_dir):
    return trend.distinct_new_engines(_recent(spark, sf_dir))


_GROUP_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate"


def _groups(spark, sf_dir):
    return V.table(spark, sf_dir, "lineitem").select(*_GROUP_COLS.split(", "))


@check("report_ref_set", f"""SELECT {_GROUP_COLS}, CASE WHEN codes IN (['A', 'N', 'R'], ['A', 'N'], ['N', 'R'], ['A', 'R'])
AND t1 - t0 < INTERVAL 1200 DAY THEN t0 END AS report_ref FROM (SELECT *,
list_sort(list_distinct(list(l_returnflag) OVER g)) AS codes, min(l_shipdate) OVER g AS t0, max(l_shipdate) OVER g AS t1
FROM lineitem WINDOW g AS (PARTITION BY l_orderkey)) x""")
def report_ref_set(spark, sf_dir):
    return phases.report_ref_set(
        _groups(spark, sf_dir), ["l_orderkey"], "l_returnflag", "l_shipdate",
        (("N", "R", "A"), ("N", "A"), ("N", "R"), ("R", "A")), 1200 * 24 * 60)


@check("report_ref_seq", f"""SELECT {_GROUP_COLS}, CASE
WHEN n NOT IN (2, 3) THEN l_shipdate
WHEN n = 3 AND t1 - t0 <= INTERVAL 1200 DAY AND codes = ['N', 'R', 'A'] THEN t0
WHEN n = 2 AND t1 - t0 <= INTERVAL 600 DAY AND codes IN (['N', 'R'], ['N', 'A'], ['R', 'A']) THEN t0 END AS report_ref
FROM (SELECT *, list(l_returnflag) OVER o AS codes, count(*) OVER g AS n, min(l_shipdate) OVER g AS t0,
max(l_shipdate) OVER g AS t1 FROM lineitem WINDOW g AS (PARTITION BY l_orderkey),
o AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey
ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) x""")
def report_ref_seq(spark, sf_dir):
    return phases.report_ref_seq(
        _groups(spark, sf_dir), ["l_orderkey"], "l_returnflag", "l_shipdate", ["l_linenumber", "l_partkey"],
        (("N", "R", "A"),), (("N", "R"), ("N", "A"), ("R", "A")), 1200 * 24 * 60, 600 * 24 * 60)


@check("combine_phases", f"""WITH {FLIGHTS} SELECT "ESN", reportdatetime, row_sum FROM fl""")
def combine_phases(spark, sf_dir):
    return phases.combine_phases(flights(spark, sf_dir), ["ESN", "reportdatetime", "row_sum"])


@check("common_installations", """SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey
HAVING count(DISTINCT l_returnflag) = 3""")
def common_installations(spark, sf_dir):
    d = V.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_returnflag").alias(S.PHASE))
    return phases.common_installations(d, ["l_partkey", "l_suppkey"], ("N", "R", "A"))


def _increments(spark, sf_dir):
    """Stored and new rows that overlap: the inclusive re-read of a checkpoint."""
    e = V.table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("ESN"), F.expr(V.PHASE_SQL).alias("phase"),
        F.col("ts").alias("reportdatetime"), "value")
    mark = F.lit(MARK).cast("timestamp_ntz")
    old = e.where(bt("reportdatetime") <= mark).withColumn("origin", F.lit("stored"))
    return old, e


_OVERLAP = """SELECT event_id, user_id AS "ESN", {phase} AS phase, ts AS reportdatetime, value,
CASE WHEN ts <= TIMESTAMP '2024-01-20 12:00:00' THEN 'stored' END AS origin FROM events""".format(phase=V.PHASE_SQL)


@check("dedup_keep_history", _OVERLAP)
def dedup_keep_history(spark, sf_dir):
    old, new = _increments(spark, sf_dir)
    return history.dedup_keep_history(old, new, ["event_id", "ESN", "phase", "reportdatetime", "value"])


@check("dedup_report_key", f"""SELECT event_id, "ESN", phase, reportdatetime, origin,
CASE WHEN origin = 'stored' THEN value ELSE value + 1 END AS value FROM ({_OVERLAP}) x""")
def dedup_report_key(spark, sf_dir):
    old, new = _increments(spark, sf_dir)
    return history.dedup_report_key(old, new.withColumn("value", bt("value") + 1), ["phase", "ESN", "reportdatetime"])


@check("merge_history", f"""SELECT event_id, "ESN", phase, reportdatetime, value, origin FROM (
SELECT *, row_number() OVER (PARTITION BY phase, "ESN" ORDER BY reportdatetime DESC, event_id DESC) AS rn
FROM ({_OVERLAP}) x) y WHERE rn <= 7""")
def merge_history(spark, sf_dir):
    old, new = _increments(spark, sf_dir)
    return history.merge_history(
        old, new, ["event_id", "ESN", "phase", "reportdatetime", "value"], 7, order=["reportdatetime", "event_id"])


@check("dedup_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_suppkey FROM lineitem")
def dedup_rows(spark, sf_dir):
    return history.dedup_rows(V.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_suppkey"))


_NEWEST = """SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
FROM {source}) x WHERE rn <= {n}"""


@check("latest_n_per_engine", _NEWEST.format(
    cols="l_suppkey, " + V.SERIES_ORDER_SQL, key="l_suppkey",
    order=", ".join(f"{c} DESC" for c in V.SERIES_ORDER), source="lineitem", n=250))
def latest_n_per_engine(spark, sf_dir):
    d = V.table(spark, sf_dir, "lineitem").select("l_suppkey", *V.SERIES_ORDER)
    return history.latest_n(d, 250, V.SERIES_KEYS, V.SERIES_ORDER)


@check("latest_n_clean", _NEWEST.format(
    cols="user_id, ts, event_type", key="user_id", order="ts DESC, event_type DESC", n=20,
    source="(SELECT DISTINCT CASE WHEN value > 50 THEN NULL ELSE user_id END AS user_id, ts, event_type FROM events) e"
           " WHERE user_id IS NOT NULL"))
def latest_n_clean(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select(
        F.when(bt("value") <= 50, bt("user_id")).alias("user_id"), "ts", "event_type")
    return history.latest_n_clean(e.unionByName(e), 20, ["user_id"], ["ts", "event_type"])


@check("union_by_name", """SELECT event_id, user_id, CAST(NULL AS DOUBLE) AS value, ts FROM events
UNION ALL SELECT event_id, NULL, value, ts FROM events""")
def union_by_name(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    return history.union_by_name(e.select("event_id", "user_id", "ts"), e.select("ts", "value", "event_id"))
