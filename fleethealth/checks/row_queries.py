"""Filters, casts and row-local expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.registry import check, quoted, r5
from fleethealth.checks.source_queries import FLEET, KEYS, _PCT, _typed_sql
from fleethealth.functions import bt
from fleethealth.operators import clean, deltas, stats

_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in S.REPORT_COLUMNS)
RANGE_SQL = " OR ".join(
    "(phase = '%s' AND %s)" % (p, " AND ".join(f'"{c}" BETWEEN {lo} AND {hi}' for c, (lo, hi) in lim.items()))
    for p, lim in S.RANGE_LIMITS.items())


@check("drop_null_rows", f"WITH {FLEET} SELECT {quoted(KEYS)} FROM f WHERE {_COMPLETE}")
def drop_null_rows(spark, sf_dir):
    return clean.drop_null_rows(V.fleet(spark, sf_dir), S.REPORT_COLUMNS).select(*KEYS)


@check("drop_sentinel", f"""WITH {FLEET}, g AS (SELECT * REPLACE (CASE WHEN "T20__DEGC" = 3 THEN NULL ELSE "NH__PC" END
AS "NH__PC", CASE WHEN "T20__DEGC" = 4 THEN NULL ELSE "PS160__PSI" END AS "PS160__PSI") FROM f)
SELECT {quoted(KEYS)}, "NH__PC", "PS160__PSI" FROM g
WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in S.REQUIRED_READINGS)}""")
def drop_sentinel(spark, sf_dir):
    f = V.fleet(spark, sf_dir).withColumns({
        "NH__PC": F.when(bt("T20__DEGC") == 3, S.SENTINEL).otherwise(bt("NH__PC")),
        "PS160__PSI": F.when(bt("T20__DEGC") == 4, S.SENTINEL).otherwise(bt("PS160__PSI"))})
    return clean.drop_sentinel(f).select(*KEYS, "NH__PC", "PS160__PSI")


@check("range_filter", f"WITH {FLEET} SELECT {quoted(KEYS)} FROM f WHERE {RANGE_SQL}")
def range_filter(spark, sf_dir):
    return clean.range_filter(V.fleet(spark, sf_dir)).select(*KEYS)


@check("kelvin_to_celsius", f"""WITH {FLEET} SELECT {quoted(KEYS)},
{", ".join(f'{r5(chr(34) + c + chr(34) + " - 273.15::DOUBLE")} AS "{c}"' for c in S.KELVIN_COLUMNS)} FROM f""")
def kelvin_to_celsius(spark, sf_dir):
    from fleethealth.functions import r5 as round5
    c = clean.kelvin_to_celsius(V.fleet(spark, sf_dir))
    return c.select(*KEYS, *[round5(bt(x)).alias(x) for x in S.KELVIN_COLUMNS])


_WITHOUT_TIMES = [c for c in S.REPORT_COLUMNS if c not in S.TIME_COLUMNS]


@check("cast_and_round", f"WITH {FLEET} SELECT {_typed_sql(_WITHOUT_TIMES)}, reportdatetime FROM f")
def cast_and_round(spark, sf_dir):
    f = V.fleet(spark, sf_dir).select(*_WITHOUT_TIMES, "reportdatetime")
    text = f.withColumns({c: bt(c).cast("string") for c in S.INT_COLUMNS})
    return clean.cast_and_round(text)


@check("enforce_schema", """SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR)
END AS BIGINT) AS "ESN", value AS reading, CAST(NULL AS BIGINT) AS "SISTER_ESN", CAST(NULL AS DOUBLE) AS "PS26__DEL_PC",
CAST(0 AS BIGINT) AS "FlagSV" FROM events""")
def enforce_schema(spark, sf_dir):
    raw = V.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("ESN"),
        F.col("value").cast("string").alias("reading"))
    wanted = S.struct_of(["ESN", "reading", "SISTER_ESN", "PS26__DEL_PC", "FlagSV"])
    return clean.enforce_schema(raw, wanted, {"FlagSV": 0})


@check("cast_by_pattern", """SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS "VAR1_IDENTIFIER50",
CAST(l_partkey AS VARCHAR) AS "VAR2_IDENTIFIER400", l_quantity AS "VAR1_SHIFT50",
l_suppkey AS "MY_VAR1_IDENTIFIER50" FROM lineitem""")
def cast_by_pattern(spark, sf_dir):
    return clean.cast_by_pattern(V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("VAR1_IDENTIFIER50"),
        F.col("l_partkey").alias("VAR2_IDENTIFIER400"), F.col("l_quantity").alias("VAR1_SHIFT50"),
        F.col("l_suppkey").alias("MY_VAR1_IDENTIFIER50")))


MARK = datetime(2024, 1, 20, 12)
MARK_SQL = "TIMESTAMP '2024-01-20 12:00:00'"
FLAGGED = f"SELECT *, CAST(CASE WHEN reportdatetime > {MARK_SQL} THEN 1 ELSE 0 END AS BIGINT) AS \"NEW_FLAG\""


@check("new_flag", f"{FLAGGED} FROM (SELECT event_id, ts AS reportdatetime FROM events) r")
def new_flag(spark, sf_dir):
    return clean.new_flag(
        V.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("reportdatetime")), MARK)


@check("only_new", f"""WITH r AS ({FLAGGED} FROM (SELECT event_id, ts AS reportdatetime, value FROM events) r)
SELECT event_id, "NEW_FLAG", CASE WHEN "NEW_FLAG" = 1 THEN value * 2 END AS doubled FROM r
WHERE "NEW_FLAG" = 0 OR value > 10""")
def only_new(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("reportdatetime"), "value")
    done = clean.only_new(clean.new_flag(e, MARK), lambda d: d.where(bt("value") > 10).withColumn(
        "doubled", bt("value") * 2))
    return done.select("event_id", "NEW_FLAG", "doubled")


DELTA_SQL = ", ".join(
    f'CASE WHEN "NEW_FLAG" = 1 THEN {r5(_PCT[p.name])} END AS "{p.name}__DEL_PC"' for p in S.PARAMETERS)


@check("percent_delta", f"""WITH {FLEET}, r AS ({FLAGGED} FROM f)
SELECT {quoted(KEYS)}, {DELTA_SQL} FROM r""")
def percent_delta(spark, sf_dir):
    d = deltas.percent_delta(clean.new_flag(V.fleet(spark, sf_dir), MARK))
    return d.select(*KEYS, *S.DELTA)


@check("percent_delta_zero_nominal", f"""SELECT l_orderkey, l_linenumber, l_partkey,
CASE WHEN l_discount <> 0 THEN {r5('(l_quantity - l_discount) * 100 / l_discount')} END AS "X__DEL_PC" FROM lineitem""")
def percent_delta_zero_nominal(spark, sf_dir):
    p = [S.Parameter("X", "l_quantity", "l_discount", None)]
    d = deltas.percent_delta(V.table(spark, sf_dir, "lineitem"), p)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "X__DEL_PC")


@check("row_norm", """SELECT l_orderkey, l_linenumber, l_partkey,
round_even(sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax), 8) AS l2,
round_even(abs(l_quantity) + abs(l_discount) + abs(l_tax), 8) AS l1,
round_even(greatest(abs(l_quantity), abs(l_discount), abs(l_tax)), 8) AS linf FROM lineitem""")
def row_norm(spark, sf_dir):
    cols = ["l_quantity", "l_discount", "l_tax"]
    d = V.table(spark, sf_dir, "lineitem")
    for name, o in (("l2", 2), ("l1", 1), ("linf", float("inf"))):
        d = deltas.row_norm(d, cols, name, o)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l2", "l1", "linf")


# Fault labels of line items, for the damage statistics.
VARS = {
    "VAR1_IDENTIFIER{n}": "CASE l_returnflag WHEN 'R' THEN 'IPC ETA' WHEN 'A' THEN 'HPC ETA' ELSE 'OTHER' END",
    "VAR2_IDENTIFIER{n}": "CASE WHEN l_linestatus = 'O' AND l_linenumber > 3 THEN 'IPC ETA' END",
    "VAR3_IDENTIFIER{n}": "CASE WHEN l_linenumber = {line} THEN 'HPC ETA' END",
    "VAR1_SHIFT{n}": "l_discount * 10 - 1",
    "VAR2_SHIFT{n}": "CASE WHEN l_linenumber <> 5 THEN l_tax * 10 - 1 END",
    "VAR3_SHIFT{n}": "l_quantity / 50 - 1",
}


def damage_rows(spark, sf_dir, lags):
    li = V.table(spark, sf_dir, "lineitem")
    return li.select(
        "l_suppkey", *V.SERIES_ORDER,
        *[F.expr(e.format(line=1 + lag // 100 % 4)).alias(n.format(n=lag)) for lag in lags for n, e in VARS.items()])


def damage_sql(lags) -> str:
    cols = [f'{e.format(line=1 + lag // 100 % 4)} AS "{n.format(n=lag)}"' for lag in lags for n, e in VARS.items()]
    return f"SELECT l_suppkey, {V.SERIES_ORDER_SQL}, {', '.join(cols)} FROM lineitem"


def shift_sql(comp: str, n: int) -> str:
    whens = " ".join(f"WHEN \"VAR{i}_IDENTIFIER{n}\" = '{comp} ETA' THEN -\"VAR{i}_SHIFT{n}\"" for i in (3, 2, 1))
    return f"CASE {whens} END"


ITEM = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


LAGS = S.Settings().lags
_SHIFTS = [(c, n) for n in LAGS for c in S.COMPONENTS]


@check("damage_shift", f"SELECT {', '.join(ITEM)}, "
       + ", ".join(f'{r5(shift_sql(c, n))} AS "{S.damage_column(c, n)}"' for c, n in _SHIFTS)
       + f" FROM ({damage_sql(LAGS)}) d")
def damage_shift(spark, sf_dir):
    from fleethealth.functions import r5 as round5
    d = stats.damage_shift(damage_rows(spark, sf_dir, LAGS), LAGS)
    return d.select(*ITEM, *[round5(bt(S.damage_column(c, n))).alias(S.damage_column(c, n)) for c, n in _SHIFTS])


@check("exceedance_count", """SELECT l_orderkey, l_linenumber, l_partkey,
CASE WHEN l_linenumber > 1 THEN CAST(coalesce(CAST(d >= 0.07 AS INT), 0) + coalesce(CAST(t >= 0.07 AS INT), 0) AS BIGINT)
END AS row_sum FROM (SELECT *, l_discount AS d, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS t FROM lineitem) x""")
def exceedance_count(spark, sf_dir):
    d = V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_discount").alias("IPC_FRACTION_GT_0.2_50"),
        F.when(F.col("l_returnflag") != "N", F.col("l_tax")).alias("HPC_FRACTION_GT_0.2_50"),
        F.when(F.col("l_linenumber") > 1, 1).otherwise(0).cast("long").alias(S.NEW_FLAG))
    return stats.exceedance_count(d).select("l_orderkey", "l_linenumber", "l_partkey", "row_sum")


@check("init_columns", f"""SELECT event_id, CASE WHEN ts >= {MARK_SQL} THEN NULL ELSE value END AS "PS26__DEL_PC",
CASE WHEN ts >= {MARK_SQL} THEN 0 ELSE user_id END AS "SISTER_ESN",
CAST(CASE WHEN ts >= {MARK_SQL} THEN 0 END AS BIGINT) AS "FlagSV" FROM events""")
def init_columns(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("reportdatetime"), F.col("value").alias("PS26__DEL_PC"),
        F.col("user_id").alias("SISTER_ESN"))
    return clean.init_columns(e, ["PS26__DEL_PC", "SISTER_ESN", "FlagSV"], MARK).drop("reportdatetime")
