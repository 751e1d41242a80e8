"""Scans, readers, writers and state (queries on whole tables)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.registry import check, quoted, r5
from fleethealth.functions import bt
from fleethealth.operators import clean, deltas, fit, history, phases
from fleethealth.session import scratch_dir
from fleethealth.sources import reports as R, state
from fleethealth.sources.signatures import load_signatures

KEYS = [S.PHASE, "ESN", "reportdatetime", "ACID", "ENGPOS"]
FLEET = f"f AS ({V.FLEET_SQL})"
_SIX = ["ESN", "reportdatetime", "operator", "equipmentid", "ACID", "ENGPOS"]
_ON = " AND ".join(f'{{0}}."{c}" = {{1}}."{c}"' for c in [S.PHASE, *_SIX])


def _scan_sql(temps: bool) -> str:
    cols = [f'da."{c}"' for c in [S.PHASE, *S.IDENTITY, *S.MEASURED, *S.AMBIENT]]
    cols += [f'{"e2" if temps and c in S.KELVIN_COLUMNS else "e"}."{c}"' for c in S.NOMINAL]
    sql = f"SELECT {', '.join(cols)} FROM f da JOIN f e ON {_ON.format('da', 'e')}"
    if temps:
        sql += f" JOIN f e2 ON {_ON.format('da', 'e2')}"
    sql += ' WHERE da."T20__DEGC" <> 0 AND e."P20__PSI" <> 0'
    return sql + (" AND e2.\"P20__PSI\" <> 5 AND da.phase = 'cruise'" if temps else " AND da.phase <> 'cruise'")


def _source(spark, sf_dir, phase, columns, dead):
    """A source table as delivered: original key names and a deleted mark."""
    names = {v: k for k, v in R.SOURCE_KEYS.items()}
    f = V.fleet(spark, sf_dir).where(bt(S.PHASE) == phase)
    return f.select(
        *[bt(c).alias(names[c]) for c in _SIX], bt("datestored").alias(R.STORED), *map(bt, columns),
        F.when(dead, 1).otherwise(0).alias(R.DELETED))


@check("scan_reports", f"WITH {FLEET} {_scan_sql(True)} UNION ALL {_scan_sql(False)}")
def scan_reports(spark, sf_dir):
    out = []
    for phase in S.PHASES:
        measured = _source(spark, sf_dir, phase, S.MEASURED + S.AMBIENT, bt("T20__DEGC") == 0)
        nominal = _source(spark, sf_dir, phase, S.NOMINAL, bt("P20__PSI") == 0)
        temps = (_source(spark, sf_dir, phase, S.KELVIN_COLUMNS, bt("P20__PSI") == 5)
                 if phase == "cruise" else None)
        out.append(R.scan_reports(measured, nominal, phase, temps))
    return history.union_by_name(*out)


@check("scan_since_checkpoint", f"""WITH {FLEET}
SELECT 'checkpoint' AS mode, {quoted(KEYS)} FROM f WHERE reportdatetime >= TIMESTAMP '2024-01-12 06:00:00'
UNION ALL SELECT 'default', {quoted(KEYS)} FROM f WHERE reportdatetime >= TIMESTAMP '2024-01-17 00:00:00'""")
def scan_since_checkpoint(spark, sf_dir):
    f = V.fleet(spark, sf_dir).select(*KEYS)
    now = datetime(2024, 1, 31)
    marked = R.since_checkpoint(f, datetime(2024, 1, 12, 6), now)
    default = R.since_checkpoint(f, None, now)
    return marked.select(F.lit("checkpoint").alias("mode"), *KEYS).unionByName(
        default.select(F.lit("default").alias("mode"), *KEYS))


@check("scan_time_range", f"""WITH {FLEET} SELECT {quoted(KEYS)} FROM f
WHERE reportdatetime BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'""")
def scan_time_range(spark, sf_dir):
    return R.time_range(V.fleet(spark, sf_dir), datetime(2024, 1, 5), datetime(2024, 1, 22, 12)).select(*KEYS)


@check("preview_top_n", "SELECT event_id, ts, user_id, value FROM events ORDER BY ts, event_id LIMIT 10")
def preview_top_n(spark, sf_dir):
    return R.preview(V.table(spark, sf_dir, "events"), ["ts", "event_id"], 10,
                     ["event_id", "ts", "user_id", "value"])


def _typed_sql(columns) -> str:
    out = []
    for c in columns:
        t = S.column_type(c)
        if isinstance(t, T.DoubleType):
            out.append(f'{r5(chr(34) + c + chr(34))} AS "{c}"')
        elif isinstance(t, T.TimestampNTZType):
            out.append(f"date_trunc('second', \"{c}\") AS \"{c}\"")
        else:
            out.append(f'"{c}"')
    return ", ".join(out)


@check("read_history", f"WITH {FLEET} SELECT {_typed_sql(S.REPORT_COLUMNS)} FROM f")
def read_history(spark, sf_dir):
    path = scratch_dir(spark, "history-csv")
    f = V.fleet(spark, sf_dir).select(*S.REPORT_COLUMNS)
    (f.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in S.TIME_COLUMNS})
     .write.option("header", True).csv(path))
    return R.read_history(spark, path, S.REPORT_COLUMNS)


@check("clean_reports", f"""SELECT user_id AS "ESN", date_trunc('second', ts) AS reportdatetime,
date_trunc('second', ts) AS datestored, {r5('value / 7')} AS reading, value / 7 AS days_since_prev
FROM events WHERE event_id % 10 <> 0 AND event_id % 11 <> 0""")
def clean_reports(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = V.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ESN"),
        F.when(F.col("event_id") % 10 == 0, "bad_date").otherwise(text).alias("reportdatetime"),
        F.when(F.col("event_id") % 11 == 0, "2024-13-45 99:00:00").otherwise(text).alias("datestored"),
        (F.col("value") / 7).alias("reading"), (F.col("value") / 7).alias("days_since_prev"))
    return clean.clean_reports(raw)


@check("parse_mixed_timestamps", """SELECT event_id, CASE event_id % 4
WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN ts ELSE NULL END AS at
FROM events""")
def parse_mixed_timestamps(spark, sf_dir):
    kind = F.col("event_id") % 4
    raw = V.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise("no time").alias("at"))
    return clean.parse_mixed_timestamps(raw, ["at"])


@check("read_csv_trimmed", f"""SELECT user_id AS "ESN", date_trunc('second', ts) AS reportdatetime,
date_trunc('second', ts) AS datestored, event_type AS operator, {r5('value')} AS reading
FROM events WHERE event_id % 13 <> 0""")
def read_csv_trimmed(spark, sf_dir):
    path = scratch_dir(spark, "padded-csv")
    pad = lambda c: F.concat(F.lit("  "), c.cast("string"), F.lit(" "))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    V.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Unnamed: 0"),
        pad(F.col("user_id")).alias(" ESN "),
        pad(F.when(F.col("event_id") % 13 == 0, "never").otherwise(at)).alias("reportdatetime "),
        pad(at).alias(" datestored"), pad(F.col("event_type")).alias("operator"),
        pad(F.col("value")).alias(" reading"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return R.read_csv_trimmed(spark, path, {"ESN": "bigint", "reading": "double"})


@check("read_stage", f"""WITH {FLEET} SELECT 'parquet' AS source, phase, "ESN", "MN1" FROM f
UNION ALL SELECT 'csv', phase, "ESN", "MN1" FROM f""")
def read_stage(spark, sf_dir):
    f = V.fleet(spark, sf_dir).select(S.PHASE, "ESN", "MN1")
    parquet = state.write_stage(f, scratch_dir(spark, "stage"))
    csv = state.write_stage(f, scratch_dir(spark, "stage-csv"), fmt="csv")
    a = R.read_stage(spark, parquet).withColumn("source", F.lit("parquet"))
    b = R.read_stage_csv(spark, f"{csv}/*", S.struct_of(["ESN", "MN1"])).withColumn("source", F.lit("csv"))
    return a.unionByName(b)


@check("load_signatures", "SELECT vec_id AS sig_pos, " + V.SIG_ID_SQL + " AS sig_id, 'cruise' AS phase, "
       + ", ".join(f"({e}) * 100 AS \"{c}\"" for e, c in zip(V.FOLD_SQL, S.SIGNATURE_COLUMNS))
       + f" FROM embeddings WHERE vec_id < {V.SIGNATURE_COUNT}")
def load(spark, sf_dir):
    # Three leading columns, which the reader skips, then the nine parameters.
    heads = dict(zip(["h1", "h2", "h3", *S.SIGNATURE_COLUMNS], [*V.FOLD_SPARK[:3], *V.FOLD_SPARK]))
    sheet = V.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sig_pos"), F.expr(V.SIG_ID_SQL).alias("sig_id"),
        *[F.expr(e).alias(c) for c, e in heads.items()])
    return load_signatures(sheet, range(V.SIGNATURE_COUNT), phase="cruise")


@check("signature_norms", "SELECT vec_id AS sig_pos, "
       + ", ".join(f'{e} AS "{c}"' for e, c in zip(V.FOLD_SQL, S.SIGNATURE_COLUMNS))
       + ", " + r5("sqrt(" + " + ".join(
           f"({e}) * ({e})" for e in V.FOLD_SQL) + ")")
       + ' AS "Vector_Norm" FROM embeddings')
def signature_norms(spark, sf_dir):
    sheet = V.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sig_pos"),
        *[F.expr(e).alias(c) for e, c in zip(V.FOLD_SPARK, S.SIGNATURE_COLUMNS)])
    from fleethealth.functions import r5 as round5
    return fit.signature_norms(sheet).drop("vec").withColumn("Vector_Norm", round5(F.col("Vector_Norm")))


@check("low_watermark", f"""WITH {FLEET} SELECT min(m) AS "checkpoint" FROM
(SELECT phase, max(reportdatetime) AS m FROM f GROUP BY phase) x""")
def low_watermark(spark, sf_dir):
    return state.low_watermark(V.fleet(spark, sf_dir))


@check("latest_timestamp", """SELECT max(date_trunc('second', ts)) AS latest FROM events WHERE event_id % 10 <> 0""")
def latest_timestamp(spark, sf_dir):
    text = V.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 10 == 0, "never")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"))
    return state.latest_timestamp(text, "at")


ROW_SUM_SQL = "CAST(event_id % 7 AS BIGINT)"
HISTORY = f"SELECT phase, \"ESN\", reportdatetime, {ROW_SUM_SQL} AS row_sum FROM ({V.REPORTS_SQL}) r"


# Columns of the three outputs; each row fills those of its own.
_OUTPUTS = {
    "history": ["phase", "ESN", "reportdatetime", "row_sum"],
    "merged": ["ESN", *[f"{c}_{p}" for p in ("takeoff", "climb", "cruise") for c in ("reportdatetime", "row_sum")], "merge_sum", "DN_FIRE", "DN_FIRE_TIME"],
    "summary": ["ESN", "DN_FIRED", "DN_FIRES", "first_fire", "last_fire"],
}
_ALL_OUTPUTS = list(dict.fromkeys(c for cols in _OUTPUTS.values() for c in cols))


def write_outputs_sql() -> str:
    from fleethealth.checks import match_queries as M

    back = (("takeoff", "take-off", 55), ("climb", "climb", 30))
    near = ", ".join(f"CASE WHEN d.reportdatetime - {a}.reportdatetime < INTERVAL {m} MINUTE THEN {a}.{c} END AS {c}_{a}"
                     for a, _, m in back for c in ("reportdatetime", "row_sum"))
    asof = " ".join(M._asof(a, phase, ">", "h") for a, phase, _ in back)
    row = lambda name, source: (f"SELECT '{name}' AS output, " + ", ".join(
        f'"{c}"' if c in _OUTPUTS[name] else f'NULL AS "{c}"' for c in _ALL_OUTPUTS) + f" FROM {source}")
    summary = M.SUMMARY.format(keys='"ESN"').replace('"First DN fire"', "first_fire").replace('"Last DN fire"', "last_fire")
    return f"""WITH h AS ({HISTORY}), m AS (SELECT d."ESN", d.reportdatetime AS reportdatetime_cruise, d.row_sum AS row_sum_cruise,
{near} FROM (SELECT * FROM h WHERE phase = 'cruise') d {asof}), {M.ALERTS}, s AS ({summary})
{row('history', 'h')} UNION ALL {row('merged', 'al')} UNION ALL {row('summary', 's')}"""


def write_outputs(spark, sf_dir):
    """The rows of all three outputs as they are read back."""
    rows = V.reports(spark, sf_dir).select("phase", "ESN", "reportdatetime", F.expr(ROW_SUM_SQL).alias("row_sum"))
    paths = state.write_outputs(
        scratch_dir(spark, "outputs"), rows,
        lambda d: phases.phase_asof(d, keys=["ESN"]).transform(phases.alert_flag),
        lambda d: phases.alert_summary(d, keys=["ESN"]).withColumnsRenamed(
            {"First DN fire": "first_fire", "Last DN fire": "last_fire"}))
    kept = {"history": R.read_stage(spark, paths["history"])} | {n: spark.read.parquet(paths[n]) for n in ("merged", "summary")}
    return history.union_by_name(*[
        d.select(F.lit(n).alias("output"), *map(bt, _OUTPUTS[n])) for n, d in kept.items()])


@check("append_unique", "SELECT DISTINCT event_id, ts AS reportdatetime, user_id, event_type, value FROM events")
def append_unique(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("reportdatetime"), "user_id", "event_type", "value")
    base = e.where(F.col("event_type").isin("view", "click", "purchase"))
    new = e.where(F.col("event_type").isin("click", "error", "signup"))
    return history.append_unique(base, new.unionByName(new))


_NORMAL = """SELECT c_nationkey + {0} AS nation, CASE WHEN c_custkey % 2 = {1} THEN c_mktsegment
ELSE '  ' || lower(c_mktsegment) || ' ' END AS segment, {2} AS src FROM customer"""


@check("append_dedup_normalized", f"""SELECT nation, segment FROM (
SELECT nation, segment, row_number() OVER (PARTITION BY nation, lower(trim(segment)) ORDER BY src, segment) AS rn
FROM ({_NORMAL.format(0, 0, 0)} UNION ALL {_NORMAL.format(5, 1, 1)}) u) x WHERE rn = 1""")
def append_dedup_normalized(spark, sf_dir):
    c = V.table(spark, sf_dir, "customer")
    segment = lambda odd: F.when(F.col("c_custkey") % 2 == odd, F.col("c_mktsegment")).otherwise(
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).alias("segment")
    base = c.select(F.col("c_nationkey").alias("nation"), segment(0))
    new = c.select((F.col("c_nationkey") + 5).alias("nation"), segment(1))
    return history.append_dedup_normalized(base, new, ["segment"])


@check("retain_within_bytes", """SELECT event_id, ts, props FROM (SELECT event_id, ts, props,
sum(octet_length(encode(props)) + 20) OVER (ORDER BY ts DESC, event_id DESC) AS used FROM events) x
WHERE used <= 150000""")
def retain_within_bytes(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select("event_id", "ts", "props")
    size = (F.octet_length("props") + 20).cast("long")
    return history.retain_within_bytes(e, 150_000, time="ts", ties=["event_id"], size=size)


_PCT = {p.name: f'("{p.measured}" - "{p.nominal}") * 100 / "{p.nominal}"' for p in S.PARAMETERS}


@check("by_phase", f"""WITH {FLEET} SELECT phase, count(*) AS reports, max({r5(_PCT['PS26'])}) AS highest,
min({r5(_PCT['P160'])}) AS lowest FROM f GROUP BY phase""")
def by_phase(spark, sf_dir):
    d = deltas.percent_delta(V.fleet(spark, sf_dir))
    return d.groupBy(S.PHASE).agg(
        F.count(F.lit(1)).alias("reports"), F.max("PS26__DEL_PC").alias("highest"),
        F.min("P160__DEL_PC").alias("lowest"))
