"""The full chain on the fleet view, in batch and as a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.fit_queries import _sigs, fit_sql, label
from fleethealth.checks.match_queries import BACK, SUMMARY, _asof, _near
from fleethealth.checks.registry import check, r5
from fleethealth.checks.row_queries import RANGE_SQL, _COMPLETE
from fleethealth.checks.source_queries import FLEET
from fleethealth.functions import bt
from fleethealth.plans import batch, chain
from fleethealth.plans.store import FleetStore
from fleethealth.session import scratch_dir
from fleethealth.streaming import jobs, once, state, stateful

# The views span 30 days with about a report a day and phase: short windows and
# four short lags, wide tolerances, a low alert threshold. The chain itself is the live one.
SETTINGS = S.Settings(
    lags=(1, 2, 4, 8), window_semi_width=1, min_sv_dur=4.0, min_exceedances=1,
    takeoff_minutes=48 * 60, climb_minutes=24 * 60)
FITTED = [p for p in S.PARAMETERS if p.signature]


def run(spark, sf_dir, settings=SETTINGS) -> chain.Result:
    return chain.run_increment(V.fleet(spark, sf_dir), _sigs(spark, sf_dir, S.PHASES), None, settings)


# -- the same chain as SQL ---------------------------------------------------

_ROUNDED = ", ".join(f'{r5(chr(34) + c + chr(34) + (" - 273.15::DOUBLE" if c in S.KELVIN_COLUMNS else ""))} AS "{c}"'
                     for c in S.MEASURED + S.NOMINAL)
_PCT = ", ".join(f'{r5(f"""("{p.measured}" - "{p.nominal}") * 100 / "{p.nominal}" """)} AS d_{p.name}' for p in S.PARAMETERS)
_ENGINE = 'PARTITION BY phase, "ESN" ORDER BY reportdatetime, "DSCID", "ACID", "ENGPOS"'
_IDS = 'phase, "ESN", operator, "ACID", "ENGPOS", "DSCID", reportdatetime'


_GAP = """coalesce(round_even((epoch_us(reportdatetime) - lag(epoch_us(reportdatetime)) OVER (PARTITION BY phase,
"ESN", "ACID", "ENGPOS" ORDER BY reportdatetime)) / 86400000000.0::DOUBLE, 1), 0) AS gap"""


def trend_ctes(context: str = "batch") -> str:
    """Ingest to lag deltas (t_<P> = mean, l<n>_<P> = lag delta), one row per paired report.

    Day gaps count all reports in batch context, paired ones in history context.
    """
    before, after = (f", {_GAP}", "") if context == "batch" else ("", f", {_GAP}")
    sister = ", ".join(
        f"{r5(f'd_{p.name} - CASE WHEN rn = 1 THEN lead(d_{p.name}) OVER w ELSE lag(d_{p.name}) OVER w END')} AS e_{p.name}"
        for p in S.PARAMETERS)
    means = ", ".join(
        f"CASE WHEN count(CASE WHEN ok THEN e_{p.name} END) OVER w = 3 THEN {r5(f'avg(CASE WHEN ok THEN e_{p.name} END) OVER w')} END AS t_{p.name}"
        for p in S.PARAMETERS)
    lags = ", ".join(f"{r5(f't_{p.name} - lag(t_{p.name}, {n}) OVER w')} AS l{n}_{p.name}"
                     for n in SETTINGS.lags for p in S.PARAMETERS)
    return f"""{FLEET},
q AS (SELECT {_IDS}, {_ROUNDED} FROM f WHERE {_COMPLETE} AND ({RANGE_SQL})),
gaps AS (SELECT *, {_PCT}{before} FROM q),
pairs AS (SELECT *, row_number() OVER w AS rn, {sister},
CASE WHEN row_number() OVER w = 1 THEN lead("ESN") OVER w ELSE lag("ESN") OVER w END AS sister FROM gaps
WHERE (phase, "ACID", reportdatetime) IN (SELECT (phase, "ACID", reportdatetime) FROM q GROUP BY ALL HAVING count(DISTINCT "ESN") = 2)
WINDOW w AS (PARTITION BY phase, "ACID", reportdatetime ORDER BY "ESN")),
flags AS (SELECT *, row_number() OVER w > 1 AND NOT gap > 4 AND coalesce(lag(sister) OVER w = sister, false) AS ok
FROM (SELECT *{after} FROM pairs) p WINDOW w AS ({_ENGINE})),
means AS (SELECT *, {means} FROM flags WINDOW w AS ({_ENGINE} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
lags AS (SELECT *, {lags}, row_number() OVER (ORDER BY phase, "ESN", reportdatetime) AS oid FROM means WINDOW w AS ({_ENGINE}))"""


def chain_ctes(max_size: int, context: str = "batch") -> str:
    ctes = [trend_ctes(context)]
    for n in SETTINGS.lags:
        complete = " AND ".join(f"l{n}_{p.name} IS NOT NULL" for p in FITTED)
        vector = ", ".join(f"l{n}_{p.name} AS o{i + 1}" for i, p in enumerate(FITTED))
        ctes.append(f"obs{n} AS (SELECT oid, {vector} FROM lags WHERE {complete})")
        ctes.append(fit_sql(f"obs{n}", max_size, prefix=f"p{n}_"))
    stats, tags, joins = [], [], []
    for n in SETTINGS.lags:
        joins.append(f"LEFT JOIN p{n}_fits x{n} ON x{n}.oid = lags.oid")
        for comp in S.COMPONENTS:
            hit = lambda k, size: f"(x{n}.f.size >= {size} AND {label(f'x{n}.f.{k}')} = '{comp} ETA')"
            hits = {1: hit("i", 1), 2: hit("j", 2), 3: hit("k", 3)}
            whens = " ".join(f"WHEN {hits[i]} THEN -x{n}.f.x{i}" for i in (3, 2, 1))
            tags += [f"CASE {whens} END AS v_{comp}{n}", f"coalesce({' OR '.join(hits.values())}, false) AS m_{comp}{n}"]
            for t in SETTINGS.thresholds:
                w = f"""OVER (PARTITION BY phase, "ESN", m_{comp}{n} ORDER BY reportdatetime ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"""
                stats.append(f"CASE WHEN m_{comp}{n} AND avg(CASE WHEN v_{comp}{n} > {t} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) {w}"
                             f" >= 0.07 THEN 1 ELSE 0 END")
    ctes.append(f"tagged AS (SELECT lags.*, {', '.join(tags)} FROM lags {' '.join(joins)})")
    ctes.append(f"fl AS (SELECT *, CAST({' + '.join(stats)} AS BIGINT) AS row_sum FROM tagged)")

    def near(a, hours):
        ok = f"d.reportdatetime - {a}.reportdatetime < INTERVAL {hours} HOUR"
        return (f"CASE WHEN {ok} THEN {a}.reportdatetime END AS reportdatetime_{a},"
                f" CASE WHEN {ok} THEN {a}.row_sum END AS row_sum_{a}")

    def asof(a, phase):
        return (f"ASOF LEFT JOIN (SELECT * FROM fl WHERE phase = '{phase}') {a} ON "
                + " AND ".join(f'd."{k}" = {a}."{k}"' for k in S.INSTALLATION)
                + f" AND d.reportdatetime > {a}.reportdatetime")

    ctes.append(f"""m AS (SELECT {", ".join(f'd."{k}"' for k in S.INSTALLATION)}, d.reportdatetime AS reportdatetime_cruise,
d.row_sum AS row_sum_cruise, {near('takeoff', 48)}, {near('climb', 24)} FROM (SELECT * FROM fl WHERE phase = 'cruise') d
{asof('takeoff', 'take-off')} {asof('climb', 'climb')})""")
    fire = "coalesce(row_sum_takeoff >= 1 AND row_sum_climb >= 1 AND row_sum_cruise >= 1, false)"
    ctes.append(f"""al AS (SELECT *, CASE WHEN {fire} THEN 'YES' ELSE 'NO' END AS "DN_FIRE",
CASE WHEN {fire} THEN strftime(reportdatetime_takeoff, '%Y-%m-%d %H:%M:%S') END AS "DN_FIRE_TIME" FROM m)""")
    return "WITH " + ", ".join(ctes)


_KEYS = ", ".join(f'"{k}"' for k in S.INSTALLATION)
ALERTS_SQL = f"{chain_ctes(3)} {SUMMARY.format(keys=_KEYS)}"


@check("fleet_alerts", ALERTS_SQL)
def fleet_alerts(spark, sf_dir):
    """Raw reports to the alert summary, up to three signatures per fit."""
    return run(spark, sf_dir).summary


@check("fleet_matches", f"{chain_ctes(3)} SELECT * EXCLUDE (\"DN_FIRE\") RENAME (\"DN_FIRE_TIME\" AS fire_time) FROM al")
def fleet_matches(spark, sf_dir):
    """Every matched flight with its exceedance counts."""
    return run(spark, sf_dir).merged.drop("DN_FIRE", "merge_sum").withColumnRenamed("DN_FIRE_TIME", "fire_time")


_MOVE = ", ".join(f"abs(l2_{p.name})" for p in S.PARAMETERS)


@check("trend_movers", f"""WITH {trend_ctes()} SELECT phase, "ESN", max(greatest({_MOVE})) AS largest_move,
count(greatest({_MOVE})) AS reports FROM lags GROUP BY phase, "ESN" HAVING max(greatest({_MOVE})) IS NOT NULL""")
def trend_movers(spark, sf_dir):
    """Engines whose step-free means moved most; the fit columns are pruned away."""
    return chain.trend_movers(run(spark, sf_dir).stage, 2)


# -- streams -----------------------------------------------------------------

CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
FILES = 4  # of one arrival, and so of one micro-batch


def _arrivals(spark, rows: DataFrame, time: str, late: Column | None = None) -> tuple[str, DataFrame]:
    """Write ``rows`` as arrivals of several files in time order; return the folder
    and the stream. ``late`` rows come with the arrival after their own."""
    path = scratch_dir(spark, "arrivals")
    t = bt(time)
    a, b = (F.lit(c).cast("timestamp_ntz") for c in CUTS)
    turn = F.when(t < a, 0).when(t < b, 1).otherwise(2)
    if late is not None:
        turn = F.least(turn + F.when(late, 1).otherwise(0), F.lit(2))
    for i in range(3):
        rows.where(turn == i).repartition(FILES).write.mode("append").parquet(path)
    return path, spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def _to_parquet(stream: DataFrame, out: str):
    with state.state_partitions(stream.sparkSession):
        return (stream.writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start())


def _finish(query) -> int:
    query.awaitTermination()
    return query.lastProgress["batchId"]


@check("stream_incremental_ingest", f"{chain_ctes(3, 'history')} {SUMMARY.format(keys=_KEYS)}")
def stream_incremental_ingest(spark, sf_dir):
    """Three increments through the chain equal one full run, though every fourth
    pair's second half comes an arrival late."""
    late = (bt("ENGPOS") == 2) & (F.minute(bt(S.TIME)) % 4 == 0)
    _, stream = _arrivals(spark, V.fleet(spark, sf_dir), S.TIME, late)
    root = scratch_dir(spark, "increments")
    settings = replace(SETTINGS, context="history")
    query = jobs.start_incremental(stream, root, _sigs(spark, sf_dir, S.PHASES), settings, delay="30 days")
    return FleetStore(spark, root, settings).summary(_finish(query))


@check("batch_run", f"{chain_ctes(3, 'history')} {SUMMARY.format(keys=_KEYS)}")
def batch_run(spark, sf_dir):
    """Two batch runs, the second from the first one's checkpoint, equal one full run."""
    fleet, root = V.fleet(spark, sf_dir), scratch_dir(spark, "batch")
    settings, sigs = replace(SETTINGS, context="history"), _sigs(spark, sf_dir, S.PHASES)
    batch.run_batch(spark, fleet.where(bt(S.TIME) < F.lit("2024-01-17").cast("timestamp_ntz")), sigs, root, settings)
    last = batch.run_batch(spark, fleet, sigs, root, settings)
    names = {new: old for old, new in batch.SUMMARY_NAMES.items()}
    return spark.read.parquet(f"{last['folder']}/summary").withColumnsRenamed(names)


@check("stream_dedup", 'SELECT event_id, user_id AS "ESN", ts AS reportdatetime FROM events')
def stream_dedup(spark, sf_dir):
    """Every report delivered twice, in different files, comes out once."""
    e = V.table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("ESN"), F.col("ts").alias("reportdatetime"))
    path, _ = _arrivals(spark, e, S.TIME)
    late = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    e.where(bt(S.TIME) >= late).repartition(FILES).write.mode("append").parquet(path)
    e.where(bt(S.TIME) >= late).repartition(FILES).write.mode("append").parquet(path)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", FILES).parquet(path)
    out = scratch_dir(spark, "deduplicated")
    unique = jobs.dedup_stream(stream, ["event_id", "ESN", S.TIME], delay="14 days")
    _finish(_to_parquet(unique, out))
    return spark.read.parquet(out)


@check("stream_phase_join", f"""WITH r AS (SELECT user_id AS "ESN", {V.PHASE_SQL} AS phase, ts AS reportdatetime,
CAST(event_id % 7 AS BIGINT) AS row_sum FROM events)
SELECT d."ESN", d.reportdatetime AS reportdatetime_cruise, d.row_sum AS row_sum_cruise, {_near('takeoff', 24)}, {_near('climb', 12)}
FROM (SELECT * FROM r WHERE phase = 'cruise') d {_asof('takeoff', 'take-off', '>', 'r')} {_asof('climb', 'climb', '>', 'r')}""")
def stream_phase_join(spark, sf_dir):
    """Cruise reports with the latest take-off and climb before them, or without;
    every third lookup comes an arrival late."""
    r = V.reports(spark, sf_dir).select(
        "ESN", "phase", S.TIME, (bt("event_id") % 7).cast("long").alias("row_sum"))
    late = (bt("phase") != "cruise") & (F.minute(bt(S.TIME)) % 3 == 0)
    _, stream = _arrivals(spark, r, S.TIME, late)
    out = scratch_dir(spark, "phase-matches")
    _finish(_to_parquet(stateful.phase_matches_stream(stream, lookups=BACK, keys=["ESN"], delay="30 days"), out))
    return stateful.latest_revisions(spark.read.parquet(out), ["ESN", f"{S.TIME}_cruise", "copy"]).drop("copy")


@check("stream_engine_history", f"""WITH m AS (SELECT event_id, phase, "ESN", reportdatetime, CASE WHEN count(value) OVER w = 3
THEN {r5('avg(value) OVER w')} END AS "value_MEAN" FROM ({V.REPORTS_SQL}) r WINDOW w AS (PARTITION BY phase, "ESN"
ORDER BY reportdatetime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT event_id, "value_MEAN", {r5('"value_MEAN" - lag("value_MEAN", 2) OVER v')} AS "value_MEAN_LAG_2",
{r5('"value_MEAN" - lag("value_MEAN", 5) OVER v')} AS "value_MEAN_LAG_5" FROM m
WINDOW v AS (PARTITION BY phase, "ESN" ORDER BY reportdatetime)""")
def stream_engine_history(spark, sf_dir):
    """Means and lag deltas of arriving reports; every fifth comes an arrival late."""
    r = V.reports(spark, sf_dir).select("event_id", "phase", "ESN", S.TIME, "value")
    _, stream = _arrivals(spark, r, S.TIME, F.minute(bt(S.TIME)) % 5 == 0)
    out = scratch_dir(spark, "engine-history")
    scored = stateful.engine_history_stream(stream, ["value"], (2, 5), 3, order=[S.TIME], delay="30 days")
    _finish(_to_parquet(scored, out))
    return stateful.latest_revisions(spark.read.parquet(out), ["event_id"]).select(
        "event_id", "value_MEAN", "value_MEAN_LAG_2", "value_MEAN_LAG_5")


# -- several sources ---------------------------------------------------------

def _by_phase(spark, sf_dir):
    """A source per phase: repeats of the first days' reports come 20 days later, and
    so do reports of these days that nobody delivered before."""
    e = V.reports(spark, sf_dir).select("event_id", "ESN", "phase", S.TIME)
    early = bt(S.TIME) < F.lit(CUTS[0]).cast("timestamp_ntz")
    withheld = early & (F.minute(bt(S.TIME)) % 7 == 0)
    sources = {}
    for phase in S.PHASES:
        mine = e.where(bt("phase") == phase)
        path, sources[phase] = _arrivals(spark, mine.where(~withheld), S.TIME)
        mine.where(early).repartition(FILES).write.mode("append").parquet(path)
    query, store = once.start_once(sources, scratch_dir(spark, "once"), ["event_id", "ESN", "phase", S.TIME])
    return store, _finish(query)


@check("stream_once", V.REPORTS_SQL.replace(", value, event_type", ""))
def stream_once(spark, sf_dir):
    """Reports of three sources, each once, though repeats and first deliveries come 20 days late."""
    store, last = _by_phase(spark, sf_dir)
    return store.rows(last)


@check("stream_low_watermark", f"""SELECT min(newest) AS checkpoint FROM
(SELECT {V.PHASE_SQL} AS phase, max(ts) AS newest FROM events GROUP BY ALL)""")
def stream_low_watermark(spark, sf_dir):
    """The mark that a checkpoint may move to after the same stream."""
    store, last = _by_phase(spark, sf_dir)
    return store.low_watermark(last, S.PHASES)


SLOW_FILES = 10


@check("stream_pairs_by_source", f"""WITH {FLEET} SELECT phase, "ESN", "ACID", reportdatetime FROM f
WHERE (phase, "ACID", reportdatetime) IN (SELECT (phase, "ACID", reportdatetime) FROM f GROUP BY ALL HAVING count(DISTINCT "ESN") = 2)""")
def stream_pairs_by_source(spark, sf_dir):
    """Pairs of three sources of which climb comes a tenth at a time, the second
    halves a tenth later, when the others are weeks ahead; halves wait a week."""
    fleet = V.fleet(spark, sf_dir).select("phase", "ESN", "ACID", "ENGPOS", S.TIME)
    sources = []
    for phase in S.PHASES:
        path, mine, triggered = scratch_dir(spark, "source"), fleet.where(bt("phase") == phase), 1
        if phase == "climb":
            part = F.least(((F.dayofmonth(bt(S.TIME)) - 1) / 3).cast("int"), F.lit(SLOW_FILES - 1)) + (bt("ENGPOS") == 2).cast("int")
            for i in range(SLOW_FILES + 1):
                mine.where(part == i).coalesce(1).write.mode("append").parquet(path)
        else:
            mine.repartition(FILES).write.parquet(path)
            triggered = FILES
        sources.append(spark.readStream.schema(fleet.schema).option("maxFilesPerTrigger", triggered).parquet(path))
    out = scratch_dir(spark, "pairs")
    pairs = stateful.paired_stream(stateful.merged_sources(sources, delay="7 days"), "7 days")
    _finish(_to_parquet(pairs, out))
    return spark.read.parquet(out).drop("ENGPOS")
