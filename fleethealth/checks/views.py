"""Views of the given tables in the shape of the fleet's data.

Each view is a list of SQL expressions that Spark and the checking engine both
evaluate, so query and check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleethealth import schema as S
from fleethealth.session import scratch_dir

# Which event stands for which flight phase; every event is used.
PHASE_SQL = ("CASE event_type WHEN 'view' THEN 'take-off' WHEN 'signup' THEN 'take-off'"
             " WHEN 'click' THEN 'climb' ELSE 'cruise' END")


def _ladder(cruise: int, takeoff: int, climb: int) -> str:
    return (f"CAST(CASE phase WHEN 'cruise' THEN {cruise} WHEN 'take-off' THEN {takeoff}"
            f" ELSE {climb} END AS DOUBLE)")


# Middle of the allowed range per parameter: cruise, take-off, climb.
_LEVELS = {
    "PS26": (40, 120, 75), "T25": (225, 300, 275), "P30": (200, 600, 375), "T30": (460, 650, 575),
    "TGTU": (640, 825, 775), "NL": (90, 90, 90), "NI": (97, 97, 97), "NH": (97, 97, 97),
    "FF": (5700, 17000, 12000), "P160": (30, 60, 45),
}


def _base(k: int, p: S.Parameter) -> str:
    return f"({_ladder(*_LEVELS[p.name])} + CAST((event_id * {7 + k}) % 30 AS DOUBLE) / 10)"


def _nominal(k: int, p: S.Parameter) -> str:
    base = _base(k, p)
    return f"{base} + CAST(27315 AS DOUBLE) / 100" if p.nominal in S.KELVIN_COLUMNS else base


def _measured(k: int, p: S.Parameter) -> str:
    base = _base(k, p)
    drift = f"CAST((event_id * {3 + 2 * k} + user_id * {5 + k} + pos * {11 + k}) % 41 - 20 AS DOUBLE) / 2000"
    value = f"{base} + {base} * ({drift})"
    if p.name == "NL":  # some readings out of range
        return f"CASE WHEN (event_id * 5 + pos) % 29 = 0 THEN CAST(150 AS DOUBLE) ELSE {value} END"
    if p.name == "FF":  # and some missing
        return f"CASE WHEN (event_id + pos) % 37 = 0 THEN NULL ELSE {value} END"
    return value


# The second position's engine is exchanged on day 20.
_ESN = "CASE WHEN pos = 2 AND day(ts) >= 20 THEN user_id * 2 + 1000001 ELSE user_id * 2 + pos END"

FLEET: dict[str, str] = {
    "phase": "phase",
    "ESN": f"CAST({_ESN} AS BIGINT)",
    "reportdatetime": "ts",
    "datestored": "ts",
    "operator": "'OP' || CAST(user_id % 5 AS VARCHAR(20))",
    "equipmentid": f"CAST({_ESN} + 500 AS BIGINT)",
    "ACID": "'AC' || CAST(user_id AS VARCHAR(20))",
    "ENGPOS": "CAST(pos AS BIGINT)",
    "DSCID": "CAST(CASE phase WHEN 'cruise' THEN 52 WHEN 'take-off' THEN 53 ELSE 54 END AS BIGINT)",
    **{p.measured: _measured(k, p) for k, p in enumerate(S.PARAMETERS)},
    **{p.nominal: _nominal(k, p) for k, p in enumerate(S.PARAMETERS)},
    "ALT__FT": _ladder(35000, 2000, 20000),
    "MN1": "CAST(CASE phase WHEN 'cruise' THEN 80 WHEN 'take-off' THEN 25 ELSE 60 END AS DOUBLE) / 100",
    "P20__PSI": "CAST(event_id % 17 AS DOUBLE)",
    "T20__DEGC": "CAST(event_id % 23 AS DOUBLE)",
}

FLEET_SQL = (
    "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in FLEET.items())
    + f" FROM (SELECT event_id, ts, user_id, {PHASE_SQL} AS phase, pos"
    " FROM events CROSS JOIN (VALUES (1), (2)) v(pos)) b"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fleet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two engine reports per event, 32 report columns."""
    positions = F.explode(F.array(F.lit(1), F.lit(2))).alias("pos")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.expr(PHASE_SQL).alias("phase"))
    # A few narrow files become reports of all tasks: the expressions, and the scans behind, use every core.
    phased = events.repartition(spark.sparkContext.defaultParallelism).select("*", positions)
    return phased.select(*[F.expr(e).alias(n) for n, e in FLEET.items()])


# Signatures: the vectors at the first 32 positions; labels repeat so that the
# two components of interest are found often enough to be checked.
SIGNATURE_COUNT = 32
SIG_ID_SQL = ("CASE WHEN vec_id % 4 = 0 THEN 'IPC ETA' WHEN vec_id % 4 = 1 THEN 'HPC ETA'"
              " ELSE 'SIG ' || CAST(vec_id AS VARCHAR(20)) END")


# A vector of 64 components is folded into 9 parameters: sums of every 9th, with
# all 64 read. Sums of eight or seven doubles in a fixed order are equal in both engines.
FOLDED = [" + ".join(f"CAST(embedding[{{{j}}}] AS DOUBLE)" for j in range(i, 64, 9)) for i in range(9)]
FOLD_SPARK = [e.format(*range(64)) for e in FOLDED]
FOLD_SQL = [e.format(*range(1, 65)) for e in FOLDED]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observation vectors: the embedding folded to 9, all rows; the label tells the phase."""
    phases = F.array(*[F.lit(p) for p in S.PHASES])
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.element_at(phases, F.col("label") % len(S.PHASES) + 1).alias("phase"),
        F.array(*[F.expr(e) for e in FOLD_SPARK]).alias("obs"))


def signatures(spark: SparkSession, sf_dir: str, phases=("cruise",), count: int = SIGNATURE_COUNT) -> DataFrame:
    from fleethealth.sources.signatures import load_signatures

    wide = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sig_pos"), F.expr(SIG_ID_SQL).alias("sig_id"),
        *[F.expr(e).alias(c) for e, c in zip(FOLD_SPARK, S.SIGNATURE_COLUMNS)],
        F.explode(F.array(*[F.lit(p) for p in phases])).alias("phase"))
    return load_signatures(wide, range(count), drop_first=0, scale=1.0)


def signatures_sql(count: int = SIGNATURE_COUNT) -> str:
    columns = ", ".join(f"{e} AS v{i}" for i, e in enumerate(FOLD_SQL, 1))
    return f"SELECT vec_id AS sig_pos, {SIG_ID_SQL} AS sig_id, {columns} FROM embeddings WHERE vec_id < {count}"


# Long series: line items of one supplier in ship order.
SERIES_KEYS = ["l_suppkey"]
SERIES_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
                "l_discount", "l_tax"]
SERIES_ORDER_SQL = ", ".join(SERIES_ORDER)
SV_SQL = "CASE WHEN CAST(l_discount * 100 AS INT) = 10 AND CAST(l_tax * 100 AS INT) = 8 THEN 1 ELSE 0 END"
SIS_SQL = "CASE WHEN CAST(l_discount * 100 AS INT) = 0 AND CAST(l_tax * 100 AS INT) = 0 THEN 1 ELSE 0 END"


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", *SERIES_ORDER, F.expr(SV_SQL).cast("long").alias("FlagSV"),
        F.expr(SIS_SQL).cast("long").alias("FlagSisChg"))


SERIES_SQL = (f"SELECT l_suppkey, {SERIES_ORDER_SQL}, CAST({SV_SQL} AS BIGINT) AS \"FlagSV\","
              f" CAST({SIS_SQL} AS BIGINT) AS \"FlagSisChg\" FROM lineitem")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reports of one engine per user."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("ESN"), F.expr(PHASE_SQL).alias("phase"),
        F.col("ts").alias("reportdatetime"), "value", "event_type")


REPORTS_SQL = (f'SELECT event_id, user_id AS "ESN", {PHASE_SQL} AS phase, ts AS reportdatetime, value, event_type'
               " FROM events")


_WRITTEN: dict[tuple[str, str], str] = {}


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet's report table, derived from the events once per application and
    written to the shared folder: queries then read plain columns, as they would
    from a real report table, and filters do not repeat the long expressions."""
    rows = fleet_rows(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = scratch_dir(spark, "fleet")
        rows.write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.schema(rows.schema).parquet(_WRITTEN[key])
