"""Gaps, flags, rolling means, lags and statistics over ordered series."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethealth import schema as S
from fleethealth.checks import views as V
from fleethealth.checks.registry import check, r5
from fleethealth.checks.row_queries import FLAGGED, MARK, damage_rows, damage_sql, shift_sql
from fleethealth.functions import bt, rounded
from fleethealth.operators import clean, deltas, flags, stats, trend

ITEM = ["l_suppkey", *V.SERIES_ORDER]
ITEM_SQL = ", ".join(ITEM)
VALUES = ["l_extendedprice", "l_quantity"]
OVER = f"PARTITION BY l_suppkey ORDER BY {V.SERIES_ORDER_SQL}"
SERIES = f"s AS ({V.SERIES_SQL})"
KW = {"keys": V.SERIES_KEYS, "order": V.SERIES_ORDER}


def _flagged(spark, sf_dir):
    r = V.reports(spark, sf_dir).select("event_id", "ESN", "phase", "reportdatetime")
    return clean.new_flag(r, MARK)


_R = f"r AS ({FLAGGED} FROM ({V.REPORTS_SQL}) e)"
_US = "epoch_us(reportdatetime)"
_GAP = """CASE WHEN "NEW_FLAG" = 1 THEN coalesce(round_even((epoch_us(reportdatetime) - lag(epoch_us(reportdatetime))
OVER (PARTITION BY phase, "ESN"{split} ORDER BY reportdatetime)) / 86400000000.0::DOUBLE, 1), 0) END AS days_since_prev"""


@check("days_since_prev", f"""WITH {_R} SELECT event_id, {_GAP.format(split=', "NEW_FLAG"')} FROM r""")
def days_since_prev(spark, sf_dir):
    d = flags.days_since_prev(_flagged(spark, sf_dir), S.ENGINE, ["reportdatetime"])
    return d.select("event_id", "days_since_prev")


@check("days_since_prev_history", f"""WITH {_R} SELECT event_id, {_GAP.format(split='')} FROM r""")
def days_since_prev_history(spark, sf_dir):
    d = flags.days_since_prev(_flagged(spark, sf_dir), S.ENGINE, ["reportdatetime"], context="history")
    return d.select("event_id", "days_since_prev")


def _engine_flags(spark, sf_dir):
    """Gaps above 4 days count as a shop visit; the sister is derived from the event."""
    d = flags.days_since_prev(_flagged(spark, sf_dir), S.ENGINE, ["reportdatetime"])
    sister = F.when(bt("event_id") % 17 != 0, F.floor(bt("event_id") / 2000)).cast("long")
    return flags.engine_flags(d.withColumn("SISTER_ESN", sister), 4.0, S.ENGINE, ["reportdatetime"])


_FLAGS = f"""WITH {_R}, g AS (SELECT *, {_GAP.format(split=', "NEW_FLAG"')},
CASE WHEN event_id % 17 <> 0 THEN CAST(floor(event_id / 2000) AS BIGINT) END AS sister FROM r),
h AS (SELECT *, row_number() OVER w AS rn, lag(sister) OVER w AS before FROM g
WINDOW w AS (PARTITION BY phase, "ESN", "NEW_FLAG" ORDER BY reportdatetime))"""


@check("shop_visit_flag", f"""{_FLAGS} SELECT event_id, CASE WHEN "NEW_FLAG" = 1 THEN
CAST(CASE WHEN rn = 1 OR days_since_prev > 4 THEN 1 ELSE 0 END AS BIGINT) END AS "FlagSV" FROM h""")
def shop_visit_flag(spark, sf_dir):
    return _engine_flags(spark, sf_dir).select("event_id", "FlagSV")


@check("sister_change_flag", f"""{_FLAGS} SELECT event_id, CASE WHEN "NEW_FLAG" = 1 THEN
CAST(CASE WHEN rn = 1 OR before = sister THEN 0 ELSE 1 END AS BIGINT) END AS "FlagSisChg" FROM h""")
def sister_change_flag(spark, sf_dir):
    return _engine_flags(spark, sf_dir).select("event_id", "FlagSisChg")


def _mean_sql(c: str) -> str:
    return (f"CASE WHEN count(m_{c}) OVER w = 21 THEN {r5(f'avg(m_{c}) OVER w')} END AS {c}_MEAN")


@check("masked_rolling_mean", f"""WITH {SERIES}, m AS (SELECT *,
{", ".join(f'CASE WHEN "FlagSV" = 0 AND "FlagSisChg" = 0 THEN {c} END AS m_{c}' for c in VALUES)} FROM s)
SELECT {ITEM_SQL}, {", ".join(map(_mean_sql, VALUES))} FROM m WINDOW w AS ({OVER} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)""")
def masked_rolling_mean(spark, sf_dir):
    d = trend.masked_rolling_mean(V.series(spark, sf_dir), VALUES, suffix="_MEAN", **KW)
    return d.drop("FlagSV", "FlagSisChg")


LAGS = (50, 100, 200, 400)


@check("lag_delta", f"""SELECT {ITEM_SQL}, {", ".join(
    f'{r5(f"{c} - lag({c}, {n}) OVER w")} AS "{c}_LAG_{n}"' for n in LAGS for c in VALUES)}
FROM lineitem WINDOW w AS ({OVER})""")
def lag_delta(spark, sf_dir):
    d = V.table(spark, sf_dir, "lineitem").select(*ITEM)
    return trend.lag_delta(d, VALUES, LAGS, **KW)


# All ten columns of the operator: two readings and their multiples.
_TEN = {f"v{i}": f"{c} * {k}.0" for i, (c, k) in enumerate([(c, k) for k in (1, 2, 3, 5, 7) for c in VALUES])}
_LAGS = S.Settings().lags


@check("observed_magnitude", f"""SELECT {ITEM_SQL}, {", ".join(
    f"round_even(sqrt({' + '.join(f'{c}_{n} * {c}_{n}' for c in _TEN)}), 8) AS {chr(34)}OBSERVED_MAGNITUDE{n}{chr(34)}" for n in _LAGS)}
FROM (SELECT *, {", ".join(r5(f"{c} - lag({c}, {n}) OVER w") + f" AS {c}_{n}" for n in _LAGS for c in _TEN)}
FROM (SELECT {ITEM_SQL}, {", ".join(f"{e}::DOUBLE AS {c}" for c, e in _TEN.items())} FROM lineitem) y WINDOW w AS ({OVER})) x""")
def observed_magnitude(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem").select(*ITEM, *[F.expr(e).cast("double").alias(c) for c, e in _TEN.items()])
    d = trend.lag_delta(rows, list(_TEN), _LAGS, **KW)
    return deltas.observed_magnitude(d, _LAGS, list(_TEN)).select(*ITEM, *[f"OBSERVED_MAGNITUDE{n}" for n in _LAGS])


_BROKEN = 'CASE WHEN "FlagSV" = 1 OR "FlagSisChg" = 1 THEN 1 ELSE 0 END'
_SEG = f"""g AS (SELECT *, sum({_BROKEN}) OVER ({OVER} ROWS UNBOUNDED PRECEDING) AS seg FROM s)"""
_SEGMEAN = ("CASE WHEN count({c}) OVER w = 21 THEN round_even(avg({c}) OVER w, 5) END AS {c}{suffix}")
_SEGWIN = f"WINDOW w AS (PARTITION BY l_suppkey, seg ORDER BY {V.SERIES_ORDER_SQL} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)"


def _segment_sql(suffix: str) -> str:
    means = ", ".join(_SEGMEAN.format(c=c, suffix=suffix) for c in VALUES)
    return f"WITH {SERIES}, {_SEG} SELECT {ITEM_SQL}, {means} FROM g {_SEGWIN}"


@check("segmented_rolling_mean", _segment_sql("_SEG"))
def segmented_rolling_mean(spark, sf_dir):
    d = trend.segmented_rolling_mean(V.series(spark, sf_dir), VALUES, suffix="_SEG", **KW)
    return d.drop("FlagSV", "FlagSisChg")


@check("since_break_mean", _segment_sql("_E2E"))
def since_break_mean(spark, sf_dir):
    return trend.since_break_mean(V.series(spark, sf_dir), VALUES, **KW).drop("FlagSV", "FlagSisChg")


@check("stepfree_cumulative", f"""WITH z AS ({_segment_sql('_M')}), c AS (SELECT *,
{", ".join(f'CASE WHEN l_extendedprice_M IS NOT NULL AND l_quantity_M IS NOT NULL AND lag(l_extendedprice_M) OVER w IS NOT NULL AND lag(l_quantity_M) OVER w IS NOT NULL THEN {v}_M - lag({v}_M) OVER w ELSE 0 END AS d_{v}' for v in VALUES)}
FROM z WINDOW w AS ({OVER}))
SELECT {ITEM_SQL}, {", ".join(f'{r5(f"sum(d_{v}) OVER w")} AS {v}_CUM' for v in VALUES)} FROM c
WINDOW w AS ({OVER} ROWS UNBOUNDED PRECEDING)""")
def stepfree_cumulative(spark, sf_dir):
    d = trend.since_break_mean(V.series(spark, sf_dir), VALUES, suffix="_M", **KW)
    done = trend.stepfree_cumulative(d, [f"{v}_M" for v in VALUES], suffix="_CUM", **KW)
    return done.select(*ITEM, *[bt(f"{v}_M_CUM").alias(f"{v}_CUM") for v in VALUES])


_WIN = f"WINDOW w AS ({OVER} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)"


def _robust_sql(c: str) -> str:
    """CTEs from the frame of a column to its location: sorted and centred on its
    least value, a subset is a run of h places whose sums two frames give."""
    return f"""{c}_0 AS (SELECT rid, len({c}_frame) AS n, greatest(CAST(floor(len({c}_frame) * 0.75::DOUBLE) AS BIGINT), 1) AS h,
list_min({c}_frame) AS least, unnest(list_sort({c}_frame)) AS v, unnest(range(1, len({c}_frame) + 1)) AS k FROM f WHERE bad = 0),
{c}_1 AS (SELECT *, sum(v - least) OVER p AS x, sum((v - least) * (v - least)) OVER p AS q, sum(v - least) OVER a AS xs,
sum((v - least) * (v - least)) OVER a AS qs FROM {c}_0 WINDOW a AS (PARTITION BY rid),
p AS (PARTITION BY rid ORDER BY k ROWS BETWEEN CURRENT ROW AND h - 1 FOLLOWING)),
{c}_2 AS (SELECT rid, k, least + x / h AS mu, round_even((q - x * x / h)
* CASE WHEN qs - xs * xs / n > 0 THEN 1e9::DOUBLE / (qs - xs * xs / n) ELSE 0 END, 0) AS spread FROM {c}_1 WHERE k <= n - h + 1),
{c}_5 AS (SELECT rid, arg_min(mu, spread * 1000 + k) AS mu FROM {c}_2 GROUP BY rid)"""


_ROBUST = f"""{SERIES}, n AS (SELECT *, row_number() OVER () AS rid FROM s),
f AS (SELECT *, max({_BROKEN}) OVER w AS bad, {", ".join(f"list({c}) OVER w AS {c}_frame" for c in VALUES)} FROM n {_WIN}),
{", ".join(map(_robust_sql, VALUES))},
located AS (SELECT {ITEM_SQL}, {", ".join(f'{r5(f"{c}_5.mu")} AS "{c}_ROBUST"' for c in VALUES)}
FROM f {" ".join(f"LEFT JOIN {c}_5 ON {c}_5.rid = f.rid" for c in VALUES)})"""


@check("robust_rolling_location", f"WITH {_ROBUST} SELECT * FROM located")
def robust_rolling_location(spark, sf_dir):
    d = trend.robust_rolling_location(V.series(spark, sf_dir), VALUES, **KW)
    return d.drop("FlagSV", "FlagSisChg")


_CHANGES = ", ".join(f"""CASE WHEN {" AND ".join(f'"{c}_ROBUST" IS NOT NULL AND lag("{c}_ROBUST") OVER o IS NOT NULL' for c in VALUES)}
THEN "{v}_ROBUST" - lag("{v}_ROBUST") OVER o ELSE 0 END AS {v}_change""" for v in VALUES)


@check("robust_cumulative", f"""WITH {_ROBUST}, changes AS (SELECT *, {_CHANGES} FROM located WINDOW o AS ({OVER}))
SELECT {ITEM_SQL}, {", ".join(f'"{c}_ROBUST", {r5(f"sum({c}_change) OVER (o ROWS UNBOUNDED PRECEDING)")} + 0.0::DOUBLE AS "{c}_ROBUST_CUMULATIVE"' for c in VALUES)}
FROM changes WINDOW o AS ({OVER})""")
def robust_cumulative(spark, sf_dir):
    d = trend.robust_cumulative(V.series(spark, sf_dir), VALUES, **KW).drop("FlagSV", "FlagSisChg")
    # The two engines add in another order: a sum of about 0 may be -0.0 in one of them.
    return d.withColumns({f"{c}_ROBUST_CUMULATIVE": bt(f"{c}_ROBUST_CUMULATIVE") + F.lit(0.0) for c in VALUES})


# -- rolling statistics ------------------------------------------------------

THRESHOLDS = (0.2, 0.4, 0.6, 0.8, 1.0)
STATS = S.Settings(thresholds=THRESHOLDS)


def _stats(spark, sf_dir, matched, settings=STATS):
    d = stats.damage_shift(damage_rows(spark, sf_dir, settings.lags), settings.lags)
    return stats.summary_stats(d, settings, matched=matched, **KW)


def _match_sql(comp, n):
    return "(" + " OR ".join(f"coalesce(\"VAR{i}_IDENTIFIER{n}\" = '{comp} ETA', false)" for i in (1, 2, 3)) + ")"


def _stats_sql(fields, matched=True, settings=STATS) -> str:
    cols, windows, tags = [], [], []
    for n in settings.lags:
        for comp in S.COMPONENTS:
            w, x, m = f"w{comp}{n}", f'"{comp}_DAMAGE_SHIFT{n}"', f"m_{comp}{n}"
            known = f"count({x}) OVER {w} > 0" + (f" AND {m}" if matched else "")
            exprs = {"MAX": (f"max({x}) OVER {w}", f"{comp}_MAX{n}"), "MEAN": (f"avg({x}) OVER {w}", f"{comp}_MEAN{n}")}
            for t in settings.thresholds:
                exprs[f"FRACTION{t}"] = (
                    f"avg(CASE WHEN {x} > {t} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER {w}",
                    S.fraction_column(comp, t, n))
            # Nine places: short decimals averaged over up to 400 rows have no half-way case there.
            cols += [f'CASE WHEN {known} THEN round_even({e}, 9) END AS "{name}"'
                     for kind, (e, name) in exprs.items() if any(kind.startswith(f) for f in fields)]
            part = f"l_suppkey, {m}" if matched else "l_suppkey"
            windows.append(f"{w} AS (PARTITION BY {part} ORDER BY {V.SERIES_ORDER_SQL}"
                           f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
            tags += [f"{shift_sql(comp, n)} AS {x}", f"{_match_sql(comp, n)} AS {m}"]
    return (f"WITH d AS (SELECT *, {', '.join(tags)} FROM ({damage_sql(settings.lags)}) v)"
            f" SELECT {ITEM_SQL}, {', '.join(cols)} FROM d WINDOW {', '.join(windows)}")


def _pick(df, kinds, settings=STATS):
    names = [c for n in settings.lags for comp in S.COMPONENTS for c in S.stats_columns(comp, n, settings.thresholds)
             if any(k in c for k in kinds)]
    return df.select(*ITEM, *[rounded(bt(c), 9).alias(c) for c in names])


@check("rolling_max_matched", _stats_sql(["MAX"]))
def rolling_max_matched(spark, sf_dir):
    return _pick(_stats(spark, sf_dir, True), ["MAX"])


@check("rolling_mean_matched", _stats_sql(["MEAN"]))
def rolling_mean_matched(spark, sf_dir):
    return _pick(_stats(spark, sf_dir, True), ["MEAN"])


@check("rolling_exceedance", _stats_sql(["FRACTION"]))
def rolling_exceedance(spark, sf_dir):
    return _pick(_stats(spark, sf_dir, True), ["FRACTION"])


ALL_ROWS = S.Settings(thresholds=(0, *THRESHOLDS))


@check("rolling_max_all", _stats_sql(["MAX", "MEAN", "FRACTION"], False, ALL_ROWS))
def rolling_max_all(spark, sf_dir):
    return _pick(_stats(spark, sf_dir, False, ALL_ROWS), ["MAX", "MEAN", "FRACTION"], ALL_ROWS)
