"""Column naming, stage schemas and algorithm settings.

Every derived column name is generated from one parameter table, so operators
never spell names by hand and also run on other keyed time series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Parameter:
    name: str
    measured: str
    nominal: str
    signature: str | None  # column of the signature table; None = not fitted


# Measured / nominal / signature column of each monitored parameter.
PARAMETERS = (
    Parameter("PS26", "P25__PSI", "PS26S__NOM_PSI", "P26"),
    Parameter("T25", "T25__DEGC", "TS25S__NOM_K", "T26"),
    Parameter("P30", "P30__PSI", "PS30S__NOM_PSI", "P30"),
    Parameter("T30", "T30__DEGC", "TS30S__NOM_K", "T30"),
    Parameter("TGTU", "TGTU_A__DEGC", "TGTS__NOM_K", "TGT"),
    Parameter("NL", "NL__PC", "NL__NOM_PC", "NL"),
    Parameter("NI", "NI__PC", "NI__NOM_PC", "NI"),
    Parameter("NH", "NH__PC", "NH__NOM_PC", "NH"),
    Parameter("FF", "FF__LBHR", "FF__NOM_LBHR", "WFE"),
    Parameter("P160", "PS160__PSI", "P135S__NOM_PSI", None),
)

PHASES = ("cruise", "take-off", "climb")
# Report code of each flight phase.
PHASE_CODES = {"cruise": 52, "take-off": 53, "climb": 54}

# Inclusive (low, high) limits per phase.
RANGE_LIMITS = {
    "take-off": {
        "P25__PSI": (50, 200), "T25__DEGC": (200, 400), "P30__PSI": (400, 800),
        "T30__DEGC": (500, 800), "TGTU_A__DEGC": (650, 1000), "NL__PC": (60, 120),
        "NI__PC": (75, 120), "NH__PC": (75, 120), "FF__LBHR": (10000, 25000),
        "ALT__FT": (-1000, 9000), "MN1": (0.175, 0.320),
    },
    "climb": {
        "P25__PSI": (50, 100), "T25__DEGC": (200, 350), "P30__PSI": (250, 500),
        "T30__DEGC": (450, 700), "TGTU_A__DEGC": (650, 900), "NL__PC": (60, 120),
        "NI__PC": (75, 120), "NH__PC": (75, 120), "FF__LBHR": (8000, 16000),
        "ALT__FT": (15000, 25000), "MN1": (0.500, 0.770),
    },
    "cruise": {
        "P25__PSI": (25, 60), "T25__DEGC": (170, 280), "P30__PSI": (130, 270),
        "T30__DEGC": (330, 590), "TGTU_A__DEGC": (380, 900), "NL__PC": (60, 120),
        "NI__PC": (75, 120), "NH__PC": (75, 120), "FF__LBHR": (3000, 8500),
        "ALT__FT": (25000, 43000), "MN1": (0.700, 0.880),
    },
}

SENTINEL = -5555.0
KELVIN_OFFSET = 273.15
KELVIN_COLUMNS = ("TS25S__NOM_K", "TS30S__NOM_K", "TGTS__NOM_K")

INT_COLUMNS = ("ESN", "equipmentid", "ENGPOS", "DSCID")
TIME_COLUMNS = ("reportdatetime", "datestored")
STRING_COLUMNS = ("operator", "ACID")
NULLABLE_INT_COLUMNS = ("SISTER_ESN", "FlagSV", "FlagSisChg", "row_sum")
MEASURED = tuple(p.measured for p in PARAMETERS)
NOMINAL = tuple(p.nominal for p in PARAMETERS)
AMBIENT = ("ALT__FT", "MN1", "P20__PSI", "T20__DEGC")
IDENTITY = ("ESN", "reportdatetime", "datestored", "operator", "equipmentid", "ACID", "ENGPOS", "DSCID")
REPORT_COLUMNS = IDENTITY + MEASURED + NOMINAL + AMBIENT
# Columns that must hold a value for a report to be usable (sentinel filter).
REQUIRED_READINGS = tuple(c for c in MEASURED if c != "PS160__PSI") + ("ALT__FT", "MN1") + NOMINAL

PHASE = "phase"
NEW_FLAG = "NEW_FLAG"
TIME = "reportdatetime"
INSTALLATION = ("ESN", "operator", "ACID", "ENGPOS")
ENGINE = (PHASE, "ESN")
ENGINE_ORDER = (TIME, "DSCID", "ACID", "ENGPOS")
PAIR = (PHASE, "ACID", TIME)
REPORT_KEY = (PHASE, "ESN", "operator", "ACID", "ENGPOS", "DSCID", TIME)

DELTA = tuple(f"{p.name}__DEL_PC" for p in PARAMETERS)
E2E = tuple(f"{c}_E2E" for c in DELTA)
MEAN = tuple(f"{c}_MAV_NO_STEPS" for c in E2E)
FITTED_MEAN = tuple(f"{p.name}__DEL_PC_E2E_MAV_NO_STEPS" for p in PARAMETERS if p.signature)
SIGNATURE_COLUMNS = tuple(p.signature for p in PARAMETERS if p.signature)
COMPONENTS = ("IPC", "HPC")


def lag_column(mean_column: str, lag: int) -> str:
    return f"{mean_column}_LAG_{lag}"


def lag_columns(lags) -> list[str]:
    return [lag_column(c, n) for n in lags for c in MEAN]


def fit_columns(lag: int) -> list[str]:
    cols = []
    for i in (1, 2, 3):
        cols += [f"VAR{i}_SHIFT{lag}", f"VAR{i}_MAGNITUDE{lag}", f"VAR{i}_IDENTIFIER{lag}"]
    return cols + [f"ERROR_REL{lag}", f"ERROR_MAGNITUDE{lag}", f"OBS_MAGNITUDE{lag}"]


def damage_column(component: str, lag: int) -> str:
    return f"{component}_DAMAGE_SHIFT{lag}"


def fraction_column(component: str, threshold: float, lag: int) -> str:
    return f"{component}_FRACTION_GT_{threshold}_{lag}"


def stats_columns(component: str, lag: int, thresholds) -> list[str]:
    return [f"{component}_MAX{lag}", f"{component}_MEAN{lag}"] + [
        fraction_column(component, t, lag) for t in thresholds
    ]


@dataclass(frozen=True)
class Settings:
    """Algorithm parameters; the defaults are those of the live configuration."""

    lags: tuple[int, ...] = (50, 100, 200, 400)
    window_semi_width: int = 10
    min_sv_dur: float = 40.0
    rel_err_limit: float = 0.3
    magnitude_factor: float = 5.0
    max_signatures: int = 3
    thresholds: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8, 1.0)
    fraction_limit: float = 0.07
    min_exceedances: int = 3
    n_points: int = 650
    takeoff_minutes: float = 55.0
    climb_minutes: float = 30.0
    # "batch": gaps, flags and fits see the new rows only (re-run batch behaviour).
    # "history": they continue from the stored rows, so results do not depend
    # on how the input was cut into increments.
    context: str = "batch"

    def __post_init__(self):
        if self.context not in ("batch", "history"):
            raise ValueError(f"context must be 'batch' or 'history', not {self.context!r}")

    @property
    def window(self) -> int:
        return 2 * self.window_semi_width + 1


def column_type(name: str) -> T.DataType:
    """Type of a fleet column by its name; anything unlisted is a reading."""
    if name in INT_COLUMNS or name in NULLABLE_INT_COLUMNS or name == NEW_FLAG:
        return T.LongType()
    if name in TIME_COLUMNS:
        return T.TimestampNTZType()
    if name in STRING_COLUMNS or name == PHASE or "IDENTIFIER" in name:
        return T.StringType()
    return T.DoubleType()


def struct_of(names) -> T.StructType:
    return T.StructType([T.StructField(n, column_type(n), True) for n in names])


def report_schema() -> T.StructType:
    return struct_of((PHASE,) + REPORT_COLUMNS)


def stage_columns(settings: Settings) -> list[str]:
    """Fixed column list of the fully widened stage table."""
    cols = [PHASE, *REPORT_COLUMNS, NEW_FLAG, "days_since_prev", *DELTA, "SISTER_ESN", *E2E,
            "FlagSV", "FlagSisChg", *MEAN, *lag_columns(settings.lags)]
    for lag in settings.lags:
        cols += fit_columns(lag)
    return cols + score_columns(settings)


def score_columns(settings: Settings) -> list[str]:
    """What follows the fits: damage shifts, their statistics and the count."""
    cols = [damage_column(c, n) for n in settings.lags for c in COMPONENTS]
    for lag in settings.lags:
        for comp in COMPONENTS:
            cols += stats_columns(comp, lag, settings.thresholds)
    return cols + ["row_sum"]


def trend_columns(settings: Settings) -> list[str]:
    """Stage columns that depend on other reports of the engine."""
    columns = stage_columns(settings)
    return ["days_since_prev", *columns[columns.index("FlagSV"):]]


def stage_schema(settings: Settings) -> T.StructType:
    return struct_of(stage_columns(settings))
