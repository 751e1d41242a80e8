"""Column expressions shared by the operators (all JVM side)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleethealth.schema import NEW_FLAG


STORED = "__stored"  # derived columns of stored rows that no operator has taken up yet
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


def bt(name: str) -> Column:
    """Column by exact name; names such as IPC_FRACTION_GT_0.2_50 hold dots."""
    return F.col(f"`{name}`")


def rounded(c: Column, digits: int) -> Column:
    """Half-even rounding on the binary value (rint), as numpy rounds."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def r5(c: Column) -> Column:
    return rounded(c, 5)


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def micros(ts: str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column's wall clock.

    In a UTC session that is a plain cast; in any other one the value is built
    from the clock fields, so that daylight saving leaves no gap.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return F.unix_micros(bt(ts).cast("timestamp"))
    return F.expr(
        f"unix_date(cast(`{ts}` as date)) * 86400000000L + hour(`{ts}`) * 3600000000L"
        f" + minute(`{ts}`) * 60000000L + cast(extract(second from `{ts}`) * 1000000 as bigint)"
    )


def slice_of(us: Column, width: int) -> Column:
    """Number of the time slice of ``width`` microseconds (exact, also before 1970)."""
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vector_norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def norm(cols, ord: float = 2) -> Column:
    """Row-wise L1 / L2 / max norm of several columns; null if any is null."""
    cs = [bt(c) if isinstance(c, str) else c for c in cols]
    if ord == 2:
        return F.sqrt(sum((c * c for c in cs[1:]), cs[0] * cs[0]))
    if ord == 1:
        return sum((F.abs(c) for c in cs[1:]), F.abs(cs[0]))
    if ord == float("inf"):
        known = cs[0].isNotNull()
        for c in cs[1:]:
            known = known & c.isNotNull()
        biggest = F.greatest(*[F.abs(c) for c in cs]) if len(cs) > 1 else F.abs(cs[0])
        return F.when(known, biggest)
    raise ValueError(f"unsupported norm order: {ord}")


def packed(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
    """``columns`` as one struct: windows, sorts and shuffles then copy it as one block."""
    inside = [c for c in columns if c in df.columns]
    kept = [c for c in df.columns if c not in set(inside)]
    return df.select(*map(bt, kept), F.struct(*map(bt, inside)).alias(name))


def unpacked(df: DataFrame, columns: Sequence[str], structs: Sequence[str]) -> DataFrame:
    """``columns``, wherever they are: in ``df`` or in one of its ``structs``."""
    own = {c: bt(c) for c in df.columns}
    inside = {c: bt(s).getField(c) for s in structs if s in own for c in df.schema[s].dataType.names}
    return df.select(*[(inside | own)[c].alias(c) for c in columns])


def stored_value(df: DataFrame) -> Callable[[str], Column | None]:
    """stored(name): what a column holds so far, in its place or among the packed
    columns of stored rows (null on others); None if there is no such column."""
    present = set(df.columns)
    inside = set(df.schema[STORED].dataType.names) if STORED in present else set()

    def stored(name: str) -> Column | None:
        return bt(name) if name in present else bt(STORED).getField(name) if name in inside else None

    return stored


def new_rows_only(df: DataFrame) -> Callable[[str, Column], Column]:
    """fresh(name, value): ``value`` on new rows, the stored value (or null) on
    history rows. A frame without NEW_FLAG counts as all new."""
    if NEW_FLAG not in df.columns:
        return lambda name, value: value
    stored = stored_value(df)

    def fresh(name: str, value: Column) -> Column:
        before = stored(name)
        return F.when(bt(NEW_FLAG) == 1, value).otherwise(F.lit(None) if before is None else before)

    return fresh


def total_order(cols, descending: bool = False) -> list[Column]:
    return [bt(c).desc() if descending else bt(c).asc() for c in cols]
