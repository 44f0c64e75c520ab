"""Calendar features from epoch milliseconds (F1-F8). All native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcraft.sources.schema import TS


MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


def utc_date(ms: Column) -> Column:
    """the UTC calendar date of epoch milliseconds, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(ms / MS_PER_DAY).cast("int"))


def utc_hour(ms: Column) -> Column:
    """the UTC hour of epoch milliseconds (0-23), whatever the session time zone."""
    return F.floor(F.pmod(ms, F.lit(MS_PER_DAY)) / MS_PER_HOUR).cast("int")


def weekday(d: Column) -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, which starts on Sunday=1)."""
    return F.weekday(d)


def day_part(hour: Column, edges: list[int] | None = None) -> Column:
    """bucket of the hour; default edges [0,6,12,18,24) -> 0..3, left-closed."""
    edges = edges or [0, 6, 12, 18, 24]
    if edges == [0, 6, 12, 18, 24]:
        return (hour / 6).cast("int")
    expr = None
    for i in range(len(edges) - 1):
        cond = (hour >= edges[i]) & (hour < edges[i + 1])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def seconds_between(later_ms: Column, earlier_ms: Column) -> Column:
    """F8: difference of two epoch-millisecond columns in seconds."""
    return (later_ms - earlier_ms) / 1000.0


def hours_between(later_ms: Column, earlier_ms: Column) -> Column:
    """F8: difference of two epoch-millisecond columns in hours."""
    return (later_ms - earlier_ms) / 3_600_000.0


def add_calendar(df: DataFrame, ts_col: str = TS, prefix: str = "") -> DataFrame:
    """Hour (F2), weekday (F3), day of month (F4), month and year (F5), day
    part (F6), weekend (F7) - in UTC, as the scripts' naive datetimes from epoch
    milliseconds are."""
    ms = F.col(ts_col)
    d = utc_date(ms)
    h = utc_hour(ms)
    wd = weekday(d)
    return df.withColumns({
        f"{prefix}hour": h,
        f"{prefix}day_of_week": wd,
        f"{prefix}day_of_month": F.dayofmonth(d),
        f"{prefix}month": F.month(d),
        f"{prefix}year": F.year(d),
        f"{prefix}time_period": day_part(h),
        f"{prefix}is_weekend": (wd >= 5).cast("int"),
    })
