"""Time expressions. All instants are UTC; ``as_of`` replaces every wall clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

MINUTE = 60
HOUR = 3600
DAY = 86400


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def instant(as_of: str | datetime | Column) -> Column:
    """A timestamp literal from a string or datetime; columns pass through."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def hour_floor(ts: str | Column) -> Column:
    return F.date_trunc("hour", col(ts))


def plus_seconds(ts: Column, seconds: Column | int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(seconds).cast("long") * 1_000_000)


def plus_hours(ts: Column, hours: Column | int) -> Column:
    return plus_seconds(ts, F.lit(hours).cast("long") * HOUR)


def seconds_floor(ts: str | Column, width: int) -> Column:
    """Number of the fixed-width time slot that holds ``ts``."""
    return F.floor(F.unix_seconds(col(ts)) / F.lit(width)).cast("long")


def ceil_minute(ts: str | Column) -> Column:
    """First whole minute at or after ``ts``, in minutes since the epoch."""
    return F.ceil(F.unix_micros(col(ts)) / F.lit(MINUTE * 1_000_000)).cast("long")


def calendar(ts: str | Column) -> dict[str, Column]:
    """Calendar fields of an hour; Sunday is day 0, weeks are ISO, names unpadded."""
    ts = col(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.dayofweek(ts) - 1,
        "weekday_name": F.date_format(ts, "EEEE"),
        "day_of_month": F.dayofmonth(ts),
        "calendar_week": F.weekofyear(ts),
        "month_number": F.month(ts),
        "month_name": F.date_format(ts, "MMMM"),
    }
