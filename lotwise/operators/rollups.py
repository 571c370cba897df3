"""Minute rows to hours, the hourly calendar and the readiness of a run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.clock import HOUR, calendar, hour_floor, instant, plus_hours, seconds_floor
from lotwise.functions.values import mean_of_integers
from lotwise.operators.frames import spread_out
from lotwise.schemas import LOT

AsOf = str | datetime | Column


def _by_hour(minute: DataFrame):
    return minute.groupBy(LOT, hour_floor("minute_timestamp").alias("hour_timestamp"))


def hourly_rollup(minute: DataFrame) -> DataFrame:
    """Mean (two decimals), smallest, largest and range of the free spaces per lot and hour."""
    hours = _by_hour(minute).agg(
        F.sum("free_spaces").alias("_sum"), F.count("free_spaces").alias("_n"),
        F.min("free_spaces").alias("min_free_spaces"), F.max("free_spaces").alias("max_free_spaces"))
    return hours.select(
        LOT, "hour_timestamp",
        F.when(F.col("_n") > 0, mean_of_integers(F.col("_sum"), F.col("_n"))).alias("avg_free_spaces"),
        "min_free_spaces", "max_free_spaces",
        (F.col("max_free_spaces") - F.col("min_free_spaces")).alias("free_spaces_range"))


def calendar_fields(df: DataFrame, ts: str = "hour_timestamp") -> DataFrame:
    return df.withColumns(calendar(ts))


def hourly_rollup_window(minute: DataFrame, start: AsOf, end: AsOf) -> DataFrame:
    """The rollup of ``[start, end)`` over known free spaces, mean not rounded."""
    ts = F.col("minute_timestamp")
    known = minute.where((ts >= instant(start)) & (ts < instant(end)) & F.col("free_spaces").isNotNull())
    hours = _by_hour(known).agg(
        (F.sum("free_spaces") / F.count("free_spaces")).alias("avg_free_spaces"),
        F.min("free_spaces").alias("min_free_spaces"), F.max("free_spaces").alias("max_free_spaces"),
        (F.max("free_spaces") - F.min("free_spaces")).alias("free_spaces_range"))
    fields = calendar("hour_timestamp")
    return hours.withColumns({c: fields[c] for c in (
        "hour_of_day", "day_of_week", "day_of_month", "calendar_week", "month_number")})


def last_hour(as_of: AsOf) -> tuple[Column, Column]:
    """Bounds of the last hour that is complete at ``as_of``."""
    end = F.date_trunc("hour", instant(as_of))
    return plus_hours(end, -1), end


def last_complete_hour(df: DataFrame, as_of: AsOf, ts: str = "hour_timestamp") -> DataFrame:
    start, end = last_hour(as_of)
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def readiness_counts(minute: DataFrame, hourly: DataFrame, weather: DataFrame, as_of: AsOf) -> DataFrame:
    """Rows per input for the last complete hour; a step runs only if its inputs are there."""
    sources = [("minute", minute, "minute_timestamp"), ("hourly", hourly, "hour_timestamp"),
               ("weather", weather, "hour_timestamp")]
    counts = None
    for name, df, ts in sources:
        one = (last_complete_hour(df, as_of, ts).agg(F.count("*").alias("n_rows"))
               .select(F.lit(name).alias("source"), "n_rows", (F.col("n_rows") > 0).alias("ready")))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def hour_series_complete(hourly: DataFrame) -> DataFrame:
    """Adds an empty row for each missing hour between a lot's first and last hour.

    The calendar joins the rows by union and a merge per key, so it needs one exchange
    and no join; hours that exist keep their values.
    """
    values = [c for c in hourly.columns if c not in (LOT, "hour_timestamp")]
    slot = seconds_floor("hour_timestamp", HOUR)
    span = hourly.groupBy(LOT).agg(F.min(slot).alias("a"), F.max(slot).alias("b"))
    days = span.select(LOT, "a", "b", F.explode(F.sequence(F.floor(F.col("a") / 24), F.floor(F.col("b") / 24))).alias("d"))
    hours = spread_out(days, LOT, "d").select(LOT, F.explode(F.sequence(
        F.greatest(F.col("a"), F.col("d") * 24), F.least(F.col("b"), F.col("d") * 24 + 23))).alias("h"))
    calendar_rows = hours.select(LOT, F.timestamp_seconds(F.col("h") * HOUR).alias("hour_timestamp"))
    return (hourly.withColumn("hour_timestamp", hour_floor("hour_timestamp"))
            .unionByName(calendar_rows, allowMissingColumns=True)
            .groupBy(LOT, "hour_timestamp")
            .agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])
            .select(*hourly.columns))
