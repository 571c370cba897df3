"""Weather documents with parallel arrays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.clock import instant, plus_hours
from lotwise.schemas import WEATHER_DOCUMENT

MEASURES = ["temperature_2m", "relative_humidity_2m", "precipitation",
            "wind_speed_10m", "weather_code"]


def weather_json_explode(raw: DataFrame, document: str = "payload", place: str | None = None) -> DataFrame:
    """One row per entry of ``hourly.time``; a measure array that is too short gives NULL.

    ``place`` names a column of ``raw`` to keep, with the place in the document as ``_entry``.
    """
    kept = [place] if place else []
    parsed = raw.select(F.from_json(document, WEATHER_DOCUMENT).alias("d"), *kept)
    hours = F.posexplode("d.hourly.time").alias("_i", "_time")
    rows = parsed.select("d", *kept, hours)
    return rows.select(
        F.to_timestamp("_time").alias("hour_timestamp"),
        *[F.get(F.col(f"d.hourly.{m}"), F.col("_i")).alias(m) for m in MEASURES],
        F.col("d.latitude").alias("latitude"), F.col("d.longitude").alias("longitude"),
        *([*kept, F.col("_i").alias("_entry")] if place else []))


def weather_current_hour(weather: DataFrame, as_of: str | datetime | Column,
                         hours_ahead: int = 0) -> DataFrame:
    """The hour that holds ``as_of``; with ``hours_ahead`` all days up to the end hour's day."""
    now = F.date_trunc("hour", instant(as_of))
    if hours_ahead <= 0:
        return weather.where(F.col("hour_timestamp") == now)
    first = F.date_trunc("day", now)
    last = F.date_trunc("day", plus_hours(now, hours_ahead)) + F.expr("interval 1 day")
    return weather.where((F.col("hour_timestamp") >= first) & (F.col("hour_timestamp") < last))
