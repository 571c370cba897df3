"""Hourly rows with weather, and the newest forecast per lot.

No side carries a broadcast hint: the planner broadcasts a side whose measured size is
below the session's threshold and otherwise shuffles, with skewed keys split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lotwise.functions.clock import hour_floor
from lotwise.schemas import LOT

_HOURLY = ["hour_timestamp", LOT, "avg_free_spaces", "min_free_spaces", "max_free_spaces",
           "free_spaces_range", "hour_of_day", "day_of_week", "weekday_name", "day_of_month",
           "calendar_week", "month_number", "month_name"]
_WEATHER = ["temperature_2m", "relative_humidity_2m", "precipitation"]


def training_join(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """Hours with weather, 16 columns; hours without weather are dropped."""
    return (hourly.select(*_HOURLY)
            .join(weather.select("hour_timestamp", *_WEATHER), "hour_timestamp", "inner")
            .select(*_HOURLY, *_WEATHER))


def weather_left_join(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """Hours with the weather of the same whole hour; hours without weather stay."""
    keyed = weather.select(hour_floor("hour_timestamp").alias("_hour"), *_WEATHER)
    return (hourly.withColumn("_hour", hour_floor("hour_timestamp"))
            .join(keyed, "_hour", "left").select(*hourly.columns, *_WEATHER))


def latest_predictions(predictions: DataFrame, lots: DataFrame) -> DataFrame:
    """Wide forecasts whose ``created_at`` is the newest of their lot, ties kept, with the lot's name.

    ``rank`` = 1 is limited before the shuffle, so a lot sends its newest rows only.
    """
    newest = Window.partitionBy(LOT).orderBy(F.col("created_at").desc())
    names = lots.select(LOT, F.col("name").alias("parking_lot_name"))
    hours = [c for c in predictions.columns if c.startswith("hour_")]
    return (predictions.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
            .join(names, LOT, "left")
            .select(LOT, "parking_lot_name", "prediction_timestamp", "model_name", *hours, "created_at"))
