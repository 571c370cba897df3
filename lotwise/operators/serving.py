"""The queries behind the dashboard, for all lots in one pass."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.functions.clock import instant, plus_hours
from lotwise.operators.categories import availability, model_display_name, weather_code_description
from lotwise.operators.supervised import recent_window
from lotwise.schemas import DEFAULT_CAPACITY, LOT

_ISO = "yyyy-MM-dd'T'HH:mm:ss"


def latest_prediction_batch(pred: DataFrame) -> DataFrame:
    """Rows of each lot's newest ``prediction_made_at``; models tied at that time all stay."""
    newest = Window.partitionBy(LOT).orderBy(F.col("prediction_made_at").desc())
    return pred.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")


def availability_outlook(pred: DataFrame, lots: DataFrame) -> DataFrame:
    """Newest forecasts as free and occupied spaces, probability and class."""
    sizes = lots.select(LOT, F.col("total_spaces").cast("int").alias("_capacity"))
    rows = latest_prediction_batch(pred).join(sizes, LOT, "left").withColumn(
        "capacity", F.coalesce("_capacity", F.lit(DEFAULT_CAPACITY)))
    free = F.greatest(F.lit(0), F.least(F.col("predicted_free_spaces"), F.col("capacity")))
    rows = rows.withColumn("free_spots", free).withColumn("probability", F.col("free_spots") / F.col("capacity"))
    category, color = availability(F.col("probability"))
    return model_display_name(rows).select(
        LOT, "capacity", "prediction_made_at", F.col("model_display").alias("model"), "target_hour", "hours_ahead",
        "free_spots", (F.col("capacity") - F.col("free_spots")).alias("occupied_spots"), "probability",
        category.alias("availability_category"), color.alias("availability_color"))


def current_status(minute: DataFrame, lots: DataFrame) -> DataFrame:
    """The newest minute row per lot with its availability; unknown counts show as 0.

    The newest time of a lot is a hash aggregate over two columns; only the rows at that time take part in what follows,
    so the minutes are neither sorted nor shuffled. Of several rows at that time the one with the most free spaces shows.
    """
    fields = ["minute_timestamp", "free_spaces", "occupied_spaces", "total_spaces", "occupancy_rate",
              "parking_lot_name"]
    last = minute.groupBy(F.col(LOT).alias("_lot")).agg(F.max("minute_timestamp").alias("_last"))
    at_last = minute.select(LOT, *fields).join(last, F.col(LOT).eqNullSafe(F.col("_lot")) & (F.col("minute_timestamp") == F.col("_last")))
    first = Window.partitionBy(LOT).orderBy(*(F.col(c).desc_nulls_last() for c in fields[1:]))
    newest = at_last.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(LOT, *fields)
    sizes = lots.select(LOT, F.col("total_spaces").cast("long").alias("_capacity"))
    filled = newest.join(sizes, LOT, "left").withColumn("capacity", F.coalesce(
        "_capacity", F.when(F.col("total_spaces") != 0, F.col("total_spaces")), F.lit(DEFAULT_CAPACITY)))
    probability = F.when(F.col("capacity") > 0, F.coalesce("free_spaces", F.lit(0)) / F.col("capacity")) \
        .otherwise(F.lit(0.0))
    category, color = availability(probability)
    return filled.select(
        LOT, F.coalesce("parking_lot_name", F.concat(F.lit("Parking Lot "), F.col(LOT).cast("string"))).alias("lot_name"),
        F.col("minute_timestamp").alias("status_time"),
        F.coalesce("free_spaces", F.lit(0)).alias("free_spaces"),
        F.coalesce("occupied_spaces", F.lit(0)).alias("occupied_spaces"),
        F.col("capacity").alias("total_spaces"), F.coalesce("occupancy_rate", F.lit(0.0)).alias("occupancy_rate"),
        F.round(probability * 100, 1).alias("availability_probability"),
        category.alias("availability_category"), color.alias("availability_color"))


def historical_window(training: DataFrame, n: int = 48) -> DataFrame:
    """The last ``n`` hours per lot; an unknown value counts 0."""
    return recent_window(training.select(LOT, "hour_timestamp", "avg_free_spaces"), n).select(
        LOT, "hour_timestamp", F.coalesce(F.col("avg_free_spaces").cast("double"), F.lit(0.0)).alias("free_spots"))


def trend(history: DataFrame, outlook: DataFrame) -> DataFrame:
    """History, then forecast, on one time axis for lots that have both."""
    past = history.join(outlook.select(LOT), LOT, "left_semi").select(
        LOT, F.col("hour_timestamp").alias("axis_time"), F.lit("history").alias("series"),
        F.lit(None).cast("string").alias("model"), F.col("free_spots").alias("historical"),
        F.lit(None).cast("double").alias("predicted"))
    ahead = outlook.join(history.select(LOT), LOT, "left_semi").select(
        LOT, F.col("target_hour").alias("axis_time"), F.lit("forecast").alias("series"), "model",
        F.lit(None).cast("double").alias("historical"), F.col("free_spots").cast("double").alias("predicted"))
    return past.unionByName(ahead)


def _documents(df: DataFrame, order: list[str], fields: list[Column], name: str) -> DataFrame:
    """A sorted list of small structs per lot; callers pass bounded groups only."""
    entry = F.struct(*order, F.struct(*fields).alias("_e"))
    return (df.groupBy(LOT).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
            .select(LOT, F.transform("_l", lambda x: x["_e"]).alias(name)))


def dashboard_bundle(status: DataFrame, outlook: DataFrame, history: DataFrame) -> DataFrame:
    """One JSON document per lot with status, forecast and history; absent parts are null.

    The lists hold at most one forecast batch and the history window of a lot.
    """
    state = status.select(LOT, F.struct(
        F.col("lot_name"), F.date_format("status_time", _ISO).alias("status_time"), F.col("free_spaces"),
        F.col("occupied_spaces"), F.col("total_spaces"), F.col("availability_category")).alias("status"))
    forecast = _documents(outlook, ["model", "hours_ahead"], [
        F.col("model"), F.date_format("target_hour", _ISO).alias("target_hour"), F.col("hours_ahead"),
        F.col("free_spots"), F.col("occupied_spots"), F.col("availability_category")], "forecast")
    past = _documents(history, ["hour_timestamp"], [
        F.date_format("hour_timestamp", _ISO).alias("hour"), F.round("free_spots", 2).alias("free_spots")], "history")
    joined = state.join(forecast, LOT, "full").join(past, LOT, "full")
    return joined.select(LOT, F.to_json(F.struct("status", "forecast", "history"),
                                        {"ignoreNullFields": "false"}).alias("document"))


def weather_next_24h(weather: DataFrame, as_of: str | datetime | Column, n: int = 24) -> DataFrame:
    """The ``n`` hours from the current one to the end of the next day; the first is current."""
    now = F.date_trunc("hour", instant(as_of))
    end = F.date_trunc("day", plus_hours(now, 24)) + F.expr("interval 1 day")
    hours = (weather.where((F.col("hour_timestamp") >= now) & (F.col("hour_timestamp") < end))
             .orderBy("hour_timestamp").limit(n))
    first = F.min("hour_timestamp").over(Window.partitionBy())
    return weather_code_description(hours).withColumn("is_current", F.col("hour_timestamp") == first)


def latest_weather(weather: DataFrame) -> DataFrame:
    return weather.orderBy(F.col("hour_timestamp").desc()).limit(1)


def table_samples(df: DataFrame, ts: str, n: int = 10, tie_break: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by time, each with the row count of the whole table."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return df.orderBy(ts, *(tie_break or [])).limit(n).withColumn("total_rows", total)
