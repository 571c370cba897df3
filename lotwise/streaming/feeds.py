"""The minute and hour cycles as Structured Streaming queries.

Micro-batch results go to batch logs (``log``): a replay changes nothing, and a batch lists and reads only the days
that it touches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lotwise.functions.clock import HOUR, plus_hours, seconds_floor
from lotwise.functions.values import mean_of_integers
from lotwise.operators.blending import blend_predictions, constrain_predictions, prediction_rows, unscored_lots
from lotwise.operators.categories import categories_online
from lotwise.operators.features import online_features, temperature_diff_1h
from lotwise.operators.joins import weather_left_join
from lotwise.operators.models import TreeForecaster, predict_long
from lotwise.operators.rollups import calendar_fields
from lotwise.operators.supervised import flatten_window, minmax_per_timestep, model_frame, pad_window, recent_window
from lotwise.schemas import HOURLY, LANDED_SNAPSHOT, LOT
from lotwise.session import stored
from lotwise.sources.snapshots import minute_rows, occupancy_rate, occupancy_snapshot_parse
from lotwise.streaming.log import Sink, batch_log, days_of, log_days, next_number, read_log


def stream_minute_feed(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Landed snapshot documents as rows of their lot and minute, however late they come.

    A minute may come more than once; in the log the row fetched last wins (``minute_log``).
    """
    reader = spark.readStream.schema(LANDED_SNAPSHOT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return minute_rows(occupancy_rate(occupancy_snapshot_parse(reader.json(folder))))


def minute_log(spark: SparkSession, path: str, schema: StructType, days: Iterable[str] | None = None) -> DataFrame:
    """The logged minutes, the newest snapshot of each lot and minute."""
    return read_log(spark, path, schema, [LOT, "minute_timestamp"], days, ["fetched_at", "sequence"])


def stream_hourly_rollup(minutes_path: str, hourly_path: str) -> Sink:
    """Logs the minutes of each batch and computes the hours that they touch anew, open hours too."""
    minute = "minute_timestamp"

    def roll(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch, "minutes")
        days = days_of(rows, minute)
        if not days:
            return
        batch_log(minutes_path, minute)(rows, batch_id)
        touched = rows.select(LOT, F.date_trunc("hour", minute).alias("hour_timestamp"), F.to_date(minute).alias("_day")).distinct()
        # Late rows may span years: only the days that the batch touches are read.
        known = (minute_log(rows.sparkSession, minutes_path, rows.schema, days)
                 .withColumn("_day", F.to_date(minute)).join(touched.select(LOT, "_day").distinct(), [LOT, "_day"], "left_semi")
                 .where(F.col("free_spaces").isNotNull()))
        hours = known.groupBy(LOT, F.date_trunc("hour", minute).alias("hour_timestamp")).agg(
            F.sum("free_spaces").alias("_sum"), F.count("*").alias("_n"),
            F.min("free_spaces").alias("min_free_spaces"), F.max("free_spaces").alias("max_free_spaces"))
        hours = hours.join(touched.select(LOT, "hour_timestamp"), [LOT, "hour_timestamp"], "left_semi").select(
            LOT, "hour_timestamp", mean_of_integers(F.col("_sum"), F.col("_n")).alias("avg_free_spaces"),
            "min_free_spaces", "max_free_spaces",
            (F.col("max_free_spaces") - F.col("min_free_spaces")).alias("free_spaces_range"))
        batch_log(hourly_path, "hour_timestamp")(hours, batch_id)
    return roll


def drain(stream: DataFrame, sink: Sink | None, checkpoint: str, path: str | None = None) -> StreamingQuery:
    """Processes what has landed so far and stops; a restart goes on from the checkpoint."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query


def training_features(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """The online training table: calendar, weather, categories and the four engineered columns."""
    features = online_features(calendar_fields(hourly))
    return temperature_diff_1h(categories_online(weather_left_join(features, weather)), weather)


Weather = DataFrame | Callable[[], DataFrame]


def _refresh_hours(spark: SparkSession, changed: DataFrame, reach: int, weather: DataFrame, hourly_path: str,
                   features_path: str, lots: bool) -> None:
    """Recomputes the hours ``changed`` and the ``reach`` hours after each; hours without weather are held back.

    Hours and weather refresh the same log, each on its own stream, so its batches take numbers from the log: what was
    computed last, from all that was logged by then, wins. A replay computes again and adds equal or fresher rows, which
    ``compact_log`` merges.
    """
    hour = "hour_timestamp"
    keys = [LOT, hour] if lots else [hour]
    days = days_of(changed, hour, 1, 1)
    if not days:
        return
    number = next_number(spark, features_path)
    hourly = read_log(spark, hourly_path, HOURLY, [LOT, hour], days)
    at = seconds_floor(hour, HOUR)
    affected = (changed.select(*keys[:-1], F.explode(F.sequence(at, at + reach)).alias("_h")).distinct()
                .select(*keys[:-1], F.timestamp_seconds(F.col("_h") * HOUR).alias(hour)))
    ready = weather.select(hour).distinct()
    features = training_features(hourly, weather).join(affected, keys, "left_semi").join(ready, hour, "left_semi")
    batch_log(features_path, hour)(features.select(LOT, hour, *[c for c in features.columns if c not in (LOT, hour)]), number)


def stream_feature_refresh(weather: Weather, hourly_path: str, features_path: str) -> Sink:
    """Upserts changed hours and recomputes every hour whose 24-hour frame holds one.

    Those are the changed hour and the 23 hours after it; only the days around the batch are read again. Hours
    without weather wait for it (``stream_weather_refresh``); ``weather`` may be a function that reads it per batch.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch.select(HOURLY.fieldNames()), "hours")
        if not rows.isEmpty():
            batch_log(hourly_path, "hour_timestamp")(rows, batch_id)
            now = weather() if callable(weather) else weather
            _refresh_hours(rows.sparkSession, rows, 23, now, hourly_path, features_path, True)
    return refresh


def stream_weather_refresh(weather: Weather, hourly_path: str, features_path: str) -> Sink:
    """Recomputes the hours of all lots whose weather, or that of the hour before, has come or changed."""
    def refresh(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch.select("hour_timestamp").distinct(), "weather-hours")
        if not rows.isEmpty():
            now = weather() if callable(weather) else weather
            _refresh_hours(rows.sparkSession, rows, 1, now, hourly_path, features_path, False)
    return refresh


def score_latest(features: DataFrame, stats: DataFrame, model_a: DataFrame | TreeForecaster,
                 model_b: DataFrame | TreeForecaster, alpha: DataFrame, lots: DataFrame,
                 model_name: str, made_at: Column | None = None) -> DataFrame:
    """Forecast rows of every lot from its latest hours: two models, blended and limited."""
    frame = model_frame(stored(recent_window(features), "recent"))
    windows = stored(minmax_per_timestep(flatten_window(pad_window(frame)), stats), "windows")
    blended = blend_predictions(predict_long(model_a, windows), predict_long(model_b, windows), alpha)
    made = plus_hours(F.col("origin"), 1) + F.expr("interval 10 minutes") if made_at is None else made_at
    return prediction_rows(constrain_predictions(blended, lots, "hybrid"), made, model_name)


def recent_features(spark: SparkSession, path: str, schema: StructType, lots: DataFrame, newest: str,
                    n: int = 72, days: int = 30) -> DataFrame:
    """The last ``n`` stored hours of each of ``lots``, reading the newest ``days`` days first.

    Lots that have fewer rows there are looked up in the days before, twice as many each time, until all have ``n``
    hours or the log ends; so a lot that was silent for long still gets its last hours.
    """
    hour = "hour_timestamp"
    first = (date.fromisoformat(newest) - timedelta(days)).isoformat()
    held = [d for d in log_days(spark, path) if d <= newest]
    found, short, reach = None, lots.select(LOT).distinct(), [d for d in held if d >= first]
    earlier = held[:len(held) - len(reach)]
    while True:
        rows = read_log(spark, path, schema, [LOT, hour], reach).join(short, LOT, "left_semi")
        found = stored(recent_window(rows if found is None else found.unionByName(rows), n), "recent-hours")
        if not earlier:
            return found
        known = found.groupBy(LOT).agg(F.count("*").alias("_n"))
        short = stored(lots.join(known, LOT, "left").where(F.coalesce("_n", F.lit(0)) < n).select(LOT).distinct(), "short-lots")
        if short.isEmpty():
            return found
        days *= 2
        earlier, reach = earlier[:-days], earlier[-days:]


def stream_scoring(features_path: str, features_schema: StructType, predictions_path: str,
                   unscored_path: str | None = None, **parts) -> Sink:
    """Scores the lots of each batch from the stored features and logs the forecasts.

    A lot without ranges, models or weights does not hold up the others; ``unscored_path`` logs such lots with the reason.
    """
    def score(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.date_format(F.max("hour_timestamp"), "yyyy-MM-dd").alias("d")).first()["d"]
        if newest is None:
            return
        lots = batch.select(LOT).distinct()
        features = recent_features(batch.sparkSession, features_path, features_schema, lots, newest)
        rows = stored(score_latest(features, **parts), "forecast")
        batch_log(predictions_path, "prediction_made_at")(rows, batch_id)
        if unscored_path:
            held = {"ranges": parts["stats"], "first_model": parts["model_a"], "second_model": parts["model_b"], "weights": parts["alpha"]}
            held = {name: part for name, part in held.items() if isinstance(part, DataFrame)} | {"forecast": rows}
            left = unscored_lots(lots, **held).withColumn("noticed", F.to_timestamp(F.lit(newest)))
            batch_log(unscored_path, "noticed")(left, batch_id)
    return score


def chain(*sinks: Sink) -> Sink:
    """Runs several sinks on each micro-batch, in order."""
    return lambda batch, batch_id: reduce(lambda _, sink: sink(batch, batch_id), sinks, None)
