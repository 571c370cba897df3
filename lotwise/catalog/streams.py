"""Checks of the streaming queries: landed files drained to the end, compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.catalog.entry import Entry
from lotwise.catalog.inputs import _snapshot_documents
from lotwise.operators import lagged
from lotwise.plans.fixtures import Views
from lotwise.schemas import HOURLY, LOT
from lotwise.session import scratch_path, stored
from lotwise.streaming import feeds

_HOUR = "parking_lot_id:i hour_timestamp:t"
_MINUTE = "parking_lot_id:i minute_timestamp:t"


def _landed(v: Views) -> str:
    path = scratch_path(v.spark, "landed")
    _snapshot_documents(v).write.json(path)
    return path


def _minutes(v: Views) -> DataFrame:
    minutes, path = feeds.stream_minute_feed(v.spark, _landed(v)), scratch_path(v.spark, "minute-log")
    feeds.drain(minutes, feeds.batch_log(path, "minute_timestamp"), scratch_path(v.spark, "stream-state"))
    return feeds.minute_log(v.spark, path, minutes.schema)


def _hours(v: Views) -> DataFrame:
    minutes, hourly = scratch_path(v.spark, "minute-log"), scratch_path(v.spark, "hourly-log")
    stream = feeds.stream_minute_feed(v.spark, _landed(v), max_files=4)
    feeds.drain(stream, feeds.stream_hourly_rollup(minutes, hourly), scratch_path(v.spark, "stream-state"))
    return feeds.read_log(v.spark, hourly, HOURLY, [LOT, "hour_timestamp"])


def _hourly_stream(v: Views, files: int) -> DataFrame:
    """Hourly rows landed in time order, one file per micro-batch."""
    path = scratch_path(v.spark, "hours")
    rows = v.hourly.select([F.col(f.name).cast(f.dataType) for f in HOURLY.fields])
    rows.repartitionByRange(files, "hour_timestamp").write.parquet(path)
    return v.spark.readStream.schema(HOURLY).option("maxFilesPerTrigger", 1).parquet(path)


def _refreshed(v: Views) -> tuple[str, DataFrame]:
    hourly, features = scratch_path(v.spark, "hourly-log"), scratch_path(v.spark, "feature-log")
    weather = stored(v.weather, "weather")
    refresh = feeds.stream_feature_refresh(weather, hourly, features)
    feeds.drain(_hourly_stream(v, 3), refresh, scratch_path(v.spark, "refresh-state"))
    return features, v.online


def _features(v: Views) -> DataFrame:
    path, like = _refreshed(v)
    return feeds.read_log(v.spark, path, like.schema, [LOT, "hour_timestamp"])


def _scored(v: Views) -> DataFrame:
    """Two linear models, fitted on different spans, score the lots of each landed batch."""
    hours = stored(lagged.sample_hours(v.frame), "hours")
    stats = stored(lagged.fit_ranges(hours), "ranges")
    a = stored(lagged.fit_linear_hours(hours, stats), "model")
    b = stored(lagged.fit_linear_hours(hours, stats, splits=("train", "validation")), "model")
    features = scratch_path(v.spark, "feature-log")
    predictions = scratch_path(v.spark, "prediction-log")
    online = v.online
    feeds.batch_log(features, "hour_timestamp")(online, 0)
    score = feeds.stream_scoring(
        features, online.schema, predictions, stats=stats, model_a=a, model_b=b, alpha=v.alpha, lots=v.lots_open,
        model_name="hybrid_linear_linear")
    feeds.drain(_hourly_stream(v, 1), score, scratch_path(v.spark, "score-state"))
    return feeds.read_log(v.spark, predictions, v.forecasts.schema,
                          [LOT, "target_hour", "model_name", "prediction_made_at"])


ENTRIES = {
    "stream_minute_feed": Entry(
        f"{_MINUTE} free_spaces:i occupied_spaces:i total_spaces:i occupancy_rate:d parking_lot_name:s invalid:b", _minutes,
        """select parking_lot_id, date_trunc('minute', minute_timestamp)::timestamp minute_timestamp,
                   case when general_total <> 0 then general_total - general_occupied end free_spaces,
                   general_occupied occupied_spaces, general_total total_spaces,
                   case when general_total > 0 then general_occupied * 100.0 / general_total end occupancy_rate,
                   'Lot ' || parking_lot_id parking_lot_name, invalid
            from occupancy_snapshots
            qualify row_number() over (partition by parking_lot_id, date_trunc('minute', minute_timestamp)
                                       order by minute_timestamp desc, event_id desc) = 1"""),
    "stream_hourly_rollup": Entry(
        f"{_HOUR} avg_free_spaces:d min_free_spaces:i max_free_spaces:i free_spaces_range:i", _hours,
        """select parking_lot_id, date_trunc('hour', minute_timestamp)::timestamp hour_timestamp,
                   (200 * sum(free) + count(*)) // (2 * count(*)) / 100.0 avg_free_spaces, min(free) min_free_spaces,
                   max(free) max_free_spaces, max(free) - min(free) free_spaces_range
            from (select parking_lot_id, minute_timestamp,
                         case when general_total <> 0 then general_total - general_occupied end free
                  from occupancy_snapshots
                  qualify row_number() over (partition by parking_lot_id, date_trunc('minute', minute_timestamp)
                                             order by minute_timestamp desc, event_id desc) = 1)
            where free is not null
            group by 1, 2"""),
    "stream_feature_refresh": Entry(
        f"{_HOUR} avg_free_spaces:d avg_free_spaces_rolling_24h:d avg_free_spaces_std_24h:d avg_free_spaces_diff_1h:d "
        "temperature_diff_1h:d time_period:s temperature_category:s", _features, "select * from online"),
    "stream_scoring": Entry(
        "parking_lot_id:i prediction_made_at:t target_hour:t model_name:s hours_ahead:i predicted_free_spaces:i", _scored),
}
