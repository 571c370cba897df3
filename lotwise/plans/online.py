"""The hourly transformation: last hour's rollup, then its feature rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lotwise.functions.clock import plus_hours
from lotwise.operators.rollups import hourly_rollup_window, last_complete_hour, last_hour, readiness_counts
from lotwise.schemas import HOURLY, LOT
from lotwise.sources.tables import write_upsert
from lotwise.streaming.feeds import training_features

AsOf = str | datetime | Column
HOUR = "hour_timestamp"


def _reachable_hours(spark: SparkSession, path: str, as_of: AsOf) -> DataFrame:
    """Stored hours in the frames of the last hour; the day folders are pruned."""
    start, end = last_hour(as_of)
    first = plus_hours(start, -24)
    rows = spark.read.schema(StructType([*HOURLY.fields]).add("date", "string")).parquet(path)
    return rows.where((F.col("date") >= F.date_format(first, "yyyy-MM-dd")) & (F.col(HOUR) >= first)
                      & (F.col(HOUR) < end)).drop("date")


def transform_last_hour(minute: DataFrame, weather: DataFrame, hourly_path: str, features_path: str,
                        as_of: AsOf) -> list[str]:
    """Upserts the last complete hour into both tables; returns the steps that ran.

    A step whose inputs hold no row for that hour is skipped.
    """
    spark = minute.sparkSession
    counts = readiness_counts(minute, spark.createDataFrame([], HOURLY), weather, as_of)
    ready = {r["source"] for r in counts.where("ready").collect()}
    if "minute" not in ready:
        return []
    hours = hourly_rollup_window(minute, *last_hour(as_of)).select(
        *[F.col(f.name).cast(f.dataType) for f in HOURLY.fields])
    write_upsert(hourly_path, hours, [LOT, HOUR], [HOUR], HOUR)
    if "weather" not in ready:
        return ["hourly"]
    features = training_features(_reachable_hours(spark, hourly_path, as_of), weather)
    write_upsert(features_path, last_complete_hour(features, as_of), [LOT, HOUR], [HOUR], HOUR)
    return ["hourly", "features"]
