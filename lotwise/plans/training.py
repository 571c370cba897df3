"""Batch preparation of the training table from landed stays and weather."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.categories import categories_training
from lotwise.operators.intervals import minute_free_spaces, minute_occupancy
from lotwise.operators.joins import training_join
from lotwise.operators.rollups import calendar_fields, hourly_rollup
from lotwise.schemas import LOT
from lotwise.sources.operations import (PLACE, operations_csv_scan, operations_epoch_to_timestamp,
                                        operations_valid_intervals)
from lotwise.sources.tables import insert_ignore, materialise
from lotwise.sources.weather import weather_json_explode


@dataclass
class TrainingTables:
    minute: DataFrame
    hourly: DataFrame
    training: DataFrame


def load_operations(spark: SparkSession, path: str, zone: str = "UTC") -> DataFrame:
    """Valid stays, the first read of each lot, space and arrival (by file name, then line), with timestamps."""
    rows = operations_valid_intervals(operations_csv_scan(spark, path, place=True))
    unique = insert_ignore(None, rows, [LOT, "parking_space_id", "arrival_unix_seconds"], PLACE).drop(*PLACE)
    return operations_epoch_to_timestamp(unique, zone)


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """One row per hour from JSON documents, one document per file; the first file by name wins."""
    raw = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    rows = weather_json_explode(raw, "value", "_file")
    return insert_ignore(None, rows, ["hour_timestamp"], ["_file", "_entry"]).drop("_file", "_entry")


def prepare_training_data(operations: DataFrame, weather: DataFrame, lots: DataFrame, out: str) -> TrainingTables:
    """Minute, hourly and training tables of all lots, each stored below ``out``.

    Every stage reads the stored stage before it, so a failed run repeats one stage only
    and a rerun replaces the tables.
    """
    minute = materialise(minute_free_spaces(minute_occupancy(operations), lots), f"{out}/minute",
                         "minute_timestamp", [LOT, "minute_timestamp"])
    hourly = materialise(calendar_fields(hourly_rollup(minute)), f"{out}/hourly",
                         "hour_timestamp", [LOT, "hour_timestamp"])
    training = materialise(categories_training(training_join(hourly, weather)), f"{out}/training",
                           "hour_timestamp", [LOT, "hour_timestamp"])
    return TrainingTables(minute, hourly, training)
