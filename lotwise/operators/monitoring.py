"""Forecast against what happened."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.clock import hour_floor, instant, plus_hours
from lotwise.schemas import LOT

_FILLED = ["actual_free_spaces", "prediction_error", "absolute_error", "percentage_error", "evaluated_at"]


def backfill_actuals(pred: DataFrame, hourly: DataFrame, as_of: str | datetime | Column) -> DataFrame:
    """Fills the evaluation of forecasts whose target hour is complete at ``as_of``.

    Rows that already hold an actual keep it; rows without a matching hour stay pending. An
    actual of 0 leaves the percentage NULL.
    """
    now = instant(as_of)
    for name in _FILLED:
        if name not in pred.columns:
            kind = {"actual_free_spaces": "int", "evaluated_at": "timestamp"}.get(name, "double")
            pred = pred.withColumn(name, F.lit(None).cast(kind))
    done = (hourly.where(F.col("hour_timestamp") < hour_floor(now))
            .select(LOT, F.col("hour_timestamp").alias("target_hour"),
                    F.round("avg_free_spaces").cast("int").alias("_actual")))
    joined = pred.join(done, [LOT, "target_hour"], "left")
    pending = F.col("actual_free_spaces").isNull() & F.col("_actual").isNotNull()
    error = F.col("predicted_free_spaces") - F.col("_actual")
    fresh = {
        "actual_free_spaces": F.col("_actual"),
        "prediction_error": error.cast("double"),
        "absolute_error": F.abs(error).cast("double"),
        "percentage_error": F.when(F.col("_actual") != 0, F.abs(error) / F.abs("_actual") * 100),
        "evaluated_at": now,
    }
    return joined.select(*[
        (F.when(pending, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c))
        for c in pred.columns])


def _evaluated(pred: DataFrame) -> DataFrame:
    return pred.where(F.col("actual_free_spaces").isNotNull())


def model_performance(pred: DataFrame) -> DataFrame:
    """Count, MAE, RMSE, MAPE and target span per lot and model."""
    error = F.col("prediction_error")
    return _evaluated(pred).groupBy(LOT, "model_name").agg(
        F.count("*").alias("total_predictions"), F.avg("absolute_error").alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg("percentage_error").alias("mape"),
        F.min("target_hour").alias("first_prediction"), F.max("target_hour").alias("last_prediction"))


def performance_by_horizon(pred: DataFrame) -> DataFrame:
    return _evaluated(pred).groupBy(LOT, "model_name", "hours_ahead").agg(
        F.count("*").alias("n_predictions"), F.avg("absolute_error").alias("mae"),
        F.avg("percentage_error").alias("mape"))


def recent_errors(pred: DataFrame, as_of: str | datetime | Column, hours: int = 48, n: int = 100) -> DataFrame:
    """The ``n`` newest targets evaluated in the last ``hours``; ties are cut by the full key."""
    recent = _evaluated(pred).where(F.col("evaluated_at") > plus_hours(instant(as_of), -hours))
    columns = ["target_hour", LOT, "hours_ahead", "model_name", "prediction_made_at", "predicted_free_spaces",
               "actual_free_spaces", "prediction_error", "percentage_error"]
    return (recent.orderBy(F.col("target_hour").desc(), LOT, "hours_ahead", "model_name", "prediction_made_at")
            .limit(n).select(*columns))
