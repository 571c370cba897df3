"""Trained forecasters in a folder, and stored forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.operators.models import TreeForecaster
from lotwise.operators.monitoring import backfill_actuals
from lotwise.plans.forecast import Hybrid, Model
from lotwise.schemas import LOT
from lotwise.sources.tables import as_stored, write_append, write_upsert

_TABLES = ["stats", "alpha", "metrics"]
_MODELS = ["model_a", "model_b"]
_FORECAST_KEY = [LOT, "prediction_made_at", "model_name", "target_hour"]


def _save_model(model: Model, path: str) -> str:
    """Writes one model and returns its kind."""
    if isinstance(model, DataFrame):
        model.write.parquet(f"{path}/linear")
        return "linear"
    model.levels.write.parquet(f"{path}/levels")
    model.ensembles.write.parquet(f"{path}/trees")
    return "named trees" if model.named else "trees"


def save_hybrid(spark: SparkSession, hybrid: Hybrid, path: str) -> None:
    """Writes a trained forecaster into a new folder.

    The list of its parts is written last: a folder without it is an unfinished save, which ``load_hybrid`` refuses.
    """
    for name in _TABLES:
        getattr(hybrid, name).write.parquet(f"{path}/{name}")
    parts = [(name, _save_model(getattr(hybrid, name), f"{path}/{name}")) for name in _MODELS]
    spark.createDataFrame(parts, "name string, kind string").coalesce(1).write.parquet(f"{path}/parts")


def _load_model(spark: SparkSession, kind: str, path: str) -> Model:
    if kind == "linear":
        return spark.read.parquet(f"{path}/linear")
    return TreeForecaster(spark.read.parquet(f"{path}/trees"), spark.read.parquet(f"{path}/levels"), kind == "named trees")


def load_hybrid(spark: SparkSession, path: str) -> Hybrid:
    """A saved forecaster; its list has one row per model."""
    kinds = {r["name"]: r["kind"] for r in spark.read.parquet(f"{path}/parts").collect()}
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in _TABLES}
    return Hybrid(**tables, **{name: _load_model(spark, kinds[name], f"{path}/{name}") for name in _MODELS})


def store_forecast(rows: DataFrame, wide: DataFrame, rows_path: str, wide_path: str) -> None:
    """Appends the wide rows, which must be new, and upserts the rows per hour.

    The hourly rows come first: they may be written again, so a job that died in between can be repeated.
    """
    write_upsert(rows_path, rows, _FORECAST_KEY, [], "prediction_made_at")
    write_append(wide_path, as_stored(wide), [LOT, "prediction_timestamp", "model_name"], "prediction_timestamp")


def store_actuals(spark: SparkSession, rows_path: str, checked_path: str, hourly: DataFrame, as_of: str, days: int = 3) -> None:
    """Upserts the stored forecasts of the last ``days`` days with what happened by ``as_of``."""
    start = F.to_timestamp(F.lit(as_of)) - F.expr(f"interval {days} days")
    rows = spark.read.parquet(rows_path).where(F.col("date") >= F.date_format(start, "yyyy-MM-dd")).drop("date")
    checked = backfill_actuals(rows, hourly, as_of).where("actual_free_spaces is not null")
    write_upsert(checked_path, as_stored(checked), _FORECAST_KEY, [], "prediction_made_at")
