"""Training of two models per horizon with their blend, and the forecast of all lots."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.blending import (blend_predictions, fit_alpha, prediction_summary, prediction_wide,
                                        regression_metrics)
from lotwise.operators.lagged import fit_linear_hours, fit_ranges, sample_hours
from lotwise.operators.models import TreeForecaster, predict_long
from lotwise.operators.supervised import minmax_per_timestep, model_frame, supervised_windows
from lotwise.schemas import LOT
from lotwise.session import stored
from lotwise.streaming.feeds import score_latest

Model = DataFrame | TreeForecaster
Fit = Callable[[DataFrame], Model]


@dataclass
class Hybrid:
    """Two fitted models with the input ranges and blend weights they belong to."""

    stats: DataFrame
    model_a: Model
    model_b: Model
    alpha: DataFrame
    metrics: DataFrame


def _targets(rows: DataFrame) -> DataFrame:
    return rows.select(LOT, "origin", "split", F.posexplode("targets").alias("_i", "actual")).select(
        LOT, "origin", "split", (F.col("_i") + 1).alias("horizon"), "actual")


def train_hybrid(features: DataFrame, fit_a: Fit | None, fit_b: Fit | None) -> Hybrid:
    """Fits both models on the training share, the weights on the validation share.

    A fit gets the scaled windows; without one, the linear model is taken from the hourly rows.
    Hours, scaled samples, predictions and models are stored between the jobs that read them.
    """
    frame = stored(model_frame(stored(features, "features")), "frame")
    hours = stored(sample_hours(frame), "hours")
    stats = stored(fit_ranges(hours), "ranges")
    scaled = stored(minmax_per_timestep(supervised_windows(frame), stats), "scaled")
    train, rest = scaled.where("split = 'train'"), scaled.where("split <> 'train'")
    models = [fit(train) if fit else fit_linear_hours(hours, stats) for fit in (fit_a, fit_b)]
    models = [stored(m, "model") if isinstance(m, DataFrame) else m for m in models]
    a, b = [stored(predict_long(m, rest), "predictions") for m in models]
    actual = stored(_targets(rest), "targets")
    key = [LOT, "origin", "horizon"]
    validation = actual.where("split = 'validation'").drop("split")
    alpha = stored(fit_alpha(a, b, validation).select(LOT, "horizon", "alpha"), "alpha")
    judged = None
    for name, pred in (("model_a", a), ("model_b", b), ("hybrid", blend_predictions(a, b, alpha))):
        part = pred.join(actual, key).withColumn("model_name", F.lit(name))
        judged = part if judged is None else judged.unionByName(part)
    return Hybrid(stats, *models, alpha, regression_metrics(judged, [LOT, "model_name", "split"]))


def forecast(features: DataFrame, hybrid: Hybrid, lots: DataFrame, model_name: str,
             made_at: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Next 24 hours of every lot: rows per hour, one wide row per lot, and a summary."""
    rows = stored(score_latest(features, hybrid.stats, hybrid.model_a, hybrid.model_b, hybrid.alpha, lots,
                               model_name, made_at), "forecast")
    return rows, prediction_wide(rows), prediction_summary(rows, hybrid.alpha, features)
