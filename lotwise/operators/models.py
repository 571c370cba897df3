"""Forecast models: linear regression, random forest, gradient boosting.

The linear model is solved for all lots and horizons in one job from summed cross
products; a lot of any size only ever meets the solver as a matrix of fixed size. A tree
model is one ensemble whose leaves hold all horizons, over all lots or per named lot; it
learns distances from each lot's level.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lotwise.functions.clock import DAY, seconds_floor
from lotwise.operators import trees as ensembles
from lotwise.operators.frames import join_per_lot, spread_out
from lotwise.schemas import HORIZON_HOURS, LOT
from lotwise.session import stored

# The task functions below travel by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINEAR_MODEL = f"{LOT} int, horizon int, intercept double, coefficients array<double>"
_FIT_SLOT = 180 * DAY         # samples of one lot and slot are summed in one task
_SCORE_SLOT = 30 * DAY        # windows of one lot and slot are scored together
_ALL_LOTS = -1                # group of an ensemble over all lots


def _cross_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per lot the rows of [X 1]' [X 1 Y]; rows arrive sorted by lot, one sum is held at a time."""
    lot, total = None, None

    def rows() -> pd.DataFrame:
        return pd.DataFrame({LOT: lot, "r": range(len(total)), "products": list(total)})

    for batch in batches:
        for key, part in batch.groupby(LOT):
            x = np.vstack(part["window"].to_numpy())
            x = np.hstack([x, np.ones((len(x), 1))])
            products = x.T @ np.hstack([x, np.vstack(part["targets"].to_numpy())])
            if key == lot:
                total += products
            else:
                if lot is not None:
                    yield rows()
                lot, total = key, products
    if lot is not None:
        yield rows()


def least_squares(xx: np.ndarray, xy: np.ndarray, mean_x: np.ndarray, mean_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of smallest norm and intercepts, from centred products and means."""
    values, vectors = np.linalg.eigh(xx)
    kept = values > values.max() * len(xx) * np.finfo(float).eps
    inverse = np.where(kept, 1 / np.where(kept, values, 1), 0)
    weights = vectors @ (inverse[:, None] * (vectors.T @ xy))
    return weights, mean_y - mean_x @ weights


def _solve(rows: pd.DataFrame) -> pd.DataFrame:
    """Least squares of smallest norm from the summed products of one lot."""
    products = np.vstack(rows.sort_values("r")["products"].to_numpy())
    p = len(products) - 1
    n = products[p, p]
    mean_x, mean_y = products[p, :p] / n, products[p, p + 1:] / n
    xx = products[:p, :p] - n * np.outer(mean_x, mean_x)
    xy = products[:p, p + 1:] - n * np.outer(mean_x, mean_y)
    weights, intercepts = least_squares(xx, xy, mean_x, mean_y)
    return pd.DataFrame({LOT: rows[LOT].iloc[0], "horizon": range(1, len(intercepts) + 1),
                         "intercept": intercepts, "coefficients": list(weights.T)})


def fit_linear(samples: DataFrame) -> DataFrame:
    """Multi-output least squares per lot: one row per (lot, horizon) with its coefficients."""
    keyed = samples.select(LOT, seconds_floor("origin", _FIT_SLOT).alias("_slot"), "window", "targets")
    placed = spread_out(keyed, LOT, "_slot").sortWithinPartitions(LOT)
    parts = placed.drop("_slot").mapInPandas(
        _cross_products, f"{LOT} int, r int, products array<double>")
    summed = (parts.select(LOT, "r", array_to_vector("products").alias("_v"))
              .groupBy(LOT, "r").agg(Summarizer.metrics("sum").summary(F.col("_v")).alias("_s"))
              .select(LOT, "r", vector_to_array("_s.sum").alias("products")))
    return summed.groupBy(LOT).applyInPandas(_solve, LINEAR_MODEL)


@dataclass
class TreeForecaster:
    """A packed ensemble over all lots, or one for each of the ``named`` lots, one row each.

    ``levels`` holds the mean and the spread of each lot's training targets.
    """

    ensembles: DataFrame
    levels: DataFrame
    named: bool


def _lot_levels(samples: DataFrame) -> DataFrame:
    """Mean and spread of the targets per lot, combined map-side; the row without lot holds those of all lots."""
    each = samples.select(LOT, F.explode("targets").alias("_y"))
    spread = F.stddev_pop("_y")
    return each.rollup(LOT).agg(F.avg("_y").alias("_level"), F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("_spread"))


def _tree_inputs(samples: DataFrame, levels: DataFrame) -> DataFrame:
    """Adds the lot's ``_level`` and ``_spread``, and ``x``: the window followed by both.

    Trees learn targets as distances from the lot's level in units of its spread, so that any number of lots can be
    told apart. A lot that was not in training takes the figures of all lots.
    """
    figures = ["_level", "_spread"]
    overall = levels.where(F.col(LOT).isNull()).first()
    joined = join_per_lot(samples, levels.where(F.col(LOT).isNotNull()), "origin")
    known = joined.withColumns({c: F.coalesce(c, F.lit(overall[c] if overall else None).cast("double")) for c in figures})
    return known.withColumn("x", F.concat("window", F.array(*figures)))


def _fit_trees(samples: DataFrame, fit, horizons: int, lots: list[int] | None) -> TreeForecaster:
    levels = stored(_lot_levels(samples), "levels")
    distances = F.transform(F.slice("targets", 1, horizons), lambda y: (y - F.col("_level")) / F.col("_spread")).alias("targets")
    chosen = samples if lots is None else samples.where(F.col(LOT).isin(lots))
    group = F.lit(_ALL_LOTS) if lots is None else F.col(LOT)
    key = F.xxhash64(LOT, "origin").alias("key")
    rows = stored(_tree_inputs(chosen, levels).select(group.cast("int").alias("grp"), key, "x", distances), "tree-samples")
    return TreeForecaster(stored(fit(rows), "ensembles"), levels, lots is not None)


def fit_random_forest(samples: DataFrame, horizons: int = HORIZON_HOURS, lots: list[int] | None = None,
                      trees: int = 100, depth: int = 8, seed: int = 42, share: float = 1 / 3, bootstrap: bool = True) -> TreeForecaster:
    """One forest whose leaves hold all horizons; a node may split on ``share`` of the inputs.

    ``lots`` names lots that get forests of their own, grown by the same jobs.
    """
    return _fit_trees(samples, lambda rows: ensembles.forest(rows, trees, depth, seed, share, bootstrap), horizons, lots)


def fit_gradient_boosting(samples: DataFrame, horizons: int = HORIZON_HOURS, lots: list[int] | None = None,
                          rounds: int = 50, depth: int = 4, step: float = 0.1, seed: int = 42) -> TreeForecaster:
    """One chain of rounds for all horizons, with the same choice of all or named lots."""
    return _fit_trees(samples, lambda rows: ensembles.boosting(rows, rounds, depth, step, seed), horizons, lots)


def _score_linear(windows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    if windows.empty or model.empty:
        return pd.DataFrame({LOT: pd.Series(dtype="int32"), "origin": pd.Series(dtype="datetime64[ns]"),
                             "predictions": pd.Series(dtype=object)})
    model = model.sort_values("horizon")
    x = np.vstack(windows["window"].to_numpy())
    y = x @ np.vstack(model["coefficients"].to_numpy()).T + model["intercept"].to_numpy()
    return pd.DataFrame({LOT: windows[LOT], "origin": windows["origin"], "predictions": list(y)})


def _linear_predictions(model: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows meet their lot's coefficients per (lot, month), so a group stays small."""
    slot = seconds_floor("origin", _SCORE_SLOT)
    placed = windows.select(LOT, "origin", "window", slot.alias("_slot"))
    slots = windows.select(F.col(LOT).alias("_lot"), slot.alias("_part")).distinct()
    fitted = model.join(slots, F.col(LOT) == F.col("_lot")).drop("_lot")
    return (placed.groupBy(LOT, "_slot").cogroup(fitted.groupBy(LOT, "_part"))
            .applyInPandas(_score_linear, f"{LOT} int, origin timestamp, predictions array<double>"))


_TREE_INPUT = [LOT, "origin", "_level", "_spread", "x"]
_PREDICTED = f"{LOT} int, origin timestamp, predictions array<double>"


def _pooled_predictions(model: TreeForecaster, inputs: DataFrame) -> DataFrame:
    """Every batch meets the one ensemble, whose size is bounded by its trees and their depth."""
    found = model.ensembles.first()
    if found is None:   # there were no samples to learn from
        return inputs.sparkSession.createDataFrame([], _PREDICTED)
    ensemble = found.asDict()

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("x").flatten()).reshape(b.num_rows, -1)
                y = ensembles.evaluated(x, ensemble)
                y = y * np.asarray(b.column("_spread"))[:, None] + np.asarray(b.column("_level"))[:, None]
                yield pa.RecordBatch.from_arrays([b.column(LOT), b.column("origin"), pa.array(list(y), pa.list_(pa.float64()))],
                                                 [LOT, "origin", "predictions"])
    return inputs.mapInArrow(run, _PREDICTED)


def _score_trees(windows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    if windows.empty or model.empty:
        return pd.DataFrame({LOT: pd.Series(dtype="int32"), "origin": pd.Series(dtype="datetime64[ns]"),
                             "predictions": pd.Series(dtype=object)})
    y = ensembles.evaluated(np.vstack(windows["x"].to_numpy()), model.iloc[0])
    y = y * windows["_spread"].to_numpy()[:, None] + windows["_level"].to_numpy()[:, None]
    return pd.DataFrame({LOT: windows[LOT], "origin": windows["origin"], "predictions": list(y)})


def _tree_predictions(model: TreeForecaster, windows: DataFrame) -> DataFrame:
    """All horizons at once; with named lots, windows meet their lot's ensemble per (lot, month)."""
    inputs = _tree_inputs(windows, model.levels).select(*_TREE_INPUT)
    if not model.named:
        return _pooled_predictions(model, inputs)
    slot = seconds_floor("origin", _SCORE_SLOT)
    slots = windows.select(F.col(LOT).alias("_lot"), slot.alias("_part")).distinct()
    fitted = model.ensembles.join(slots, F.col("grp") == F.col("_lot")).drop("_lot")
    return (inputs.withColumn("_slot", slot).groupBy(LOT, "_slot").cogroup(fitted.groupBy("grp", "_part"))
            .applyInPandas(_score_trees, _PREDICTED))


def predict_long(model: DataFrame | TreeForecaster, windows: DataFrame,
                 horizons: int = HORIZON_HOURS) -> DataFrame:
    """(lot, origin, horizon, prediction); missing horizons repeat the model's last output."""
    wide = _tree_predictions(model, windows) if isinstance(model, TreeForecaster) else _linear_predictions(model, windows)
    horizon = F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("horizon")
    return (wide.select("*", horizon)
            .select(LOT, "origin", "horizon", F.element_at(
                "predictions", F.least("horizon", F.size("predictions"))).alias("prediction")))
