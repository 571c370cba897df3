"""Ranges and linear models of windows, taken from the hourly rows themselves.

A window of 48 hours repeats every hour 48 times. Nothing here builds windows: a sample is a
mark on its hour, and what a fit needs comes from the series. The product of the
inputs at lags i and j, summed over the samples, differs from that at lags i + 1 and j + 1 only
where a run of samples begins or ends. So the whole matrix follows from the products of lag 0
with every lag and from one correction per end of a run.

Inputs hold no NULL (``model_frame`` fills them); a sample has ``past`` rows of its lot up to its own.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lotwise.operators.frames import copied_to_slots, join_per_lot, over_rows, spread_out
from lotwise.operators.models import LINEAR_MODEL, least_squares
from lotwise.operators.supervised import TS, share_of
from lotwise.schemas import HORIZON_HOURS, LOT, MODEL_FEATURES, PAST_HOURS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECE_ROWS = 4000            # hours of one lot that meet in a task, besides the few their windows reach


def sample_hours(frame: DataFrame, past: int = PAST_HOURS, horizon: int = HORIZON_HOURS, features: list[str] | None = None,
                 target: str = "avg_free_spaces", train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """One row an hour with its inputs ``x`` and target ``y``; ``split`` marks the origins of samples.

    The samples are those of ``supervised_windows``; other hours have no ``split``. ``place`` numbers a lot's hours from 1.
    """
    seen = F.col("observed") if "observed" in frame.columns else F.lit(True)
    rows = frame.select(LOT, TS, F.col(target).cast("double").alias("y"), seen.cast("int").alias("_seen"),
                        F.array(*[F.col(c).cast("double") for c in features or MODEL_FEATURES]).alias("x"))
    known = over_rows(rows, TS, lambda w: {"_known": F.sum("_seen").over(w.rowsBetween(1, horizon))},
                      after=horizon, keep_row=True, total="_rows")
    full = (F.col("_row") >= past) & (F.col("_known") == horizon)
    return known.select(LOT, TS, F.col("_row").alias("place"), F.when(full, share_of(past, horizon, train, validation)).alias("split"),
                        "x", "y")


def _placed(hours: DataFrame, splits: tuple[str, ...], before: int, after: int) -> DataFrame:
    """Hours in pieces of a lot, each with the rows around it that its samples reach, sorted in their tasks."""
    used = F.coalesce(F.col("split").isin(*splits), F.lit(False))
    pieces = copied_to_slots(hours.select(LOT, "place", "x", "y", used.alias("used")), F.col("place"), _PIECE_ROWS, before, after)
    own = pieces.select(LOT, "_slot", "place", (F.col("_slot") == F.col("_home")).alias("own"), "used", "x", "y")
    return spread_out(own, LOT, "_slot").sortWithinPartitions(LOT, "_slot", "place")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(lot, columns) of one piece after the other, whatever the borders of the batches."""
    def arrays() -> tuple[int, dict[str, np.ndarray]]:
        columns = {c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in held]) for c in ("own", "used", "y")}
        x = np.concatenate([p.column("x").flatten().to_numpy(zero_copy_only=False) for p in held])
        return key[0], {**columns, "x": x.reshape(len(columns["y"]), -1)}

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lots, slots = (batch.column(c).to_numpy() for c in (LOT, "_slot"))
        cuts = (np.flatnonzero((np.diff(lots) != 0) | (np.diff(slots) != 0)) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if held and key != (lots[start], slots[start]):
                yield arrays()
                held = []
            key = (lots[start], slots[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield arrays()


def _per_lot(batches: Iterator[pa.RecordBatch], figures: Callable, joined: Callable) -> Iterator[tuple[int, dict]]:
    """The pieces' figures, joined for all pieces of a lot in this task; one lot is held at a time."""
    lot, total = None, None
    for key, piece in _pieces(batches):
        found = figures(piece)
        if found is None:
            continue
        if total is not None and key == lot:
            total = joined(total, found)
        else:
            if total is not None:
                yield lot, total
            lot, total = key, found
    if total is not None:
        yield lot, total


def fit_ranges(hours: DataFrame, past: int = PAST_HOURS, splits: tuple[str, ...] = ("train",)) -> DataFrame:
    """Smallest and largest value of every window position per lot, as ``fit_minmax`` gives them for the windows."""
    def figures(piece: dict):
        origins = np.flatnonzero(piece["own"] & piece["used"])
        if not len(origins):
            return None
        x = piece["x"]
        # Hours that all lags of some samples reach count for every position; only the others are looked at per lag.
        reached = np.zeros(len(x) + past, dtype=int)
        np.add.at(reached, origins - (past - 1), 1)
        np.add.at(reached, origins + 1, -1)
        everywhere = np.flatnonzero(np.cumsum(reached)[:len(x)] == past)
        marked = np.zeros(len(x), dtype=bool)
        marked[origins] = True
        ends = np.setdiff1d(np.flatnonzero(np.cumsum(reached)[:len(x)]), everywhere)
        low, high = np.full((past, x.shape[1]), np.inf), np.full((past, x.shape[1]), -np.inf)
        if len(everywhere):
            low[:], high[:] = x[everywhere].min(0), x[everywhere].max(0)
        for lag in range(past):
            at = ends[(ends + lag < len(x)) & marked[np.minimum(ends + lag, len(x) - 1)]]
            if len(at):
                step = past - 1 - lag
                low[step] = np.minimum(low[step], x[at].min(0))
                high[step] = np.maximum(high[step], x[at].max(0))
        return low.ravel(), high.ravel()

    def joined(a, b):
        return np.minimum(a[0], b[0]), np.maximum(a[1], b[1])

    def run(batches):
        for lot, (low, high) in _per_lot(batches, figures, joined):
            yield pa.RecordBatch.from_pandas(pd.DataFrame({LOT: [np.int32(lot)], "low": [low], "high": [high]}), preserve_index=False)

    parts = _placed(hours, splits, past - 1, 0).mapInArrow(run, f"{LOT} int, low array<double>, high array<double>")
    return (parts.select(LOT, array_to_vector("low").alias("_l"), array_to_vector("high").alias("_h"))
            .groupBy(LOT).agg(Summarizer.metrics("min").summary(F.col("_l")).alias("_a"),
                              Summarizer.metrics("max").summary(F.col("_h")).alias("_b"))
            .select(LOT, vector_to_array("_a.min").alias("low"), vector_to_array("_b.max").alias("high")))


def _with_scale(ranges: DataFrame, past: int) -> DataFrame:
    """Adds each input's smallest value ``base`` and its extent ``unit`` over all positions (1 for a constant)."""
    width = (F.size("low") / past).cast("int")

    def over_positions(name: str, pick):
        return F.transform(F.sequence(F.lit(0), width - 1), lambda f: pick(F.filter(name, lambda _, p: p % width == f)))
    both = ranges.select(LOT, "low", "high", over_positions("low", F.array_min).alias("base"),
                         over_positions("high", F.array_max).alias("_top"))
    unit = F.zip_with("_top", "base", lambda t, b: F.when(t > b, t - b).otherwise(F.lit(1.0)))
    return both.withColumn("unit", unit).drop("_top")


def _products(past: int, horizon: int) -> Callable:
    """Per lot: products of lag 0 with every lag, of inputs with targets, sums, and corrections at the ends of runs."""
    def figures(piece: dict):
        x, y, used = piece["x"], piece["y"], piece["used"]
        before = np.concatenate([[False], used[:-1]])
        ends = np.flatnonzero(piece["own"] & (used != before)) if past > 1 else np.zeros(0, dtype=int)
        origins = np.flatnonzero(piece["own"] & used)
        if not len(origins) and not len(ends):
            return None
        now, goals = x[origins], y[origins[:, None] + np.arange(1, horizon + 1)]
        lags = []
        for lag in range(past):
            then = x[origins - lag]
            lags.append(np.concatenate([(now.T @ then).ravel(), (then.T @ goals).ravel(), then.sum(0)]))
        total = np.concatenate([[len(origins)], goals.sum(0)])
        edge = None
        if len(ends):
            v = x[ends[:, None] - 1 - np.arange(past - 1)].reshape(len(ends), -1)
            edge = (v * np.where(used[ends], 1.0, -1.0)[:, None]).T @ v
        return np.array(lags), total, edge

    def joined(a, b):
        edge = a[2] if b[2] is None else b[2] if a[2] is None else a[2] + b[2]
        return a[0] + b[0], a[1] + b[1], edge

    def run(batches):
        for lot, (lags, total, edge) in _per_lot(batches, figures, joined):
            for kind, rows in (("lag", lags), ("total", total[None]), ("edge", [] if edge is None else edge)):
                if len(rows):
                    yield pa.RecordBatch.from_pandas(pd.DataFrame(
                        {LOT: np.int32(lot), "kind": kind, "r": np.arange(len(rows), dtype=np.int32), "products": list(rows)}),
                        preserve_index=False)
    return run


def _window_products(lags: np.ndarray, edge: np.ndarray | None, past: int, width: int) -> np.ndarray:
    """Products of all positions of the window, oldest hour first, from those of lag 0 and the corrections."""
    full = np.zeros((past, past, width, width))
    full[0] = lags[:, :width * width].reshape(past, width, width)
    full[:, 0] = full[0].transpose(0, 2, 1)
    steps = np.zeros((past - 1, past - 1, width, width)) if edge is None else \
        edge.reshape(past - 1, width, past - 1, width).transpose(0, 2, 1, 3)
    for lag in range(past - 1):
        full[lag + 1, 1:] = full[lag, :-1] + steps[lag]
    return full[::-1, ::-1].transpose(0, 2, 1, 3).reshape(past * width, past * width)


def _solver(past: int, scaled: bool) -> Callable:
    def solve(rows: pd.DataFrame, ranges: pd.DataFrame) -> pd.DataFrame:
        def part(kind: str) -> np.ndarray | None:
            found = rows[rows["kind"] == kind].sort_values("r")["products"]
            return np.vstack(found.to_numpy()) if len(found) else None
        if rows.empty or ranges.empty:
            return pd.DataFrame({LOT: pd.Series(dtype="int32"), "horizon": pd.Series(dtype="int32"),
                                 "intercept": pd.Series(dtype=float), "coefficients": pd.Series(dtype=object)})
        r = ranges.iloc[0]
        base, unit = np.tile(r["base"], past), np.tile(r["unit"], past)
        lags, total = part("lag"), part("total")[0]
        n, width, horizon = total[0], len(r["base"]), len(total) - 1
        xy = lags[::-1, width * width:-width].reshape(past * width, horizon)
        mean_x, mean_y = lags[::-1, -width:].ravel() / n, total[1:] / n
        xx = _window_products(lags, part("edge"), past, width)
        # From values in units of the lot's extent to those the model will meet: gain * value + offset.
        low, extent = np.asarray(r["low"]), np.asarray(r["high"]) - np.asarray(r["low"])
        factor = np.where(extent != 0, 1 / np.where(extent != 0, extent, 1), 0) if scaled else np.ones(len(low))
        gain, offset = factor * unit, (base - low) * factor if scaled else base
        weights, intercepts = least_squares(
            (xx - n * np.outer(mean_x, mean_x)) * np.outer(gain, gain),
            (xy - n * np.outer(mean_x, mean_y)) * gain[:, None], gain * mean_x + offset, mean_y)
        return pd.DataFrame({LOT: rows[LOT].iloc[0], "horizon": range(1, horizon + 1),
                             "intercept": intercepts, "coefficients": list(weights.T)})
    return solve


def fit_linear_hours(hours: DataFrame, ranges: DataFrame, past: int = PAST_HOURS, horizon: int = HORIZON_HOURS,
                     splits: tuple[str, ...] = ("train",), scaled: bool = True) -> DataFrame:
    """The model that ``fit_linear`` fits to the scaled windows of ``splits`` (``scaled=False``: to the plain ones).

    ``ranges`` are those of ``fit_ranges``; values are summed in units of them, so that sums stay exact enough. Lots
    without ranges or samples get no model. Every hour is summed in one task of its (lot, piece); a lot's sums are of
    fixed size and meet in the JVM.
    """
    scale = _with_scale(ranges, past)
    units = F.transform("x", lambda v, i: (v - F.get("base", i)) / F.get("unit", i))
    shifted = join_per_lot(hours, scale.select(LOT, "base", "unit"), TS).where(F.col("base").isNotNull()).withColumn("x", units)
    parts = _placed(shifted, splits, past, horizon).mapInArrow(
        _products(past, horizon), f"{LOT} int, kind string, r int, products array<double>")
    summed = (parts.select(LOT, "kind", "r", array_to_vector("products").alias("_v"))
              .groupBy(LOT, "kind", "r").agg(Summarizer.metrics("sum").summary(F.col("_v")).alias("_s"))
              .select(LOT, "kind", "r", vector_to_array("_s.sum").alias("products")))
    return summed.groupBy(LOT).cogroup(scale.groupBy(LOT)).applyInPandas(_solver(past, scaled), LINEAR_MODEL)
