"""Ranges and linear models from hourly rows against those from windows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import lagged, models, supervised
from lotwise.schemas import LOT

NAMES = ["a", "b", "c"]
BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frame(spark):
    """Lot 1 has long and short runs of samples, lot 2 a constant input, lot 3 too few hours, lot 4 no real hour."""
    rng, rows = np.random.default_rng(5), []
    for lot, n in ((1, 260), (2, 120), (3, 3), (4, 40)):
        x = rng.normal(size=(n, 3)) * (1, 5, 0.1) + (0, 1000, -3)
        if lot == 2:
            x[:, 1] = 7.0
        y = x @ (1.0, 0.2, 3.0) + rng.normal(size=n)
        lost = {40, 41, 60, 69, 75, 150} if lot == 1 else set(range(n)) if lot == 4 else set()
        rows += [(lot, BASE + dt.timedelta(hours=i), *x[i].tolist(), float(y[i]), i not in lost) for i in range(n)]
    return spark.createDataFrame(rows, "parking_lot_id int, hour_timestamp timestamp, a double, b double, c double, "
                                       "y double, observed boolean").repartition(3).cache()


def both(frame, past, horizon):
    windows = supervised.supervised_windows(frame, past, horizon, NAMES, "y")
    return windows, lagged.sample_hours(frame, past, horizon, NAMES, "y").cache()


def table(df, key, *values):
    return {tuple(r[k] for k in key): [r[v] for v in values] for r in df.collect()}


@pytest.mark.parametrize("past", [1, 2, 8])
def test_samples_and_ranges_equal_those_of_windows(spark, frame, monkeypatch, past):
    monkeypatch.setattr(lagged, "_PIECE_ROWS", 37)
    windows, hours = both(frame, past, 3)
    marked = hours.where("split is not null").select(LOT, "hour_timestamp", "split")
    assert sorted(map(tuple, marked.collect())) == sorted(tuple(r) for r in windows.select(LOT, "origin", "split").collect())
    for splits in (("train",), ("train", "validation", "test")):
        expected = table(supervised.fit_minmax(windows.where(F.col("split").isin(*splits))), [LOT], "low", "high")
        assert table(lagged.fit_ranges(hours, past, splits), [LOT], "low", "high") == expected
        assert set(expected) == {(1,), (2,)}


@pytest.mark.parametrize("past", [1, 2, 8])
@pytest.mark.parametrize("scaled", [True, False])
def test_model_equals_that_of_windows(spark, frame, monkeypatch, past, scaled):
    monkeypatch.setattr(lagged, "_PIECE_ROWS", 37)
    windows, hours = both(frame, past, 3)
    ranges = lagged.fit_ranges(hours, past).cache()
    train = windows.where("split = 'train'")
    rows = supervised.minmax_per_timestep(train, ranges) if scaled else train
    key = [LOT, "horizon"]
    got = table(lagged.fit_linear_hours(hours, ranges, past, 3, scaled=scaled), key, "intercept", "coefficients")
    expected = table(models.fit_linear(rows), key, "intercept", "coefficients")
    assert got.keys() == expected.keys() and len(got) == 6
    for k, (intercept, weights) in expected.items():
        assert np.allclose(got[k][1], weights, rtol=1e-6, atol=1e-7) and got[k][0] == pytest.approx(intercept, rel=1e-5, abs=1e-5)


def test_more_inputs_than_samples(spark, frame):
    """Forty-eight inputs and fewer samples: many models fit, both forms take the one of smallest norm."""
    first = frame.where("parking_lot_id = 2 and hour_timestamp < timestamp '2024-01-03 00:00:00'")
    windows, hours = both(first, 16, 3)
    ranges = lagged.fit_ranges(hours, 16).cache()
    rows = supervised.minmax_per_timestep(windows.where("split = 'train'"), ranges)
    key = [LOT, "horizon"]
    got = table(lagged.fit_linear_hours(hours, ranges, 16, 3), key, "coefficients")
    for k, weights in table(models.fit_linear(rows), key, "coefficients").items():
        assert np.allclose(got[k], weights, atol=1e-6)


def test_no_samples(spark, frame):
    hours = lagged.sample_hours(frame.where("parking_lot_id = 3"), 8, 3, NAMES, "y")
    ranges = lagged.fit_ranges(hours, 8)
    assert ranges.collect() == [] and lagged.fit_linear_hours(hours, ranges, 8, 3).collect() == []
    empty = lagged.sample_hours(frame.where("false"), 8, 3, NAMES, "y")
    assert lagged.fit_ranges(empty, 8).collect() == []


def test_plans_hold_no_windows(spark, frame):
    hours = lagged.sample_hours(frame, 8, 3, NAMES, "y")
    ranges = lagged.fit_ranges(hours, 8)
    fitted = lagged.fit_linear_hours(hours, ranges, 8, 3)
    for df in (ranges, fitted):
        assert "collect_list" not in df._jdf.queryExecution().toString()
