"""Cut histories give the results of uncut windows, whatever the slot and the skew."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from lotwise.operators import explore, features, frames
from lotwise.operators.quantiles import exact_quantiles
from lotwise.schemas import LOT

HOUR = 3600


@pytest.fixture(scope="module")
def series(spark):
    """Three lots, one with most rows, with missing hours and missing values."""
    rng, rows = random.Random(11), []
    for lot, n in ((1, 400), (2, 60), (3, 1)):
        for i in range(n):
            if rng.random() < 0.8 or i == 0:
                value = None if rng.random() < 0.15 else float(rng.randint(0, 50))
                rows.append((lot, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), value))
    df = spark.createDataFrame(rows, "parking_lot_id int, hour_timestamp timestamp, v double")
    return df.repartition(3).cache()


def same(a, b):
    left, right = sorted(map(tuple, a.collect()), key=repr), sorted(map(tuple, b.select(a.columns).collect()), key=repr)
    assert left == right


@pytest.mark.parametrize("slot", [5 * HOUR, 48 * HOUR, 10000 * HOUR])
def test_over_time(series, slot):
    def build(w):
        micros = 10 * HOUR * 1_000_000
        return {"s": F.sum("v").over(w.rangeBetween(-micros + 1, 0)), "n": F.count("*").over(w.rangeBetween(0, micros))}
    whole = Window.partitionBy(LOT).orderBy(F.unix_micros("hour_timestamp"))
    cut = frames.over_time(series, "hour_timestamp", build, before=10 * HOUR, after=10 * HOUR, slot=slot)
    same(cut, series.withColumns(build(whole)))


@pytest.mark.parametrize("slot", [3, 50, 10000])
def test_over_rows(series, slot):
    def build(w):
        return {"s": F.sum("v").over(w.rowsBetween(-6, 0)), "l": F.lag("v", 7).over(w), "a": F.lead("v", 4).over(w)}
    whole = Window.partitionBy(LOT).orderBy("hour_timestamp")
    cut = frames.over_rows(series, "hour_timestamp", build, before=7, after=4, slot=slot)
    same(cut, series.withColumns(build(whole)))


@pytest.mark.parametrize("slot", [7 * HOUR, 100 * HOUR])
def test_numbered_and_carried(series, slot):
    whole = Window.partitionBy(LOT).orderBy("hour_timestamp")
    same(frames.numbered(series, "hour_timestamp", slot=slot), series.withColumn("_row", F.row_number().over(whole)))
    expected = series.withColumns({
        "_back_v": F.last("v", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, 0)),
        "_ahead_v": F.first("v", ignorenulls=True).over(whole.rowsBetween(0, Window.unboundedFollowing))})
    same(frames.carried(series, "hour_timestamp", ["v"], slot=slot), expected)


def test_fill_gaps_of_an_empty_lot(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), None)], "parking_lot_id int, hour_timestamp timestamp, v double")
    assert features.fill_gaps(df, ["v"]).first().v == 0.0


@pytest.mark.parametrize("values", [
    lambda rng: rng.normal(size=5000),                       # many distinct values
    lambda rng: rng.integers(0, 3, size=5000).astype(float),  # few values, heavy ties
    lambda rng: np.where(rng.random(5000) < 0.9, 7.0, rng.normal(size=5000)),
])
def test_exact_quantiles(spark, values):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": np.where(rng.random(5000) < 0.95, "hot", "cold"), "x": values(rng)})
    pdf.loc[len(pdf)] = ["single", 1.5]
    ps = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], "x", ps).toPandas().set_index("g")
    expected = pdf.groupby("g")["x"].quantile(list(ps.values())).unstack()
    for name, p in ps.items():
        assert np.allclose(got[name].sort_index(), expected[p].sort_index(), rtol=0, atol=1e-12)


def test_pearson_is_undefined_without_variation(spark):
    rows = [(float(k), 1.0, None, float(k), k % 7 * 1.0) for k in range(40)]
    df = spark.createDataFrame(rows, "avg_free_spaces double, temperature_2m double, precipitation double, same double, other double")
    got = {r.column_name: r for r in explore.pearson_test(df, ["temperature_2m", "precipitation", "same", "other"]).collect()}
    assert got["temperature_2m"][1:] == (None, None, None, 40, None) and got["precipitation"][1:] == (None, None, None, 0, None)
    assert got["same"].r == pytest.approx(1) and got["same"].p_value == pytest.approx(0, abs=1e-12) and got["same"].significant
    assert not got["other"].significant and 0 < got["other"].p_value < 1


def test_pearson_p_value(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    y = [2.1, 3.9, 6.2, 7.8, 10.1, 9.0]
    df = spark.createDataFrame(list(zip(y, x)), "avg_free_spaces double, temperature_2m double")
    row = explore.pearson_test(df, ["temperature_2m"]).first()
    r = np.corrcoef(x, y)[0, 1]
    t = r * np.sqrt(4 / (1 - r * r))
    # Two-sided p of Student's t with 4 degrees of freedom, in closed form.
    s = t / np.sqrt(4 + t * t)
    p = 1 - (1.5 * s - 0.5 * s ** 3)
    assert row.r == pytest.approx(r) and row.p_value == pytest.approx(p, rel=1e-6) and row.significant
