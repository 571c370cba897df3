"""Models against numpy and brute force on small fixtures."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import blending, models, supervised, trees
from lotwise.schemas import LOT


def sample_rows(spark, lots=2, n=40, width=5, outputs=3, noise=0.1):
    rng, rows, truth = np.random.default_rng(1), [], {}
    for lot in range(1, lots + 1):
        w, b = rng.normal(size=(width, outputs)), rng.normal(size=outputs)
        x = rng.normal(size=(n, width))
        y = x @ w + b + noise * rng.normal(size=(n, outputs))
        truth[lot] = (x, y)
        for i in range(n):
            # Origins are years apart, so that a lot's samples fall into several fitting slots.
            rows.append((lot, dt.datetime(2000, 1, 1) + dt.timedelta(days=150 * i), x[i].tolist(), y[i].tolist()))
    df = spark.createDataFrame(rows, "parking_lot_id int, origin timestamp, window array<double>, targets array<double>")
    return df.repartition(5), truth


def test_linear_equals_least_squares(spark):
    samples, truth = sample_rows(spark)
    model = models.fit_linear(samples)
    for lot, (x, y) in truth.items():
        best = np.linalg.lstsq(np.hstack([x, np.ones((len(x), 1))]), y, rcond=None)[0]
        for r in model.where(F.col(LOT) == lot).collect():
            assert np.allclose(r.coefficients, best[:-1, r.horizon - 1], atol=1e-8)
            assert r.intercept == pytest.approx(best[-1, r.horizon - 1], abs=1e-8)


def test_linear_with_fewer_samples_than_inputs(spark):
    samples, truth = sample_rows(spark, lots=1, n=4, width=9, outputs=2)
    predicted = models.predict_long(models.fit_linear(samples), samples, horizons=2)
    got = {(r.origin, r.horizon): r.prediction for r in predicted.collect()}
    for r in samples.collect():
        for h in (1, 2):
            assert got[(r.origin, h)] == pytest.approx(r.targets[h - 1], abs=1e-6)


def test_missing_horizons_repeat_the_last(spark):
    samples, _ = sample_rows(spark, lots=1, n=20, outputs=2)
    rows = models.predict_long(models.fit_linear(samples), samples, horizons=4)
    wide = rows.groupBy("origin").pivot("horizon", [1, 2, 3, 4]).agg(F.first("prediction")).collect()
    assert all(r["2"] == r["3"] == r["4"] != r["1"] for r in wide)


@pytest.mark.parametrize("fit", [
    lambda s, lots: models.fit_random_forest(s, horizons=2, lots=lots, trees=5, depth=4),
    lambda s, lots: models.fit_gradient_boosting(s, horizons=2, lots=lots, rounds=5, depth=3, step=0.5)])
@pytest.mark.parametrize("lots", [None, [1, 2]])
def test_trees_learn(spark, fit, lots):
    samples, _ = sample_rows(spark, noise=0.0)
    predicted = models.predict_long(fit(samples, lots), samples, horizons=2)
    actual = samples.select(LOT, "origin", F.posexplode("targets").alias("_i", "actual")).withColumn("horizon", F.col("_i") + 1)
    quality = blending.regression_metrics(predicted.join(actual, [LOT, "origin", "horizon"]), ["horizon"]).collect()
    assert len(quality) == 2 and all(r.n_samples == 80 and r.r2 > 0.3 for r in quality)


@pytest.mark.parametrize("fit", [
    lambda s: models.fit_random_forest(s, horizons=1, trees=10, depth=8),
    lambda s: models.fit_gradient_boosting(s, horizons=1, rounds=20, depth=4, step=0.5)])
def test_trees_tell_many_lots_apart(spark, fit):
    """Two hundred lots that differ by nothing but their level, high and low in turn by number."""
    rows = [(lot, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), [0.5], [float(lot // 2 + 500 * (lot % 2) + 200 * (lot % 3))])
            for lot in range(200) for i in range(5)]
    samples = spark.createDataFrame(rows, "parking_lot_id int, origin timestamp, window array<double>, targets array<double>")
    actual = samples.select(LOT, "origin", F.lit(1).alias("horizon"), F.element_at("targets", 1).alias("actual"))
    judged = models.predict_long(fit(samples), samples, horizons=1).join(actual, [LOT, "origin", "horizon"])
    assert blending.regression_metrics(judged, ["horizon"]).first().r2 > 0.95


@pytest.mark.parametrize("lots", [None, [1, 2]])
@pytest.mark.parametrize("fit", [
    lambda s, lots: models.fit_random_forest(s, lots=lots, trees=3, depth=4, share=0.7),
    lambda s, lots: models.fit_gradient_boosting(s, lots=lots, rounds=2, depth=3, step=0.5)])
def test_histograms_split_like_tasks_that_hold_all_rows(spark, monkeypatch, fit, lots):
    samples, _ = sample_rows(spark, n=50)

    def predictions():
        return {tuple(r)[:3]: r.prediction for r in models.predict_long(fit(samples, lots), samples, horizons=3).collect()}
    plain = predictions()
    for rows in (0, 15):   # all nodes, or the upper ones, from histograms of three nodes at a time
        monkeypatch.setattr(trees, "LOCAL_ROWS", rows)
        monkeypatch.setattr(trees, "PASS_BYTES", 3 * 5 * trees.BINS * 5 * 8)
        other = predictions()
        assert plain.keys() == other.keys() and all(other[k] == pytest.approx(v, abs=1e-9) for k, v in plain.items())


def test_jobs_of_boosting_do_not_grow_with_horizons(spark):
    samples, _ = sample_rows(spark, outputs=24)
    spark.sparkContext.setJobGroup("boosting", "boosting")
    models.fit_gradient_boosting(samples, rounds=12, depth=3)
    spark.sparkContext.setJobGroup("other", "other")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting")) < 12 * 4 + 40


def test_forest_equals_plain_search(spark):
    """One tree without draws against a plain search over all cuts, with inputs of few values."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (120, 3)).astype(float)
    y = np.stack([x[:, 0] * (x[:, 1] > 2), x[:, 2] ** 2], 1) + rng.normal(size=(120, 2)) / 10
    rows = [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), x[i].tolist(), y[i].tolist()) for i in range(120)]
    samples = spark.createDataFrame(rows, "parking_lot_id int, origin timestamp, window array<double>, targets array<double>")
    model = models.fit_random_forest(samples, trees=1, depth=3, share=1.0, bootstrap=False)
    got = np.zeros((120, 2))
    for r in models.predict_long(model, samples, horizons=2).collect():
        got[int((r.origin - dt.datetime(2024, 1, 1)).total_seconds() // 3600), r.horizon - 1] = r.prediction

    def plain(here, depth):
        out = np.tile(y[here].mean(0), (len(here), 1))
        best = None
        for f in range(3):
            for cut in np.unique(x[here, f])[:-1]:
                low = x[here, f] <= cut
                loss = sum(((y[here][side] - y[here][side].mean(0)) ** 2).sum() for side in (low, ~low))
                if best is None or loss < best[0] - 1e-9:
                    best = (loss, low)
        if depth and best:
            for side in (best[1], ~best[1]):
                out[side] = plain(here[side], depth - 1)
        return out
    assert np.allclose(got, plain(np.arange(120), 3))


def test_trees_without_samples(spark):
    samples, _ = sample_rows(spark, n=5)
    for fit in (models.fit_random_forest, models.fit_gradient_boosting):
        assert models.predict_long(fit(samples.where("false")), samples).collect() == []


def test_minmax_and_constant_position(spark):
    df = spark.createDataFrame([(lot, dt.datetime(2024, 1, 1), w) for lot, w in (
        (1, [0.0, 5.0, 3.0]), (1, [10.0, 5.0, 1.0, 9.0]), (2, [7.0, 7.0, 7.0]))],
        "parking_lot_id int, origin timestamp, window array<double>")
    stats = supervised.fit_minmax(df.where("parking_lot_id = 1").withColumn("window", F.slice("window", 1, 3)))
    got = sorted(tuple(r.window) for r in supervised.minmax_per_timestep(df, stats).collect())
    assert got == [(0.0, 0.0, 1.0), (1.0, 0.0, 0.0, 9.0), (7.0, 7.0, 7.0)]


def test_alpha_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    a, b, y = rng.normal(size=(3, 200))
    key = [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 1 + i % 4) for i in range(200)]
    def frame(values, name):
        return spark.createDataFrame([(*k, float(v)) for k, v in zip(key, values)],
                                     f"parking_lot_id int, origin timestamp, horizon int, {name} double")
    got = {r.horizon: r.alpha for r in blending.fit_alpha(
        frame(a, "prediction"), frame(b, "prediction"), frame(y, "actual")).collect()}
    grid = np.arange(21) / 20
    for h in range(1, 5):
        pick = np.arange(200) % 4 == h - 1
        errors = [((g * a + (1 - g) * b - y)[pick] ** 2).sum() for g in grid]
        assert got[h] == pytest.approx(grid[int(np.argmin(errors))])
    tie = blending.fit_alpha(frame(a, "prediction"), frame(a, "prediction"), frame(y, "actual")).collect()
    assert {r.alpha for r in tie} == {0.0}


def test_a_lot_without_model_does_not_stop_the_others(spark):
    hour = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(hours=k)
    rows = [(lot, hour(k), [float(k % 5), float(k % 3)], [float(k % 5) + 1, 2.0 * (k % 3)]) for lot in (1, 2, 3) for k in range(30)]
    windows = spark.createDataFrame(rows, "parking_lot_id int, origin timestamp, window array<double>, targets array<double>")
    model = models.fit_linear(windows.where("parking_lot_id < 3"))
    pred = models.predict_long(model, windows, horizons=2)
    assert {(r.parking_lot_id, r["count"]) for r in pred.groupBy("parking_lot_id").count().collect()} == {(1, 60), (2, 60)}
    alpha = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5)], "parking_lot_id int, horizon int, alpha double")
    left = blending.unscored_lots(windows, first_model=model, weights=alpha)
    assert {tuple(r) for r in left.collect()} == {(3, "no first_model"), (2, "no weights")}


def test_samples_count_hours_across_a_gap(spark):
    """Ten hours are missing: no sample has one of them as a target, and windows stay 48 consecutive hours."""
    from lotwise.plans.fixtures import Views
    from lotwise.streaming.feeds import training_features
    base = dt.datetime(2024, 1, 1)
    hourly = spark.createDataFrame([(1, base + dt.timedelta(hours=h), float(h)) for h in range(200) if not 100 <= h < 110],
                                   "parking_lot_id int, hour_timestamp timestamp, avg_free_spaces double").withColumns({
        "min_free_spaces": F.lit(0), "max_free_spaces": F.lit(60), "free_spaces_range": F.lit(60)})
    frame = supervised.model_frame(training_features(hourly, Views(spark, "/root/testdata/sf0.001").weather)).cache()
    hours = {int((r.hour_timestamp - base).total_seconds() // 3600): r for r in frame.collect()}
    assert sorted(hours) == list(range(200))
    assert [h for h in hours if not hours[h].observed] == list(range(100, 110))
    assert hours[105].avg_free_spaces == 99 and hours[105].hour_of_day == 105 % 24
    samples = supervised.supervised_windows(frame, features=["avg_free_spaces"]).collect()
    origins = {int((r.origin - base).total_seconds() // 3600): r for r in samples}
    assert sorted(origins) == [o for o in range(47, 176) if not any(100 <= o + h < 110 for h in range(1, 25))]
    for o, r in origins.items():
        assert r.targets == [o + h for h in range(1, 25)]
        assert r.window == [99 if 100 <= h < 110 else h for h in range(o - 47, o + 1)]
