"""Whole pipelines on small landed inputs."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import models
from lotwise.plans import dashboard, forecast, online, store, training
from lotwise.plans.fixtures import Views
from lotwise.schemas import LOT

START = 1717200000  # 2024-06-01 00:00 UTC


def test_training_data_from_files(spark, tmp_path):
    ops, weather = tmp_path / "ops", tmp_path / "weather"
    ops.mkdir(), weather.mkdir()
    lines = ["lot;space;arrival;departure;xml"]
    lines += [f"1;{s};{START + 600 * s};{START + 600 * s + 7200};{s}" for s in range(5)]
    lines += [f"1;0;{START};{START + 99};77", f"2;1;{START};{START + 60};8", f"2;1;{START + 5};{START + 5};9"]
    (ops / "a.csv").write_text("\n".join(lines) + "\n")
    (weather / "w.json").write_text(json.dumps({"hourly": {
        "time": [f"2024-06-01T{h:02d}:00" for h in range(24)], "temperature_2m": [10.5] * 24, "precipitation": [0.0] * 24,
        "relative_humidity_2m": [50.0] * 24}}))
    lots = spark.createDataFrame([(1, 3), (2, 1)], "parking_lot_id int, total_spaces int")
    for _ in range(2):  # a rerun replaces the tables
        tables = training.prepare_training_data(
            training.load_operations(spark, str(ops)), training.load_weather(spark, str(weather)), lots, str(tmp_path / "out"))
    assert tables.minute.count() == 2 * 1441
    got = tables.training.where("parking_lot_id = 1").orderBy("hour_timestamp").collect()
    assert len(got) == 24 and {r.temperature_category for r in got} == {"Hot"}
    # The duplicate arrival of space 0 keeps the stay that was read first; space s occupies
    # minutes 10 s to 10 s + 119.
    busy = np.zeros(1440, int)
    for s in range(5):
        busy[10 * s:10 * s + 120] += 1
    for r in got[:3]:
        free = 3 - busy[60 * r.hour_of_day:60 * r.hour_of_day + 60]
        assert r.avg_free_spaces == pytest.approx(round(free.mean() + 1e-9, 2))
        assert (r.min_free_spaces, r.max_free_spaces) == (free.min(), free.max())


def test_first_row_of_the_first_file_wins(spark, tmp_path):
    ops, weather = tmp_path / "ops", tmp_path / "weather"
    ops.mkdir(), weather.mkdir()
    head = "lot;space;arrival;departure;xml\n"
    (ops / "b.csv").write_text(head + f"1;1;{START};{START + 60};1\n1;2;{START};{START + 50};2\n")
    (ops / "a.csv").write_text(head + f"1;1;{START};{START + 900};3\n1;1;{START};{START + 30};4\n1;3;{START};{START};5\n")
    got = {r.parking_space_id: r.xml_id for r in training.load_operations(spark, str(ops)).collect()}
    assert got == {1: 3, 2: 2}
    for name, degrees in (("b.json", [-3.0, 1.0]), ("a.json", [20.0])):
        (weather / name).write_text(json.dumps({"hourly": {
            "time": [f"2024-06-01T{h:02d}:00" for h in range(len(degrees))], "temperature_2m": degrees}}))
    got = {r.hour_timestamp.hour: r.temperature_2m for r in training.load_weather(spark, str(weather)).collect()}
    assert got == {0: 20.0, 1: 1.0}


def test_last_hour_transformation(spark, tmp_path):
    v = Views(spark, "/root/testdata/sf0.001")
    hourly, features = str(tmp_path / "hourly"), str(tmp_path / "features")
    for hour in range(6, 13):
        steps = online.transform_last_hour(v.minute, v.weather, hourly, features, f"2024-01-10 {hour:02d}:05:00")
        assert steps in ([], ["hourly"], ["hourly", "features"])
    got = spark.read.parquet(hourly)
    expected = v.hourly.where("hour_timestamp >= '2024-01-10 05:00' and hour_timestamp < '2024-01-10 12:00'")
    key = [LOT, "hour_timestamp", "avg_free_spaces"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, expected.select(key).collect()))
    assert spark.read.parquet(features).groupBy(LOT, "hour_timestamp").count().where("count > 1").isEmpty()
    again = online.transform_last_hour(v.minute, v.weather, hourly, features, "2024-01-10 12:05:00")
    assert again and spark.read.parquet(hourly).count() == expected.count()
    assert online.transform_last_hour(v.minute, v.weather, hourly, features, "2031-01-01 00:05:00") == []


def test_hybrid_forecast_and_dashboard(spark, tmp_path):
    v = Views(spark, "/root/testdata/sf0.001")
    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(4)
    rows = [(lot, base + dt.timedelta(hours=h), float(30 + 20 * np.sin(h * np.pi / 12) + rng.normal()))
            for lot in (1, 2) for h in range(240)]
    hourly = spark.createDataFrame(rows, "parking_lot_id int, hour_timestamp timestamp, avg_free_spaces double").withColumns({
        "min_free_spaces": F.lit(0), "max_free_spaces": F.lit(60), "free_spaces_range": F.lit(60)})
    from lotwise.streaming.feeds import training_features
    features = training_features(hourly, v.weather)
    hybrid = forecast.train_hybrid(features, models.fit_linear,
                                   lambda s: models.fit_random_forest(s, horizons=2, trees=3, depth=3))
    quality = hybrid.metrics.where("split = 'validation'").toPandas().set_index([LOT, "model_name"])["mse"]
    for lot in (1, 2):
        assert quality[lot, "hybrid"] <= min(quality[lot, "model_a"], quality[lot, "model_b"]) + 1e-6
    lots = spark.createDataFrame([(1, 60, "A"), (2, 25, "B")], "parking_lot_id int, total_spaces int, name string")
    out, wide, summary = forecast.forecast(features, hybrid, lots, "hybrid_linear_forest")
    assert out.count() == 48 and wide.count() == 2 and summary.count() == 2
    assert out.where(f"{LOT} = 2").agg(F.max("predicted_free_spaces")).first()[0] <= 25
    assert wide.first().confidence_score == 0.92
    # A saved forecaster, read back, gives the same forecast; forecasts are stored once and checked later.
    kept, rows_path, wide_path = (str(tmp_path / name) for name in ("model", "rows", "wide"))
    store.save_hybrid(spark, hybrid, kept)
    again = forecast.forecast(features, store.load_hybrid(spark, kept), lots, "hybrid_linear_forest")[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    store.store_forecast(out, wide, rows_path, wide_path)
    with pytest.raises(Exception, match="duplicate key"):
        store.store_forecast(out, wide, rows_path, wide_path)
    assert spark.read.parquet(rows_path).count() == 48 and spark.read.parquet(wide_path).count() == 2
    later = hourly.withColumn("hour_timestamp", F.expr("hour_timestamp + interval 12 hours"))
    for _ in range(2):
        store.store_actuals(spark, rows_path, str(tmp_path / "checked"), later, "2024-01-12 00:00:00")
    checked = spark.read.parquet(str(tmp_path / "checked"))
    assert checked.count() == 24 and checked.where("absolute_error is null").isEmpty()
    assert checked.schema["prediction_error"].dataType.simpleString() == "decimal(10,2)"
    minute = hourly.select(LOT, F.col("hour_timestamp").alias("minute_timestamp"), F.lit(5).cast("long").alias("free_spaces"),
                           F.lit(20).cast("long").alias("occupied_spaces"), F.lit(25).cast("long").alias("total_spaces"),
                           F.lit(80.0).alias("occupancy_rate"), F.lit(None).cast("string").alias("parking_lot_name"))
    documents = {r[LOT]: json.loads(r.document) for r in dashboard.lot_documents(minute, out, features, lots).collect()}
    assert len(documents[1]["forecast"]) == 24 and len(documents[1]["history"]) == 48
    assert documents[2]["status"]["lot_name"] == "Parking Lot 2" and documents[2]["status"]["availability_category"] == "Low"
    parts = dashboard.forecast_quality(out, hourly, "2024-01-11 12:00:00")
    assert parts["overall"].isEmpty() and parts["recent"].isEmpty()
