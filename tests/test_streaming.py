"""Streams drained to the end equal the batch rules; late and replayed rows."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lotwise.schemas import HOURLY, LOT
from lotwise.session import scratch_path
from lotwise.streaming import feeds


def land(path, name, rows):
    path.mkdir(exist_ok=True)
    with open(path / name, "w") as out:
        for at, sequence, lot, occupied in rows:
            payload = json.dumps([{"parking_lot_id": lot, "general_occupied": occupied, "general_total": 100}])
            out.write(json.dumps({"fetched_at": at, "sequence": sequence, "payload": payload}) + "\n")


def test_late_and_open_minutes(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def drained():
        stream = feeds.stream_minute_feed(spark, str(folder))
        feeds.drain(stream, feeds.batch_log(out, "minute_timestamp"), state)
        rows = feeds.minute_log(spark, out, stream.schema).collect()
        return sorted((r.minute_timestamp.hour, r.minute_timestamp.minute, r.free_spaces) for r in rows)

    land(folder, "a.json", [("2024-01-01T10:00:10", 1, 1, 10), ("2024-01-01T10:30:00", 2, 1, 20)])
    assert drained() == [(10, 0, 90), (10, 30, 80)]
    # Two hours late, out of order, and a second snapshot of an old minute: all count.
    land(folder, "b.json", [("2024-01-01T12:30:00", 7, 1, 50), ("2024-01-01T10:25:00", 3, 1, 30), ("2024-01-01T10:00:40", 4, 1, 99),
                            ("2024-01-01T10:30:50", 6, 1, 23), ("2024-01-01T10:30:40", 5, 1, 22)])
    assert drained() == [(10, 0, 1), (10, 25, 70), (10, 30, 77), (12, 30, 50)]


def test_hours_follow_late_minutes(spark, tmp_path):
    folder, minutes, hourly, state = tmp_path / "in", str(tmp_path / "minutes"), str(tmp_path / "hourly"), str(tmp_path / "state")

    def drained():
        feeds.drain(feeds.stream_minute_feed(spark, str(folder)), feeds.stream_hourly_rollup(minutes, hourly), state)
        rows = feeds.read_log(spark, hourly, HOURLY, [LOT, "hour_timestamp"]).collect()
        return sorted((r.hour_timestamp.hour, r.avg_free_spaces, r.min_free_spaces, r.max_free_spaces) for r in rows)

    land(folder, "a.json", [("2024-01-01T10:00:10", 1, 1, 10), ("2024-01-01T10:00:50", 2, 1, 40),
                            ("2024-01-01T10:59:59", 3, 1, 20), ("2024-01-01T11:05:00", 4, 1, 0)])
    assert drained() == [(10, 70.0, 60, 80), (11, 100.0, 100, 100)]
    land(folder, "b.json", [("2024-01-01T13:00:00", 5, 1, 1), ("2024-01-01T10:30:00", 6, 1, 90)])
    assert drained() == [(10, 50.0, 10, 80), (11, 100.0, 100, 100), (13, 99.0, 99, 99)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, h), float(h)) for h in range(3)],
                                 "parking_lot_id int, hour_timestamp timestamp, v double")
    write = feeds.batch_log(path, "hour_timestamp")
    write(rows, 0)
    write(rows.where("v > 0").withColumn("v", F.col("v") * 10), 1)
    write(rows, 0)
    got = feeds.read_log(spark, path, rows.schema, [LOT, "hour_timestamp"])
    assert sorted(r.v for r in got.collect()) == [0.0, 10.0, 20.0]


def hours(spark, values):
    return spark.createDataFrame(
        [(lot, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(v), v, v, 0) for lot, h, v in values], HOURLY)


def test_refresh_reaches_the_following_hours(spark, tmp_path):
    weather = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h), 50.0, 0.0) for h in range(80)],
        "hour_timestamp timestamp, temperature_2m double, relative_humidity_2m double, precipitation double")
    hourly, out = str(tmp_path / "hourly"), str(tmp_path / "features")
    refresh = feeds.stream_feature_refresh(weather, hourly, out)
    first = [(1, h, h) for h in range(70) if h not in (20, 21)]
    refresh(hours(spark, first), 0)
    refresh(hours(spark, [(1, 20, 500), (1, 30, 900)]), 1)       # one late hour, one correction
    final = hours(spark, [(lot, h, 900 if h == 30 else v) for lot, h, v in first] + [(1, 20, 500)])
    expected = feeds.training_features(final, weather)
    got = feeds.read_log(spark, out, expected.schema, [LOT, "hour_timestamp"]).select(expected.columns)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(got) == key(expected)


def test_hours_wait_for_their_weather(spark, tmp_path):
    def weather(hours_known):
        return spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h), 50.0, 0.0) for h in hours_known],
                                     "hour_timestamp timestamp, temperature_2m double, relative_humidity_2m double, precipitation double")
    hourly, out = str(tmp_path / "hourly"), str(tmp_path / "features")
    known = [weather(range(30))]
    refresh = feeds.stream_feature_refresh(lambda: known[0], hourly, out)
    arrived = feeds.stream_weather_refresh(lambda: known[0], hourly, out)
    values = [(lot, h, h + lot) for lot in (1, 2) for h in range(40)]
    refresh(hours(spark, values), 0)
    schema = feeds.training_features(hours(spark, values), weather(range(40))).schema
    read = lambda: feeds.read_log(spark, out, schema, [LOT, "hour_timestamp"]).select(schema.names)
    assert read().count() == 60
    known[0] = weather(range(40))
    arrived(weather(range(30, 40)), 0)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(read()) == key(feeds.training_features(hours(spark, values), weather(range(40))))
    refresh(hours(spark, [(1, 35, 77)]), 1)          # a later correction wins over the weather's refresh
    final = [(lot, h, 77 if (lot, h) == (1, 35) else v) for lot, h, v in values]
    assert key(read()) == key(feeds.training_features(hours(spark, final), weather(range(40))))


def test_silent_lot_still_has_its_last_hours(spark):
    path = scratch_path(spark, "features")
    rows = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h)) for h in range(40)]
        + [(2, dt.datetime(2024, 6, 1) + dt.timedelta(hours=h), float(h)) for h in range(100)]
        + [(1, dt.datetime(2024, 6, 4), -1.0)], "parking_lot_id int, hour_timestamp timestamp, v double")
    feeds.batch_log(path, "hour_timestamp")(rows, 0)
    lots = rows.select(LOT).distinct()
    got = feeds.recent_features(spark, path, rows.schema, lots, "2024-06-05", n=10, days=3)
    by_lot = {lot: sorted(r.v for r in got.where(F.col(LOT) == lot).collect()) for lot in (1, 2)}
    assert by_lot[1] == [-1.0] + [float(h) for h in range(31, 40)]
    assert by_lot[2] == [float(h) for h in range(90, 100)]
