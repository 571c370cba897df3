"""Batch logs: days listed, numbers, merges."""

import datetime as dt
import time

from pyspark.sql import functions as F

from lotwise.schemas import HOURLY, LOT
from lotwise.streaming import feeds, log

SCHEMA = "parking_lot_id int, hour_timestamp timestamp, v double"
KEYS = [LOT, "hour_timestamp"]


def rows(spark, *items):
    return spark.createDataFrame([(1, dt.datetime(2024, 1, day, hour), float(v)) for day, hour, v in items], SCHEMA)


def content(spark, path, days=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted((r.hour_timestamp.day, r.hour_timestamp.hour, r.v) for r in log.read_log(spark, path, schema, KEYS, days).collect())


def folders(path, day):
    return sorted(p.name for p in (path / f"date=2024-01-{day:02}").iterdir())


def test_reading_lists_only_the_days_asked_for(spark, tmp_path):
    path = str(tmp_path)
    log.batch_log(path, "hour_timestamp")(rows(spark, *[(day, 1, day) for day in range(1, 21)]), 0)
    schema = rows(spark).schema
    got = log.read_batches(spark, path, schema, ["2024-01-03", "2024-01-19", "2023-05-05"])
    assert sorted({f.split("date=")[1][:10] for f in got.inputFiles()}) == ["2024-01-03", "2024-01-19"]
    assert content(spark, path, ["2024-01-03", "2024-01-19"]) == [(3, 1, 3.0), (19, 1, 19.0)]
    assert log.read_batches(spark, path, schema, ["1999-01-01"]).count() == 0
    assert len(log.log_days(spark, path)) == 20


def test_days_of(spark):
    got = log.days_of(rows(spark, (1, 0, 0), (1, 5, 0), (10, 0, 0)), "hour_timestamp", 1, 1)
    assert got == ["2023-12-31", "2024-01-01", "2024-01-02", "2024-01-09", "2024-01-10", "2024-01-11"]
    assert log.days_of(rows(spark), "hour_timestamp") == []


def test_numbers_grow_without_a_clock(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "new")
    first = [log.next_number(spark, path) for _ in range(3)]
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    assert first + [log.next_number(spark, path)] == [0, 1, 2, 3]
    assert len([p for p in (tmp_path / "new" / "_numbers").iterdir() if not p.name.startswith(".")]) == 1


def test_merge_keeps_the_newest_rows(spark, tmp_path):
    path, write = str(tmp_path), log.batch_log(str(tmp_path), "hour_timestamp")
    schema = rows(spark).schema
    write(rows(spark, (1, 1, 1), (1, 2, 2), (2, 1, 3)), 0)
    write(rows(spark, (1, 2, 20), (1, 3, 30)), 1)
    write(rows(spark, (3, 1, 5)), 2)
    write(rows(spark, (3, 2, 6)), 3)
    expected = content(spark, path)
    merge = lambda: log.compact_log(spark, path, schema, KEYS, "2024-01-03")
    assert merge() == ["2024-01-01"]                    # one batch on the 2nd, the 3rd is open
    assert content(spark, path) == expected
    assert len(folders(tmp_path, 1)) == 3               # the merged files are still there for readers
    assert merge() == [] and content(spark, path) == expected
    assert len(folders(tmp_path, 1)) == 1 and len(folders(tmp_path, 3)) == 2

    write(rows(spark, (1, 2, 200)), 4)                  # a late batch wins over the merge
    assert (1, 2, 200.0) in content(spark, path)
    assert merge() == ["2024-01-01"] and (1, 2, 200.0) in content(spark, path)
    assert merge() == [] and (1, 2, 200.0) in content(spark, path) and len(content(spark, path)) == len(expected)


def test_replay_after_a_merge_loses_no_row(spark, tmp_path):
    path, write = str(tmp_path), log.batch_log(str(tmp_path), "hour_timestamp")
    schema = rows(spark).schema
    write(rows(spark, (1, 1, 1)), 0)
    write(rows(spark, (1, 2, 2)), 1)                    # died here: the hour 3 of batch 1 is missing
    assert log.compact_log(spark, path, schema, KEYS, "2024-02-01") == ["2024-01-01"]
    write(rows(spark, (1, 2, 2), (1, 3, 3)), 1)
    for _ in range(3):
        log.compact_log(spark, path, schema, KEYS, "2024-02-01")
        assert content(spark, path) == [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0)]
    assert len(folders(tmp_path, 1)) == 1


def test_features_refreshed_last_win_under_a_clock_set_back(spark, tmp_path, monkeypatch):
    weather = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h), 50.0, 0.0) for h in range(40)],
        "hour_timestamp timestamp, temperature_2m double, relative_humidity_2m double, precipitation double")
    hourly, out = str(tmp_path / "hourly"), str(tmp_path / "features")
    refresh = feeds.stream_feature_refresh(weather, hourly, out)

    def hours(*values):
        return spark.createDataFrame([(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(v), v, v, 0) for h, v in values], HOURLY)
    first = [(h, h) for h in range(30)]
    refresh(hours(*first), 0)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    refresh(hours((5, 500)), 1)
    refresh(hours((5, 500)), 1)                         # replayed
    expected = feeds.training_features(hours(*[(h, 500 if h == 5 else v) for h, v in first]), weather)
    got = feeds.read_log(spark, out, expected.schema, KEYS).select(expected.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_short_lots_are_looked_up_no_further_than_needed(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    history = spark.createDataFrame(
        [(lot, dt.datetime(2023, 1, 1) + dt.timedelta(days=d), float(d)) for lot in (1, 2) for d in range(200) if lot == 2 or d < 170], SCHEMA)
    log.batch_log(path, "hour_timestamp")(history, 0)
    read, plain = [], log.read_log

    def counted(spark, path, schema, keys, days=None, newest=None):
        read.append(list(days))
        return plain(spark, path, schema, keys, days, newest)
    monkeypatch.setattr(feeds, "read_log", counted)
    got = feeds.recent_features(spark, path, history.schema, history.select(LOT).distinct(), "2023-07-19", n=5, days=10)
    assert sorted((r.parking_lot_id, r.v) for r in got.collect()) == [(1, float(d)) for d in range(165, 170)] + [(2, float(d)) for d in range(195, 200)]
    # Twenty days before the first eleven end on the silent lot's last day; forty more hold its other rows, the rest is not read.
    assert [len(days) for days in read] == [11, 20, 40] and len({d for days in read for d in days}) == 71
