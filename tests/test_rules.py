"""Hand-made rows for rules that the shared tables do not reach."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lotwise.functions.values import mean_of_integers
from lotwise.operators import blending, categories, features, intervals, joins, monitoring, rollups, serving, supervised
from lotwise.schemas import LOT
from lotwise.sources import operations, snapshots, weather


def ts(text):
    return dt.datetime.fromisoformat(text)


def stays(spark, rows):
    data = [(1, i, ts(a), ts(d)) for i, (a, d) in enumerate(rows)]
    return spark.createDataFrame(data, "parking_lot_id int, parking_space_id int, arrival timestamp, departure timestamp")


def labels_of(spark, temperature, precipitation):
    row = spark.createDataFrame([(6, 5, temperature, precipitation)],
                                "hour_of_day int, day_of_week int, temperature_2m double, precipitation double")
    a = categories.categories_training(row).first()
    b = categories.categories_online(row).first()
    return (a.temperature_category, a.precipitation_category, b.temperature_category, b.precipitation_category)


@pytest.mark.parametrize("temperature, precipitation, expected", [
    (10.5, 0.0, ("Hot", "No Rain", "mild", "none")),
    (20.5, 2.5, ("Hot", "Light Rain", "warm", "moderate")),
    (10.0, 10.0, ("Cold", "Moderate Rain", "cold", "heavy")),
    (-0.1, 10.1, ("Freezing", "Heavy Rain", "freezing", "heavy")),
    (None, None, ("Hot", "Heavy Rain", "warm", "heavy")),
])
def test_category_limits(spark, temperature, precipitation, expected):
    assert labels_of(spark, temperature, precipitation) == expected


def test_unknown_labels_become_the_first_model_label(spark):
    row = spark.createDataFrame([(" weekend ", "dawn", "mild", "none")],
                                "day_type string, time_period string, temperature_category string, precipitation_category string")
    got = categories.categories_to_model(row).first()
    assert tuple(got) == ("Weekend", "morning", "cold", "no_rain")
    codes = supervised.ordinal_encode(categories.categories_to_model(row)).first()
    assert tuple(codes) == (1.0, 0.0, 0.0, 0.0)


def test_stays_at_tick_edges(spark):
    day = "2024-03-01 "
    ops = stays(spark, [
        (day + "10:00:00", day + "10:02:00"),      # covers 10:00 and 10:01, not 10:02
        (day + "10:00:01", day + "10:00:59"),      # no tick inside
        (day + "10:01:00", day + "10:01:01"),      # exactly one tick
        (day + "23:59:30", "2024-03-02 00:00:30"),  # over midnight: only 00:00
        (day + "10:01:00.000001", day + "10:02:00.000001"),  # one microsecond late: only 10:02
    ])
    got = {r.minute_timestamp: r.occupied_spaces for r in intervals.minute_occupancy(ops).collect()}
    assert len(got) == 2 * 1440 + 1
    busy = {k.strftime("%d %H:%M"): n for k, n in got.items() if n}
    assert busy == {"01 10:00": 1, "01 10:01": 2, "01 10:02": 1, "02 00:00": 1}
    assert min(got) == ts("2024-03-01 00:00:00") and max(got) == ts("2024-03-03 00:00:00")


def test_occupancy_sums_to_the_covered_ticks(spark):
    import random
    rng = random.Random(3)
    base = dt.datetime(2024, 5, 1, 22)
    rows = [(base + dt.timedelta(seconds=rng.randint(0, 200000)), rng.randint(1, 90000)) for _ in range(60)]
    ops = stays(spark, [(str(a), str(a + dt.timedelta(seconds=s))) for a, s in rows])
    expected = 0
    for a, s in rows:
        start, end = a.timestamp(), a.timestamp() + s
        expected += -(-end // 60) - -(-start // 60)
    occupied = intervals.minute_occupancy(ops)
    assert occupied.agg(F.sum("occupied_spaces")).first()[0] == expected
    assert occupied.where("occupied_spaces < 0").count() == 0


def test_rounding_is_half_away_from_zero(spark):
    rows = spark.createDataFrame([(1, 8), (-1, 8), (5, 2), (201, 200)], "s long, n long")
    got = [r[0] for r in rows.select(mean_of_integers(F.col("s"), F.col("n"))).collect()]
    assert got == [0.13, -0.13, 2.5, 1.01]


def test_zone_is_applied_at_ingest(spark):
    ops = spark.createDataFrame([(1, 1, 1704067200, 1704070800, 1)], "parking_lot_id int, parking_space_id int, "
                                "arrival_unix_seconds long, departure_unix_seconds long, xml_id int")
    assert operations.operations_epoch_to_timestamp(ops).first().arrival == ts("2024-01-01 00:00:00")
    assert operations.operations_epoch_to_timestamp(ops, "Europe/Berlin").first().arrival == ts("2024-01-01 01:00:00")


def test_csv_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lot;space;arrival;departure;xml;note\n1;2;10;20;5;x\n1;2;10;20\n3;4;30;40;6\n")
    got = sorted(tuple(r) for r in operations.operations_csv_scan(spark, str(tmp_path)).collect())
    assert got == [(1, 2, 10, 20, 5), (3, 4, 30, 40, 6)]
    one = operations.operations_csv_scan(spark, str(tmp_path)).select("xml_id")
    assert sorted(r[0] for r in one.collect()) == [5, 6]
    (tmp_path / "b.csv").write_text("lot;space;arrival;departure;xml\n1;2;ten;20;5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast|invalid"):
        operations.operations_csv_scan(spark, str(tmp_path)).collect()


def test_weather_document_with_short_arrays(spark):
    doc = {"latitude": 1.5, "longitude": 2.5, "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0], "precipitation": [0.0, 0.5]}}
    rows = weather.weather_json_explode(spark.createDataFrame([(json.dumps(doc),)], "payload string")).collect()
    got = sorted((r.hour_timestamp.hour, r.temperature_2m, r.precipitation, r.weather_code, r.latitude) for r in rows)
    assert got == [(0, 1.0, 0.0, None, 1.5), (1, None, 0.5, None, 1.5)]


def test_snapshot_absent_against_null(spark):
    payload = json.dumps([
        {"parking_lot_id": 1, "general_occupied": 5, "general_total": 0},
        {"parking_lot_id": 2, "general_occupied": None, "general_total": 10, "family_total": None, "invalid": True},
        {"parking_lot_id": 3, "general_occupied": 4, "general_total": 16, "family_total": 7, "invalid": None}])
    raw = spark.createDataFrame([(payload,)], "payload string")
    rows = {r.parking_lot_id: r for r in snapshots.occupancy_rate(snapshots.occupancy_snapshot_parse(raw)).collect()}
    assert [(rows[i].family_total, rows[i].invalid, rows[i].free_spaces, rows[i].occupancy_rate) for i in (1, 2, 3)] == [
        (0, False, None, None), (None, True, None, None), (7, None, 12, 25.0)]


def hourly(spark, rows):
    return spark.createDataFrame([(lot, ts(t), v) for lot, t, v in rows],
                                 "parking_lot_id int, hour_timestamp timestamp, avg_free_spaces double")


def test_time_frames_skip_missing_hours(spark):
    df = hourly(spark, [(1, "2024-01-01 00:00", 10.0), (1, "2024-01-01 01:00", 20.0), (1, "2024-01-01 03:00", 30.0),
                        (1, "2024-01-02 00:00", 40.0), (2, "2024-01-01 00:00", 5.0)])
    got = {(r[LOT], r.hour_timestamp): r for r in features.online_features(df).collect()}
    at = lambda lot, t: got[(lot, ts(t))]
    assert at(1, "2024-01-02 00:00").avg_free_spaces_rolling_24h == 30.0   # 00:00 of the day before is outside
    assert at(1, "2024-01-01 01:00").avg_free_spaces_diff_1h == 10.0
    assert at(1, "2024-01-01 03:00").avg_free_spaces_diff_1h is None
    assert at(2, "2024-01-01 00:00").avg_free_spaces_std_24h is None


def test_iso_week_and_sunday(spark):
    row = rollups.calendar_fields(hourly(spark, [(1, "2024-12-30 05:00", 1.0)])).first()
    assert (row.calendar_week, row.day_of_week, row.weekday_name, row.month_name) == (1, 1, "Monday", "December")
    assert rollups.calendar_fields(hourly(spark, [(1, "2024-12-29 05:00", 1.0)])).first().day_of_week == 0


def test_hour_without_weather(spark):
    h = rollups.calendar_fields(hourly(spark, [(1, "2024-01-01 00:00", 1.0), (1, "2024-01-01 01:00", 2.0)])).withColumns({
        c: F.lit(0) for c in ("min_free_spaces", "max_free_spaces", "free_spaces_range")})
    w = spark.createDataFrame([(ts("2024-01-01 01:00"), 1.0, 2.0, 3.0)], "hour_timestamp timestamp, "
                              "temperature_2m double, relative_humidity_2m double, precipitation double")
    assert joins.training_join(h, w).count() == 1
    assert len(joins.training_join(h, w).columns) == 16
    assert joins.weather_left_join(h, w).where("temperature_2m is null").count() == 1


def test_short_history_is_padded_on_the_left(spark):
    df = hourly(spark, [(1, f"2024-01-01 0{i}:00", float(i)) for i in range(3)])
    got = sorted((r.timestep, r.avg_free_spaces) for r in supervised.pad_window(df, 5).collect())
    assert got == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 1.0), (4, 2.0)]


def test_align_fills_and_cuts(spark):
    df = hourly(spark, [(1, "2024-01-01 00:00", 1.0)]).withColumns({"a": F.lit(1), "b": F.lit(2)})
    assert supervised.align_features(df, ["a", "x", "b"], 4).columns[2:] == ["a", "b", "missing_feature_0", "missing_feature_1"]
    assert supervised.align_features(df, ["a", "b"], 1).columns[2:] == ["a"]


def forecasts(spark, rows):
    return spark.createDataFrame([(1, ts("2024-01-01 00:00"), h, p) for h, p in rows],
                                 "parking_lot_id int, origin timestamp, horizon int, prediction double")


def test_blend_ends(spark):
    a, b = forecasts(spark, [(1, 10.0), (2, 20.0)]), forecasts(spark, [(1, 30.0), (2, 40.0)])
    alpha = blending.blend_weights(spark, {1: [1.0, 0.0]})
    got = {r.horizon: r.prediction for r in blending.blend_predictions(a, b, alpha).collect()}
    assert got == {1: 10.0, 2: 40.0}


def test_limits(spark):
    lots = spark.createDataFrame([(1, 50)], "parking_lot_id int, total_spaces int")
    pred = forecasts(spark, [(1, -3.2), (2, 2.5), (3, 3.5), (4, 77.7)])
    def rule(name):
        return [r.predicted_free_spaces for r in
                blending.constrain_predictions(pred, lots, name).orderBy("horizon").collect()]
    assert rule("baseline") == [0, 2, 4, 78]
    assert rule("hybrid") == [0, 2, 3, 50]
    assert rule("dashboard") == [0.0, 2.5, 3.5, 50.0]


def test_actual_of_zero_has_no_percentage(spark):
    pred = spark.createDataFrame([(1, ts("2024-01-01 01:00"), "m", 3), (1, ts("2024-01-01 02:00"), "m", 3),
                                  (1, ts("2024-01-01 05:00"), "m", 3)],
                                 "parking_lot_id int, target_hour timestamp, model_name string, predicted_free_spaces int")
    done = hourly(spark, [(1, "2024-01-01 01:00", 0.0), (1, "2024-01-01 02:00", 4.0), (1, "2024-01-01 05:00", 9.0)])
    got = {r.target_hour.hour: r for r in monitoring.backfill_actuals(pred, done, "2024-01-01 05:30:00").collect()}
    assert (got[1].prediction_error, got[1].percentage_error) == (3.0, None)
    assert (got[2].prediction_error, got[2].absolute_error, got[2].percentage_error) == (-1.0, 1.0, 25.0)
    assert got[5].actual_free_spaces is None and got[5].evaluated_at is None
    again = monitoring.backfill_actuals(monitoring.backfill_actuals(pred, done, "2024-01-01 05:30:00"), done, "2024-01-01 07:00:00")
    assert {r.target_hour.hour: r.evaluated_at.hour for r in again.collect()} == {1: 5, 2: 5, 5: 7}


def test_tied_models_stay(spark):
    made = ts("2024-01-01 00:00")
    pred = spark.createDataFrame([(1, made, "a"), (1, made, "b"), (1, ts("2023-12-31 00:00"), "c"), (2, made, "a")],
                                 "parking_lot_id int, prediction_made_at timestamp, model_name string")
    got = sorted((r[LOT], r.model_name) for r in serving.latest_prediction_batch(pred).collect())
    assert got == [(1, "a"), (1, "b"), (2, "a")]
