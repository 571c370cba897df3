"""Checks of joins, categories, window features and supervised data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.catalog.entry import Entry
from lotwise.catalog.oracle import (MODEL_CODES, MODEL_LABELS, ONLINE_LABELS, TRAINING_LABELS, WEATHER_NAMES, columns,
                                    filled)
from lotwise.operators import blending, categories, features, joins, lagged, rollups, supervised
from lotwise.plans.fixtures import Views
from lotwise.schemas import HYBRID_FEATURES, LAG_ROWS, LOT, MODEL_FEATURES, MODEL_VOCABULARY, MOVING_AVERAGE_ROWS, TREND_ROWS
from lotwise.session import stored

_HOUR = "parking_lot_id:i hour_timestamp:t"
_LABELS = "day_type:s time_period:s temperature_category:s precipitation_category:s"
_W = "over (partition by parking_lot_id order by hour_timestamp"


def _kinds(names, kind: str) -> str:
    return " ".join(f"{n}:{kind}" for n in names)


def _wide(v: Views) -> DataFrame:
    """Wide forecasts stamped with the day they were made, so that models tie."""
    return blending.prediction_wide(v.forecasts).withColumn("created_at", F.col("prediction_timestamp"))


def _lacking(v: Views) -> DataFrame:
    """Online features with one column emptied for each of three lots."""
    return v.features.withColumns({
        "avg_free_spaces_rolling_24h": F.when(F.col(LOT) != 1, F.col("avg_free_spaces_rolling_24h")),
        "avg_free_spaces_std_24h": F.when(F.col(LOT) != 2, F.col("avg_free_spaces_std_24h")),
        "avg_free_spaces_diff_1h": F.when(F.col(LOT) != 3, F.col("avg_free_spaces_diff_1h")),
        "temperature_diff_1h": F.when(F.col(LOT) != 3, F.col("temperature_diff_1h"))})


def _completed(v: Views) -> DataFrame:
    return rollups.hour_series_complete(v.hourly)


def _with_gaps(v: Views) -> DataFrame:
    return joins.weather_left_join(_completed(v), v.weather)


_COMPLETED = """
    select g.parking_lot_id, g.hour_timestamp, h.avg_free_spaces, h.min_free_spaces
    from (select parking_lot_id, unnest(generate_series(min(hour_timestamp), max(hour_timestamp), interval 1 hour))
                 hour_timestamp from hourly_base group by parking_lot_id) g
    left join hourly_base h using (parking_lot_id, hour_timestamp)"""

_STEPS = "(select *, row_number() over (partition by parking_lot_id order by hour_timestamp) r from model_frame)"
_PADDED = f"""
    select m.*, t.t timestep
    from (select *, count(*) over (partition by parking_lot_id) n,
                 max(hour_timestamp) over (partition by parking_lot_id) origin from {_STEPS}) m
    join range(0, 48) t(t) on m.r = greatest(m.n - 47 + t.t, 1)"""


def _samples(v: Views) -> DataFrame:
    return supervised.supervised_windows(v.frame)


def _sample_sums(v: Views) -> DataFrame:
    """Each sample as position-weighted sums over its whole window and targets."""
    def weighted(name: str):
        terms = F.transform(name, lambda x, i: x * (i + 1))
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return _samples(v).select(
        LOT, "origin", "split", F.size("window").alias("n_inputs"), F.size("targets").alias("n_targets"),
        weighted("window").alias("window_sum"), weighted("targets").alias("target_sum"),
        F.element_at("targets", 1).alias("first_target"), F.element_at("targets", -1).alias("last_target"))


#: Hours with 47 hours before them in the lot's span and a real value in each of the 24 hours after them.
_ORIGINS = """
    select m.parking_lot_id, m.hour_timestamp, date_diff('hour', s.a, m.hour_timestamp) - 47 since,
           date_diff('hour', s.a, s.b) + 1 n_hours
    from model_frame m
    join (select parking_lot_id, min(hour_timestamp) a, max(hour_timestamp) b from hourly_base group by 1) s using (parking_lot_id)
    where m.hour_timestamp >= s.a + interval 47 hour
      and 24 = (select count(*) from hourly_base h where h.parking_lot_id = m.parking_lot_id
                and h.hour_timestamp > m.hour_timestamp and h.hour_timestamp <= m.hour_timestamp + interval 24 hour)"""

_ROW_SUMS = (f"({' + '.join(f'{i} * {c}' for i, c in enumerate(MODEL_FEATURES, 1))}) a, "
             f"({' + '.join(MODEL_FEATURES)}) b")


def _flat(v: Views) -> DataFrame:
    windows = supervised.flatten_window(supervised.pad_window(v.frame))
    return windows.select(LOT, "origin", F.posexplode("window").alias("position", "value"))


def _scaled(v: Views) -> DataFrame:
    """Ranges fitted on all samples, applied to the newest window of each lot, long form."""
    frame = stored(v.frame, "frame")
    stats = stored(lagged.fit_ranges(lagged.sample_hours(frame), splits=("train", "validation", "test")), "ranges")
    newest = supervised.flatten_window(supervised.pad_window(frame))
    scaled = supervised.minmax_per_timestep(newest, stats).join(stats, LOT)
    return scaled.select(LOT, F.posexplode(F.arrays_zip("window", "low", "high")).alias("position", "z")).select(
        LOT, "position", F.col("z.window").alias("scaled"), F.col("z.low").alias("low"), F.col("z.high").alias("high"))


_CLASS = """case when probability >= 0.5 then 'Very High' when probability >= 0.3 then 'High' when probability >= 0.15 then 'Low'
            else 'Very Low' end"""
_COLOR = """case when probability >= 0.5 then '#2ecc71' when probability >= 0.3 then '#f1c40f' when probability >= 0.15 then '#e67e22'
            else '#e74c3c' end"""

ENTRIES = {
    "training_join": Entry(
        f"{_HOUR} avg_free_spaces:d min_free_spaces:i max_free_spaces:i free_spaces_range:i hour_of_day:i day_of_week:i "
        "weekday_name:s day_of_month:i calendar_week:i month_number:i month_name:s temperature_2m:d "
        "relative_humidity_2m:d precipitation:d",
        lambda v: joins.training_join(rollups.calendar_fields(v.hourly), v.weather), "select * from training"),
    "weather_left_join": Entry(
        f"{_HOUR} avg_free_spaces:d temperature_2m:d relative_humidity_2m:d precipitation:d",
        lambda v: _with_gaps(v),
        f"""select c.*, w.* exclude (hour_timestamp, weather_code) from ({_COMPLETED}) c
            left join weather_hourly w on date_trunc('hour', c.hour_timestamp) = date_trunc('hour', w.hour_timestamp)"""),
    "latest_predictions": Entry(
        f"parking_lot_id:i parking_lot_name:s prediction_timestamp:t model_name:s {_kinds([f'hour_{h}' for h in range(1, 25)], 'i')}",
        lambda v: joins.latest_predictions(_wide(v), v.lots),
        """select w.*, l.name parking_lot_name from wide w left join parking_lots l using (parking_lot_id)
           where prediction_timestamp = (select max(x.prediction_timestamp) from wide x
                                         where x.parking_lot_id = w.parking_lot_id)"""),
    "categories_training": Entry(
        f"{_HOUR} {_LABELS}",
        lambda v: categories.categories_training(joins.training_join(rollups.calendar_fields(v.hourly), v.weather)),
        f"select parking_lot_id, hour_timestamp, {TRAINING_LABELS} "
        "from hourly_calendar join weather_hourly using (hour_timestamp)"),
    "categories_online": Entry(
        f"{_HOUR} {_LABELS}",
        lambda v: categories.categories_online(joins.weather_left_join(rollups.calendar_fields(v.hourly), v.weather)),
        f"select parking_lot_id, hour_timestamp, {ONLINE_LABELS} "
        "from hourly_calendar left join weather_hourly using (hour_timestamp)"),
    "categories_to_model": Entry(
        f"{_HOUR} {_LABELS}", lambda v: categories.categories_to_model(v.online),
        f"select parking_lot_id, hour_timestamp, {columns(MODEL_LABELS)} from online"),
    "availability_category": Entry(
        "event_id:i probability:d availability_category:s availability_color:s",
        lambda v: categories.availability_category(
            v.snapshots.withColumn("probability", (100 - F.col("general_occupied")) / 100)),
        f"""select event_id, probability, {_CLASS} availability_category, {_COLOR} availability_color
            from (select event_id, (100 - general_occupied) / 100 probability from occupancy_snapshots)"""),
    "weather_code_description": Entry(
        "hour_timestamp:t weather_code:i weather_description:s",
        lambda v: categories.weather_code_description(v.weather),
        f"""select w.*, coalesce(d.label, 'Unknown') weather_description
            from weather_hourly w left join {WEATHER_NAMES} on d.code = w.weather_code"""),
    "weekday_labels": Entry(
        f"{_HOUR} weekday_type:s weekday_label:s weekday_order:i", lambda v: categories.weekday_labels(v.training),
        """select parking_lot_id, hour_timestamp, dayname(hour_timestamp) weekday_label, isodow(hour_timestamp) weekday_order,
                  case when isodow(hour_timestamp) >= 6 then 'Weekend' else 'Weekday' end weekday_type from training"""),
    "model_display_name": Entry(
        "parking_lot_id:i prediction_made_at:t hours_ahead:i model_name:s model_display:s",
        lambda v: categories.model_display_name(v.forecasts, {0: "Linear + Trees", 1: "Forest + Boosting"}),
        """select *, case when lower(model_name) not like '%hybrid%' then model_name
                          when parking_lot_id = 0 then 'Linear + Trees' when parking_lot_id = 1 then 'Forest + Boosting'
                          else 'Hybrid Model (Lot ' || parking_lot_id || ')' end model_display from forecasts"""),
    "rolling_avg_24h": Entry(f"{_HOUR} avg_free_spaces_rolling_24h:d", lambda v: features.rolling_avg_24h(v.hourly),
                             "select * from online"),
    "rolling_std_24h": Entry(f"{_HOUR} avg_free_spaces_std_24h:d", lambda v: features.rolling_std_24h(v.hourly),
                             "select * from online"),
    "diff_1h": Entry(f"{_HOUR} avg_free_spaces_diff_1h:d", lambda v: features.diff_1h(v.hourly), "select * from online"),
    "temperature_diff_1h": Entry(
        f"{_HOUR} temperature_diff_1h:d", lambda v: features.temperature_diff_1h(v.hourly, v.weather),
        "select * from online"),
    "moving_averages": Entry(
        f"{_HOUR} {_kinds([f'free_spaces_ma_{n}' for n in MOVING_AVERAGE_ROWS], 'd')}",
        lambda v: features.moving_averages(v.series),
        "select *, " + ", ".join(f"avg(free_spaces) {_W} rows between {n - 1} preceding and current row) free_spaces_ma_{n}"
                                 for n in MOVING_AVERAGE_ROWS) + " from series"),
    "lag_features": Entry(
        f"{_HOUR} {_kinds([f'{c}_lag_{n}' for c in ('free_spaces', 'occupancy_rate') for n in LAG_ROWS], 'd')}",
        lambda v: features.lag_features(v.series),
        "select *, " + ", ".join(f"lag({c}, {n}) {_W}) {c}_lag_{n}"
                                 for c in ("free_spaces", "occupancy_rate") for n in LAG_ROWS) + " from series"),
    "trend_features": Entry(
        f"{_HOUR} {_kinds([f'trend_{n}h' for n in TREND_ROWS], 'd')}", lambda v: features.trend_features(v.series),
        "select *, " + ", ".join(f"free_spaces - lag(free_spaces, {n}) {_W}) trend_{n}h" for n in TREND_ROWS) + " from series"),
    "cyclic_time": Entry(
        f"{_HOUR} hour_sin:d hour_cos:d day_sin:d day_cos:d", lambda v: features.cyclic_time(v.training),
        """select *, sin(2 * pi() * hour_of_day / 24) hour_sin, cos(2 * pi() * hour_of_day / 24) hour_cos,
                  sin(2 * pi() * day_of_week / 7) day_sin, cos(2 * pi() * day_of_week / 7) day_cos from training"""),
    "rolling_trend": Entry(
        f"{_HOUR} rolling_avg_7d:d rolling_avg_1d:d", lambda v: features.rolling_trend(_completed(v)),
        "select *, " + ", ".join(
            f"case when count(avg_free_spaces) {_W} rows between {n - 1} preceding and current row) >= {k} "
            f"then avg(avg_free_spaces) {_W} rows between {n - 1} preceding and current row) end {name}"
            for name, n, k in (("rolling_avg_7d", 168, 24), ("rolling_avg_1d", 24, 12))) + f" from ({_COMPLETED})"),
    "feature_fallbacks": Entry(
        f"{_HOUR} avg_free_spaces_rolling_24h:d avg_free_spaces_std_24h:d avg_free_spaces_diff_1h:d temperature_diff_1h:d month:i",
        lambda v: features.feature_fallbacks(_lacking(v)),
        f"""select parking_lot_id, hour_timestamp, month(hour_timestamp) as "month",
                   case when parking_lot_id <> 1 then avg_free_spaces_rolling_24h
                        else avg(avg_free_spaces) {_W} rows between 23 preceding and current row) end avg_free_spaces_rolling_24h,
                   coalesce(case when parking_lot_id <> 2 then avg_free_spaces_std_24h
                        else stddev_samp(avg_free_spaces) {_W} rows between 23 preceding and current row) end, 0)
                        avg_free_spaces_std_24h,
                   case when parking_lot_id <> 3 then avg_free_spaces_diff_1h
                        else coalesce(avg_free_spaces - lag(avg_free_spaces) {_W}), 0) end avg_free_spaces_diff_1h,
                   case when parking_lot_id <> 3 then temperature_diff_1h
                        else coalesce(temperature_2m - lag(temperature_2m) {_W}), 0) end temperature_diff_1h
            from online"""),
    "fill_gaps": Entry(
        f"{_HOUR} avg_free_spaces:d temperature_2m:d",
        lambda v: features.fill_gaps(_with_gaps(v), ["avg_free_spaces", "temperature_2m"]),
        f"""select parking_lot_id, hour_timestamp, {filled('avg_free_spaces')}, {filled('temperature_2m')}
            from (select c.*, w.temperature_2m from ({_COMPLETED}) c left join weather_hourly w using (hour_timestamp))"""),
    "hour_series_complete": Entry(
        f"{_HOUR} avg_free_spaces:d min_free_spaces:i", lambda v: _completed(v), _COMPLETED),
    "recent_window": Entry(
        f"{_HOUR} avg_free_spaces:d", lambda v: supervised.recent_window(v.hourly, 72),
        """select * from hourly_base h where 72 > (select count(*) from hourly_base n
           where n.parking_lot_id = h.parking_lot_id and n.hour_timestamp > h.hour_timestamp)"""),
    "pad_window": Entry(
        f"{_HOUR} timestep:i avg_free_spaces:d", lambda v: supervised.pad_window(v.hourly, 1000),
        """select h.*, t.t timestep from (
             select *, row_number() over (partition by parking_lot_id order by hour_timestamp) r,
                    count(*) over (partition by parking_lot_id) n from hourly_base) h
           join range(0, 1000) t(t) on h.r = greatest(t.t + 1 - (1000 - h.n), 1)"""),
    "ordinal_encode": Entry(
        f"{_HOUR} {_kinds(MODEL_VOCABULARY, 'i')}",
        lambda v: supervised.ordinal_encode(categories.categories_to_model(v.online)),
        f"select parking_lot_id, hour_timestamp, {columns(MODEL_CODES)} "
        f"from (select parking_lot_id, hour_timestamp, {columns(MODEL_LABELS)} from online)"),
    "minmax_per_timestep": Entry(
        "parking_lot_id:i position:i low:d high:d scaled:d", _scaled,
        f"""with long as (
              select parking_lot_id, hour_timestamp, r, n, u.i f, u.x x from (
                select parking_lot_id, hour_timestamp, r, max(r) over (partition by parking_lot_id) n,
                       [{', '.join(MODEL_FEATURES)}] xs from {_STEPS}) m,
                lateral (select unnest(range(0, 20)) i, unnest(xs) x) u),
            ranges as (
              select l.parking_lot_id, t.t * 20 + f position, min(x) low, max(x) high
              from ({_ORIGINS}) o join range(0, 48) t(t) on true
              join long l on l.parking_lot_id = o.parking_lot_id and l.hour_timestamp = o.hour_timestamp - to_hours(47 - t.t)
              group by all),
            newest as (
              select parking_lot_id, t.t * 20 + f position, x from long join range(0, 48) t(t)
              on r = greatest(n - 47 + t.t, 1))
            select parking_lot_id, position, low, high,
                   case when high = low then 0 else (x - low) / (high - low) end scaled
            from ranges join newest using (parking_lot_id, position)"""),
    "flatten_window": Entry(
        "parking_lot_id:i origin:t position:i value:d", _flat,
        f"""select parking_lot_id, origin, timestep * 20 + u.i position, u.x as value from (
              select parking_lot_id, origin, timestep, [{', '.join(MODEL_FEATURES)}] xs from ({_PADDED})) p,
            lateral (select unnest(range(0, 20)) i, unnest(xs) x) u"""),
    "align_features": Entry(
        f"{_HOUR} {_kinds(HYBRID_FEATURES, 'd')}",
        lambda v: supervised.align_features(features.hybrid_features(v.series)),
        "select *, case when day_of_week = 0 or day_of_week = 6 then 1 else 0 end is_weekend, " + ", ".join(
            [f"avg(free_spaces) {_W} rows between {n - 1} preceding and current row) free_spaces_ma_{n}" for n in MOVING_AVERAGE_ROWS]
            + [f"lag(free_spaces, {n}) {_W}) free_spaces_lag_{n}" for n in LAG_ROWS]
            + [f"free_spaces - lag(free_spaces, {n}) {_W}) trend_{n}h" for n in TREND_ROWS]
            + ["sin(2 * pi() * hour_of_day / 24) hour_sin", "cos(2 * pi() * hour_of_day / 24) hour_cos"]) + " from series"),
    "supervised_windows": Entry(
        "parking_lot_id:i origin:t split:s n_inputs:i n_targets:i window_sum:m target_sum:m first_target:d last_target:d",
        _sample_sums,
        f"""select parking_lot_id, origin, 960 n_inputs, 24 n_targets,
                   case when since < floor((n_hours - 71) * 0.7) then 'train'
                        when since < floor((n_hours - 71) * 0.85) then 'validation' else 'test' end split,
                   sum(case when k <= 0 then a + 20 * (k + 47) * b end) window_sum,
                   sum(case when k > 0 then avg_free_spaces * k end) target_sum,
                   max(case when k = 1 then avg_free_spaces end) first_target,
                   max(case when k = 24 then avg_free_spaces end) last_target
            from (select o.parking_lot_id, o.hour_timestamp origin, o.since, o.n_hours,
                         date_diff('hour', o.hour_timestamp, h.hour_timestamp) k, h.avg_free_spaces, {_ROW_SUMS}
                  from ({_ORIGINS}) o join model_frame h on h.parking_lot_id = o.parking_lot_id
                       and h.hour_timestamp between o.hour_timestamp - interval 47 hour and o.hour_timestamp + interval 24 hour)
            group by parking_lot_id, origin, since, n_hours"""),
}
