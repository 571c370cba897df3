"""Checks of models, blending, monitoring, serving queries and exploratory statistics."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from lotwise.catalog.entry import Entry
from lotwise.catalog.oracle import NOW, WEATHER_NAMES
from lotwise.operators import blending, explore, lagged, models, monitoring, serving, supervised
from lotwise.plans.fixtures import AS_OF, Views
from lotwise.schemas import HORIZON_HOURS, LOT, TEMPERATURE_LABELS
from lotwise.session import stored

_FORECAST = "parking_lot_id:i prediction_made_at:t target_hour:t hours_ahead:i"
_COLOR = "case availability_category when 'Very High' then '#2ecc71' when 'High' then '#f1c40f' " \
         "when 'Low' then '#e67e22' else '#e74c3c' end"
_COLUMNS = ["avg_free_spaces", "temperature_2m", "relative_humidity_2m", "precipitation"]
_WEATHER = _COLUMNS[1:]


def _share(rows: DataFrame, split: str) -> DataFrame:
    return rows.where(F.col("split") == split)


def scaled_samples(v: Views, training: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    _, ranges, frame = training or training_hours(v)
    return stored(supervised.minmax_per_timestep(supervised.supervised_windows(frame), ranges), "scaled")


def training_hours(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hours with their samples marked, the ranges of the training share, and the frame both come from."""
    frame = stored(v.frame, "frame")
    hours = stored(lagged.sample_hours(frame), "hours")
    return hours, stored(lagged.fit_ranges(hours), "ranges"), frame


def _linear_windows(v: Views) -> DataFrame:
    hours, ranges, _ = training_hours(v)
    fitted = lagged.fit_linear_hours(hours, ranges)
    return fitted.select(LOT, "horizon", "intercept", F.posexplode("coefficients").alias("position", "coefficient"))


def _linear_moments(v: Views) -> DataFrame:
    """Residuals of the training share against every scaled input: a least-squares fit leaves no moment with any."""
    hours, ranges, frame = training_hours(v)
    rows = stored(_share(supervised.minmax_per_timestep(supervised.supervised_windows(frame), ranges), "train"), "scaled")
    model = lagged.fit_linear_hours(hours, ranges)
    judged = _judged(models.predict_long(model, rows), rows).select(
        LOT, "origin", "horizon", (F.col("actual") - F.col("prediction")).alias("_e"))
    moments = rows.select(LOT, "origin", "window").join(judged, [LOT, "origin"]).select(
        LOT, "horizon", "_e", array_to_vector(F.transform("window", lambda z: z * F.col("_e"))).alias("_m"))
    sums = moments.groupBy(LOT, "horizon").agg(F.count("*").alias("n_samples"), F.avg("_e").alias("mean_residual"),
                                               Summarizer.metrics("mean").summary(F.col("_m")).alias("_s"))
    largest = F.array_max(F.transform(vector_to_array("_s.mean"), F.abs))
    return sums.select(LOT, "horizon", "n_samples", "mean_residual", F.size(vector_to_array("_s.mean")).alias("n_inputs"),
                       largest.alias("largest_moment"))


def _simple_samples(v: Views) -> DataFrame:
    """Samples with one input, the current hour's value, whose regression SQL can check."""
    return stored(supervised.supervised_windows(v.frame, past=1, features=["avg_free_spaces"]), "samples")


def _linear(v: Views) -> DataFrame:
    fitted = models.fit_linear(_share(_simple_samples(v), "train"))
    return fitted.withColumn("slope", F.element_at("coefficients", 1))


def _judged(predictions: DataFrame, rows: DataFrame) -> DataFrame:
    """Predictions next to the targets of their samples."""
    targets = rows.select(LOT, "origin", "split", F.posexplode("targets").alias("_i", "actual")).withColumn(
        "horizon", F.col("_i") + 1)
    return predictions.join(targets.drop("_i"), [LOT, "origin", "horizon"])


def _tree_quality(v: Views, fit) -> DataFrame:
    rows = scaled_samples(v)
    model = fit(_share(rows, "train"))
    rest = rows.where("split <> 'train'")
    return blending.regression_metrics(_judged(models.predict_long(model, rest), rest), [LOT, "split", "horizon"])


def _stumps(v: Views, fit) -> DataFrame:
    """Trees of one split per lot on one input, which SQL can search in full."""
    rows = _simple_samples(v)
    lots = [r[0] for r in rows.select(LOT).distinct().collect()]
    return models.predict_long(fit(_share(rows, "train"), lots), rows.where("split <> 'train'"))


def _stump_sql(step: float) -> str:
    """The cut that saves most squares over all horizons, and ``step`` of the way from the lot's means to the side's."""
    return _LINES + f""",
        sample as materialized (select parking_lot_id, hour_timestamp, x, since >= floor(m * 0.7) later from steps where known = 24),
        ranked as (select x, row_number() over (order by x) r, count(*) over () n from sample where not later),
        cuts as (select distinct x cut from ranked where x < (select max(x) from ranked) and (
            (select count(distinct x) from ranked) <= 32 or r in (select (k * n + 31) // 32 from range(1, 32) t(k)))),
        goals as materialized (select s.*, h.h horizon, b.avg_free_spaces y from sample s join range(1, 25) h(h) on true
            join model_frame b on b.parking_lot_id = s.parking_lot_id and b.hour_timestamp = s.hour_timestamp + to_hours(h.h)),
        means as materialized (select parking_lot_id, horizon, avg(y) mean from goals where not later group by all),
        sides as (select g.parking_lot_id, horizon, cut, g.x <= cut low, sum(y - mean) s, count(*) n
            from goals g join means using (parking_lot_id, horizon), cuts where not later group by all),
        best as (select parking_lot_id, cut from (select parking_lot_id, cut, sum(s * s / n) score, count(distinct low) n from sides group by all)
            where n = 2 qualify row_number() over (partition by parking_lot_id order by score desc, cut) = 1)
        select o.parking_lot_id, o.hour_timestamp origin, horizon, mean + {step} * s.s / s.n prediction
        from sample o join best using (parking_lot_id) join sides s on s.parking_lot_id = o.parking_lot_id and s.cut = best.cut
             and s.low = (o.x <= best.cut) join means using (parking_lot_id, horizon) where later"""


def _predict(v: Views) -> DataFrame:
    rows = _simple_samples(v)
    return models.predict_long(models.fit_linear(_share(rows, "train")), rows.where("split <> 'train'"))


_LINES = """
    with steps as materialized (
           select m.parking_lot_id, hour_timestamp, avg_free_spaces x, date_diff('hour', s.a, hour_timestamp) since,
                  date_diff('hour', s.a, s.b) - 23 m,
                  (select count(*) from hourly_base h where h.parking_lot_id = m.parking_lot_id
                   and h.hour_timestamp > m.hour_timestamp and h.hour_timestamp <= m.hour_timestamp + interval 24 hour) known
           from model_frame m
           join (select parking_lot_id, min(hour_timestamp) a, max(hour_timestamp) b from hourly_base group by 1) s
                on s.parking_lot_id = m.parking_lot_id),
         lines as materialized (
           select a.parking_lot_id, h.h horizon, regr_slope(b.x, a.x) slope, regr_intercept(b.x, a.x) intercept
           from steps a join range(1, 25) h(h) on true
           join steps b on b.parking_lot_id = a.parking_lot_id and b.hour_timestamp = a.hour_timestamp + to_hours(h.h)
           where a.known = 24 and a.since < floor(a.m * 0.7) group by all)"""


def _constrained(v: Views) -> DataFrame:
    blend = blending.blend_predictions(v.one("model_a"), v.one("model_b"), v.alpha)
    out = blend.select(LOT, "origin", "horizon", "prediction")
    for rule, lots in (("baseline", v.lots_open), ("hybrid", v.lots_open), ("dashboard", v.lot_limits)):
        out = blending.constrain_predictions(out, lots, rule).withColumnRenamed("predicted_free_spaces", rule)
    return out


def _metrics(v: Views) -> DataFrame:
    rows = None
    for name in ("model_a", "model_b"):
        part = v.one(name).join(v.actual, [LOT, "origin", "horizon"]).withColumn("model_name", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return blending.regression_metrics(rows, [LOT, "model_name"])


def _rows(v: Views) -> DataFrame:
    limited = blending.constrain_predictions(v.one("model_b"), v.lots, "baseline")
    return blending.prediction_rows(limited, F.col("origin"), "seasonal")


def _wide(v: Views) -> DataFrame:
    return blending.prediction_wide(v.forecasts).withColumn(
        "predicted_free_spaces", F.array_join(F.col("predicted_free_spaces").cast("array<string>"), ","))


def _outlook(v: Views) -> DataFrame:
    return serving.availability_outlook(v.forecasts, v.lot_limits)


def _bundle(v: Views) -> DataFrame:
    return serving.dashboard_bundle(serving.current_status(v.minute, v.lot_limits), _outlook(v),
                                    serving.historical_window(v.online))


def _unscored(v: Views) -> DataFrame:
    """Lot 0 has no ranges, lot 1 no first model, lot 2 no weights."""
    known = v.lots.select("parking_lot_id")
    return blending.unscored_lots(v.lots, ranges=known.where("parking_lot_id <> 0"), first_model=known.where("parking_lot_id <> 1"),
                                  weights=v.alpha.where("parking_lot_id <> 2"))


def _metric_sql(model: str) -> str:
    return f"""
        select parking_lot_id, '{model}' model_name, count(*) n_samples, avg(({model} - actual) ** 2) mse,
               sqrt(avg(({model} - actual) ** 2)) rmse, avg(abs({model} - actual)) mae,
               1 - sum(({model} - actual) ** 2) / nullif(sum(actual ** 2) - count(*) * avg(actual) ** 2, 0) r2,
               avg(case when actual <> 0 then abs({model} - actual) / abs(actual) * 100 end) mape
        from with_actual group by parking_lot_id"""


_STATUS_SQL = """
    select m.parking_lot_id, coalesce(m.parking_lot_name, 'Parking Lot ' || m.parking_lot_id) lot_name,
           m.minute_timestamp status_time, coalesce(m.free_spaces, 0) free_spaces,
           coalesce(m.occupied_spaces, 0) occupied_spaces,
           coalesce(l.total_spaces, nullif(m.total_spaces, 0), 100) total_spaces,
           coalesce(m.occupancy_rate, 0) occupancy_rate,
           coalesce(m.free_spaces, 0) / coalesce(l.total_spaces, nullif(m.total_spaces, 0), 100) p,
           round(coalesce(m.free_spaces, 0) / coalesce(l.total_spaces, nullif(m.total_spaces, 0), 100) * 100, 1)
               availability_probability,
           case when p >= 0.5 then 'Very High' when p >= 0.3 then 'High' when p >= 0.15 then 'Low'
                else 'Very Low' end availability_category
    from minute_rows m left join lot_limits l using (parking_lot_id)
    where m.minute_timestamp = (select max(x.minute_timestamp) from minute_rows x
                                where x.parking_lot_id = m.parking_lot_id)"""

_ISO = "'%Y-%m-%dT%H:%M:%S'"
_BUNDLE_SQL = f"""
    select parking_lot_id, cast(to_json({{'status': s.status, 'forecast': f.forecast, 'history': h.history}}) as varchar) document
    from (select parking_lot_id, {{'lot_name': lot_name, 'status_time': strftime(status_time, {_ISO}),
                 'free_spaces': free_spaces, 'occupied_spaces': occupied_spaces, 'total_spaces': total_spaces,
                 'availability_category': availability_category}} status from ({_STATUS_SQL})) s
    full join (select parking_lot_id, list({{'model': model, 'target_hour': strftime(target_hour, {_ISO}),
                 'hours_ahead': hours_ahead, 'free_spots': free_spots, 'occupied_spots': occupied_spots,
                 'availability_category': availability_category}} order by model, hours_ahead) forecast
               from outlook_classes group by parking_lot_id) f using (parking_lot_id)
    full join (select parking_lot_id, list({{'hour': strftime(hour_timestamp, {_ISO}),
                 'free_spots': round(free_spots::double, 2)}} order by hour_timestamp) history
               from history group by parking_lot_id) h using (parking_lot_id)"""

_BOX_GROUPS = " union all ".join(
    f"select '{name}' dimension, {expr} category, avg_free_spaces v from training" for name, expr in (
        ("month", "month_name"), ("temperature", "temperature_category"), ("precipitation", "precipitation_category"),
        ("weekday", "dayname(hour_timestamp)"),
        ("hour_by_weekday_type", "lpad(hour_of_day::varchar, 2, '0') || ' ' || day_type")))


def _group_sql(*keys: str) -> str:
    return f"""select {', '.join(keys)}, avg(avg_free_spaces) mean_free_spaces, stddev_samp(avg_free_spaces) std_free_spaces,
                      avg(temperature_2m) mean_temperature, avg(precipitation) mean_precipitation, count(*) n_rows
               from training group by all"""


def _area_sql(low: str) -> str:
    """Simpson's sum of cos^(freedom - 1) from ``low`` to ``top``; Student's distribution over the angle atan(t / sqrt(freedom))."""
    return f"""(select sum(case when k in (0, 2000) then 1 when k % 2 = 1 then 4 else 2 end
                * greatest(cos({low} + k * (top - {low}) / 2000), 0) ** (freedom - 1)) * (top - {low}) / 6000 from range(0, 2001) s(k))"""


_PEARSON_SQL = f"""
    select column_name, r, t_value, n_values, p_value, p_value < 0.05 significant
    from (select *, case when angle >= top then 0 else {_area_sql('angle')} / {_area_sql('0')} end p_value
          from (select *, atan(abs(t_value) / sqrt(freedom)) angle, least(pi() / 2, 12 / sqrt(freedom)) top
                from (select column_name, r, r * sqrt((n - 2) / (1 - r * r)) t_value, n n_values, n - 2 freedom from ("""  + " union all ".join(
    f"""select '{c}' column_name, corr({c}, avg_free_spaces) r, count(*) n from training
        where {c} is not null and avg_free_spaces is not null""" for c in explore.WEATHER) + "))))"

_MEANS = "mean_free_spaces:d std_free_spaces:d mean_temperature:d mean_precipitation:d"

ENTRIES = {
    "fit_linear": Entry("parking_lot_id:i horizon:i intercept:d slope:d", _linear, _LINES + " select * from lines"),
    "fit_linear_windows": Entry("parking_lot_id:i horizon:i intercept:d position:i coefficient:d", _linear_windows),
    "linear_window_residuals": Entry(
        "parking_lot_id:i horizon:i n_samples:i n_inputs:i mean_residual:m largest_moment:m", _linear_moments,
        _LINES + """ select a.parking_lot_id, h.h horizon, count(*) n_samples, 960 n_inputs, 0.0 mean_residual, 0.0 largest_moment
                     from steps a join range(1, 25) h(h) on true
                     where a.known = 24 and a.since >= 47 and a.since - 47 < floor((a.m - 47) * 0.7) group by all"""),
    "fit_random_forest": Entry(
        "parking_lot_id:i split:s horizon:i n_samples:i rmse:d mae:d r2:d mape:d",
        lambda v: _tree_quality(v, models.fit_random_forest)),
    "fit_gradient_boosting": Entry(
        "parking_lot_id:i split:s horizon:i n_samples:i rmse:d mae:d r2:d mape:d",
        lambda v: _tree_quality(v, models.fit_gradient_boosting)),
    "forest_stumps": Entry(
        "parking_lot_id:i origin:t horizon:i prediction:d", lambda v: _stumps(v, lambda s, lots: models.fit_random_forest(
            s, lots=lots, trees=1, depth=1, share=1.0, bootstrap=False)), _stump_sql(1.0)),
    "boosting_stumps": Entry(
        "parking_lot_id:i origin:t horizon:i prediction:d", lambda v: _stumps(v, lambda s, lots: models.fit_gradient_boosting(
            s, lots=lots, rounds=1, depth=1, step=0.25)), _stump_sql(0.25)),
    "predict_long": Entry(
        "parking_lot_id:i origin:t horizon:i prediction:d", _predict,
        _LINES + """ select parking_lot_id, hour_timestamp origin, horizon, intercept + slope * x prediction
                     from steps join lines using (parking_lot_id) where known = 24 and since >= floor(m * 0.7)"""),
    "blend_predictions": Entry(
        "parking_lot_id:i origin:t horizon:i prediction:d",
        lambda v: blending.blend_predictions(v.one("model_a"), v.one("model_b"), v.alpha), "select * from blended"),
    "fit_alpha": Entry(
        "parking_lot_id:i horizon:i alpha:d sse:m n_samples:i",
        lambda v: blending.fit_alpha(v.one("model_a"), v.one("model_b"), v.actual),
        """select parking_lot_id, horizon, step / 20.0 as alpha, sse, n_samples from (
             select parking_lot_id, horizon, step, count(*) n_samples,
                    round(sum((step / 20.0 * model_a + (1 - step / 20.0) * model_b - actual) ** 2), 6) sse
             from with_actual, range(0, 21) g(step) group by all)
           qualify row_number() over (partition by parking_lot_id, horizon order by sse, step) = 1"""),
    "constrain_predictions": Entry(
        "parking_lot_id:i origin:t horizon:i baseline:i hybrid:i dashboard:d", _constrained,
        """select parking_lot_id, origin, horizon, greatest(0, round_even(prediction, 0)) baseline,
                  trunc(least(greatest(prediction, 0), o.total_spaces)) hybrid,
                  greatest(0, least(prediction, coalesce(l.total_spaces, 100))) dashboard
           from blended join lots_open o using (parking_lot_id) join lot_limits l using (parking_lot_id)"""),
    "prediction_rows": Entry(
        f"{_FORECAST} model_name:s predicted_free_spaces:i", _rows,
        "select * from forecasts where model_name = 'seasonal'"),
    "prediction_wide": Entry(
        "parking_lot_id:i prediction_timestamp:t model_name:s predicted_free_spaces:s confidence_score:d "
        + " ".join(f"hour_{h}:i" for h in range(1, HORIZON_HOURS + 1)), _wide,
        "select * replace (array_to_string(predicted_free_spaces, ',') as predicted_free_spaces) from wide"),
    "prediction_summary": Entry(
        "parking_lot_id:i prediction_made_at:t model_name:s min_predicted:i max_predicted:i mean_predicted:d "
        "mean_alpha:d last_known_hour:t last_known_value:d",
        lambda v: blending.prediction_summary(v.forecasts, v.alpha, v.hourly),
        """select f.*, (select avg(a.alpha) from alpha a where a.parking_lot_id = f.parking_lot_id) mean_alpha,
                  prediction_made_at last_known_hour, h.avg_free_spaces last_known_value
           from (select parking_lot_id, prediction_made_at, model_name, min(predicted_free_spaces) min_predicted,
                        max(predicted_free_spaces) max_predicted, avg(predicted_free_spaces) mean_predicted
                 from forecasts group by all) f
           left join hourly_base h on h.parking_lot_id = f.parking_lot_id and h.hour_timestamp = f.prediction_made_at"""),
    "regression_metrics": Entry(
        "parking_lot_id:i model_name:s n_samples:i mse:d rmse:d mae:d r2:d mape:d", _metrics,
        _metric_sql("model_a") + " union all " + _metric_sql("model_b")),
    "backfill_actuals": Entry(
        f"{_FORECAST} model_name:s predicted_free_spaces:i actual_free_spaces:i prediction_error:d absolute_error:d "
        "percentage_error:d evaluated_at:t",
        lambda v: monitoring.backfill_actuals(v.forecasts, v.hourly, AS_OF),
        f"select * replace (case when actual_free_spaces is not null then {NOW} end as evaluated_at) from evaluated"),
    "model_performance": Entry(
        "parking_lot_id:i model_name:s total_predictions:i mae:d rmse:d mape:d first_prediction:t last_prediction:t",
        lambda v: monitoring.model_performance(v.evaluated),
        """select parking_lot_id, model_name, count(*) total_predictions, avg(absolute_error) mae,
                  sqrt(avg(prediction_error ** 2)) rmse, avg(percentage_error) mape, min(target_hour) first_prediction,
                  max(target_hour) last_prediction
           from evaluated where actual_free_spaces is not null group by 1, 2"""),
    "performance_by_horizon": Entry(
        "parking_lot_id:i model_name:s hours_ahead:i n_predictions:i mae:d mape:d",
        lambda v: monitoring.performance_by_horizon(v.evaluated),
        """select parking_lot_id, model_name, hours_ahead, count(*) n_predictions, avg(absolute_error) mae,
                  avg(percentage_error) mape
           from evaluated where actual_free_spaces is not null group by 1, 2, 3"""),
    "recent_errors": Entry(
        f"{_FORECAST} model_name:s predicted_free_spaces:i actual_free_spaces:i prediction_error:d percentage_error:d",
        lambda v: monitoring.recent_errors(v.evaluated, AS_OF),
        f"""select * from evaluated where actual_free_spaces is not null and evaluated_at > {NOW} - interval 48 hour
            order by target_hour desc, parking_lot_id, hours_ahead, model_name, prediction_made_at limit 100"""),
    "latest_prediction_batch": Entry(
        f"{_FORECAST} model_name:s predicted_free_spaces:i", lambda v: serving.latest_prediction_batch(v.forecasts),
        "select * from newest_batch"),
    "availability_outlook": Entry(
        f"{_FORECAST} capacity:i model:s free_spots:i occupied_spots:i probability:d availability_category:s "
        "availability_color:s", _outlook,
        f"select *, {_COLOR} availability_color from outlook_classes"),
    "current_status": Entry(
        "parking_lot_id:i lot_name:s status_time:t free_spaces:i occupied_spaces:i total_spaces:i occupancy_rate:d "
        "availability_probability:d availability_category:s availability_color:s",
        lambda v: serving.current_status(v.minute, v.lot_limits),
        f"select *, {_COLOR} availability_color from ({_STATUS_SQL})"),
    "historical_window": Entry(
        "parking_lot_id:i hour_timestamp:t free_spots:d", lambda v: serving.historical_window(v.online),
        "select * from history"),
    "trend": Entry(
        "parking_lot_id:i axis_time:t series:s model:s historical:d predicted:d",
        lambda v: serving.trend(serving.historical_window(v.online), _outlook(v)),
        """select parking_lot_id, hour_timestamp axis_time, 'history' series, null model, free_spots historical,
                  null predicted from history where parking_lot_id in (select parking_lot_id from outlook)
           union all
           select parking_lot_id, target_hour, 'forecast', model, null, free_spots from outlook
           where parking_lot_id in (select parking_lot_id from history)"""),
    "dashboard_bundle": Entry("parking_lot_id:i document:s", _bundle, _BUNDLE_SQL),
    "weather_next_24h": Entry(
        "hour_timestamp:t temperature_2m:d relative_humidity_2m:d precipitation:d weather_description:s is_current:b",
        lambda v: serving.weather_next_24h(v.weather, AS_OF),
        f"""select w.*, coalesce(d.label, 'Unknown') weather_description,
                   hour_timestamp = min(hour_timestamp) over () is_current
            from (select * from weather_hourly where hour_timestamp >= date_trunc('hour', {NOW})
                  and hour_timestamp < date_trunc('day', {NOW} + interval 24 hour) + interval 1 day
                  order by hour_timestamp limit 24) w
            left join {WEATHER_NAMES} on d.code = w.weather_code"""),
    "latest_weather": Entry(
        "hour_timestamp:t temperature_2m:d relative_humidity_2m:d precipitation:d weather_code:i",
        lambda v: serving.latest_weather(v.weather),
        "select * from weather_hourly where hour_timestamp = (select max(hour_timestamp) from weather_hourly)"),
    "table_samples": Entry(
        "parking_lot_id:i hour_timestamp:t avg_free_spaces:d total_rows:i",
        lambda v: serving.table_samples(v.training, "hour_timestamp", 10, [LOT]),
        """select *, (select count(*) from training) total_rows from training
           order by hour_timestamp, parking_lot_id limit 10"""),
    "hour_pattern": Entry(
        "hour_of_day:i mean_free_spaces:d min_free_spaces:d max_free_spaces:d n_rows:i",
        lambda v: explore.hour_pattern(v.training),
        """select hour_of_day, avg(avg_free_spaces) mean_free_spaces, min(avg_free_spaces) min_free_spaces,
                  max(avg_free_spaces) max_free_spaces, count(*) n_rows from training group by 1"""),
    "hour_iqr": Entry(
        "hour_of_day:i mean_free_spaces:d q25:d q75:d", lambda v: explore.hour_iqr(v.training),
        """select hour_of_day, avg(avg_free_spaces) mean_free_spaces, quantile_cont(avg_free_spaces, 0.25) q25,
                  quantile_cont(avg_free_spaces, 0.75) q75 from training group by 1"""),
    "hour_stats": Entry(
        "hour_of_day:i avg_mean:d avg_std:d avg_min:d avg_max:d min_avg:d max_avg:d",
        lambda v: explore.hour_stats(v.training),
        """select hour_of_day, avg(avg_free_spaces) avg_mean, stddev_samp(avg_free_spaces) avg_std,
                  min(avg_free_spaces) avg_min, max(avg_free_spaces) avg_max, avg(min_free_spaces) min_avg,
                  avg(max_free_spaces) max_avg from training group by 1"""),
    "day_stats": Entry(
        "day_of_week:i weekday_name:s mean_free_spaces:d std_free_spaces:d sample_count:i",
        lambda v: explore.day_stats(v.training),
        f"select *, n_rows sample_count from ({_group_sql('day_of_week', 'weekday_name')})"),
    "day_type_stats": Entry(f"day_type:s {_MEANS}", lambda v: explore.day_type_stats(v.training), _group_sql("day_type")),
    "month_stats": Entry(f"month_number:i month_name:s {_MEANS}", lambda v: explore.month_stats(v.training),
                         _group_sql("month_number", "month_name")),
    "month_trend": Entry(
        "month_start:t mean_free_spaces:d mean_temperature:d mean_precipitation:d",
        lambda v: explore.month_trend(v.training),
        """select date_trunc('month', hour_timestamp) month_start, avg(avg_free_spaces) mean_free_spaces,
                  avg(temperature_2m) mean_temperature, avg(precipitation) mean_precipitation from training group by 1"""),
    "weather_describe": Entry(
        "column_name:s n_values:i mean:d std:d min:d q25:d q50:d q75:d max:d",
        lambda v: explore.weather_describe(v.training),
        " union all ".join(
            f"""select '{c}' column_name, count({c}) n_values, avg({c}) mean, stddev_samp({c}) std, min({c}) as "min",
                       quantile_cont({c}, 0.25) q25, quantile_cont({c}, 0.5) q50, quantile_cont({c}, 0.75) q75,
                       max({c}) as "max" from training""" for c in _WEATHER)),
    "category_counts": Entry(
        "column_name:s category:s n_rows:i", lambda v: explore.category_counts(v.training),
        " union all ".join(f"select '{c}' column_name, {c} category, count(*) n_rows from training group by 2" for c in (
            "day_type", "time_period", "temperature_category", "precipitation_category"))),
    "dataset_profile": Entry(
        "n_rows:i first_hour:t last_hour:t days_covered:i missing_temperature_2m:i missing_relative_humidity_2m:i "
        "missing_avg_free_spaces:i", lambda v: explore.dataset_profile(v.training),
        """select count(*) n_rows, min(hour_timestamp) first_hour, max(hour_timestamp) last_hour,
                  floor(epoch(max(hour_timestamp) - min(hour_timestamp)) / 86400) days_covered,
                  count(*) - count(temperature_2m) missing_temperature_2m,
                  count(*) - count(relative_humidity_2m) missing_relative_humidity_2m,
                  count(*) - count(avg_free_spaces) missing_avg_free_spaces from training"""),
    "histogram": Entry(
        "column_name:s bin:i n_rows:i lowest:d highest:d", lambda v: explore.histogram(v.training),
        " union all ".join(
            f"""select '{c}' column_name, least({n}, floor((x - lo) * {n} / (hi - lo)) + 1) bin, count(*) n_rows,
                       min(lo) lowest, max(hi) highest
                from (select {c} x, min({c}) over () lo, max({c}) over () hi from training where {c} {test})
                group by 2""" for c, n, test in (
                ("temperature_2m", 30, "is not null"), ("relative_humidity_2m", 30, "is not null"),
                ("precipitation", 20, "> 0")))),
    "correlation_matrix": Entry(
        "column_a:s column_b:s correlation:d", lambda v: explore.correlation_matrix(v.training),
        " union all ".join(f"select '{a}' column_a, '{b}' column_b, corr({a}, {b}) correlation from training"
                           for a in _COLUMNS for b in _COLUMNS)),
    "pearson_test": Entry(
        "column_name:s r:d t_value:d p_value:d n_values:i significant:b", lambda v: explore.pearson_test(v.training), _PEARSON_SQL),
    "unscored_lots": Entry(
        "parking_lot_id:i reason:s", _unscored,
        """select parking_lot_id, case when parking_lot_id = 0 then 'no ranges' when parking_lot_id = 1 then 'no first_model'
                  else 'no weights' end reason
           from parking_lots where parking_lot_id in (0, 1) or parking_lot_id not in (select parking_lot_id from alpha where parking_lot_id <> 2)"""),
    "weather_impact": Entry(
        "dimension:s category:s mean_free_spaces:d std_free_spaces:d n_rows:i",
        lambda v: explore.weather_impact(v.training),
        " union all ".join(
            f"""select '{c}' dimension, {c} category, avg(avg_free_spaces) mean_free_spaces,
                       stddev_samp(avg_free_spaces) std_free_spaces, count(*) n_rows from training group by 2"""
            for c in ("temperature_category", "precipitation_category"))),
    "hour_temperature_pivot": Entry(
        "hour_of_day:i " + " ".join(f"{c}:d" for c in TEMPERATURE_LABELS),
        lambda v: explore.hour_temperature_pivot(v.training),
        "select hour_of_day, " + ", ".join(
            f"avg(avg_free_spaces) filter (where temperature_category = '{c}') as \"{c}\"" for c in TEMPERATURE_LABELS)
        + " from training group by 1"),
    "weather_summary": Entry(
        "time_period:s day_type:s temperature_category:s mean_free_spaces:d mean_temperature:d mean_precipitation:d",
        lambda v: explore.weather_summary(v.training), _group_sql("time_period", "day_type", "temperature_category")),
    "conditional_means": Entry(
        "mean_cold:d mean_warm:d mean_dry:d mean_rain:d mean_peak:d mean_off_peak:d cold_minus_warm:d dry_minus_rain:d "
        "peak_minus_off_peak:d", lambda v: explore.conditional_means(v.training),
        """select *, mean_cold - mean_warm cold_minus_warm, mean_dry - mean_rain dry_minus_rain,
                  mean_peak - mean_off_peak peak_minus_off_peak
           from (select (select avg(avg_free_spaces) from training where temperature_category = 'Cold') mean_cold,
                        (select avg(avg_free_spaces) from training where temperature_category = 'Warm') mean_warm,
                        (select avg(avg_free_spaces) from training where precipitation_category = 'No Rain') mean_dry,
                        (select avg(avg_free_spaces) from training where precipitation_category <> 'No Rain') mean_rain,
                        (select avg(avg_free_spaces) from training where time_period like '%Rush') mean_peak,
                        (select avg(avg_free_spaces) from training where time_period not like '%Rush') mean_off_peak)"""),
    "time_sample": Entry(
        "parking_lot_id:i hour_timestamp:t avg_free_spaces:d rainy:b", lambda v: explore.time_sample(v.training),
        """select *, coalesce(precipitation > 0, false) rainy from training
           order by md5(parking_lot_id || '|' || cast(epoch(hour_timestamp) as bigint) || '|42'), parking_lot_id,
                    hour_timestamp limit 1000"""),
    "box_stats": Entry(
        "dimension:s category:s n_rows:i q25:d q50:d q75:d whisker_low:d whisker_high:d n_outliers:i",
        lambda v: explore.box_stats(v.training),
        f"""with rows_ as ({_BOX_GROUPS}),
            boxes as (select dimension, category, quantile_cont(v, 0.25) q25, quantile_cont(v, 0.5) q50,
                             quantile_cont(v, 0.75) q75 from rows_ group by all)
            select dimension, category, q25, q50, q75, count(*) n_rows,
                   min(v) filter (where v >= q25 - 1.5 * (q75 - q25)) whisker_low,
                   max(v) filter (where v <= q75 + 1.5 * (q75 - q25)) whisker_high,
                   count(*) filter (where v < q25 - 1.5 * (q75 - q25) or v > q75 + 1.5 * (q75 - q25)) n_outliers
            from rows_ join boxes using (dimension, category) group by all"""),
    "clean_strings": Entry(
        "parking_lot_id:i hour_timestamp:t weekday_name:s month_name:s temperature_category:s",
        lambda v: explore.clean_strings(v.training.withColumns({
            "weekday_name": F.rpad("weekday_name", 9, " "), "month_name": F.rpad("month_name", 9, " ")})),
        "select * from training"),
    "period_columns": Entry(
        "parking_lot_id:i hour_timestamp:t date:t month_start:t week_start:t",
        lambda v: explore.period_columns(v.training),
        """select *, date_trunc('day', hour_timestamp) as "date", date_trunc('month', hour_timestamp) month_start,
                  date_trunc('week', hour_timestamp) week_start from training"""),
}
