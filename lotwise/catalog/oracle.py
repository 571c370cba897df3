"""DuckDB side of the checks: shared views and result shaping.

The SQL keeps the literal form of each rule (range joins, correlated subqueries, plain
window frames), so that it shares no plan with the Spark operators.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.plans.fixtures import AS_OF
from lotwise.schemas import BLEND_WEIGHTS, MODEL_VOCABULARY

NOW = f"timestamp '{AS_OF}'"


# Labels, codes and classes, written out here once more, so that a wrong threshold of the library shows (fixed values).
TRAINING_LABELS = """
    case when day_of_week = 0 or day_of_week = 6 then 'Weekend' else 'Weekday' end day_type,
    case when hour_of_day >= 6 and hour_of_day < 10 then 'Morning Rush' when hour_of_day >= 10 and hour_of_day < 17 then 'Daytime'
         when hour_of_day >= 17 and hour_of_day < 20 then 'Evening Rush' when hour_of_day >= 20 then 'Evening'
         else 'Night' end time_period,
    case when temperature_2m < 0 then 'Freezing' when temperature_2m >= 0 and temperature_2m <= 10 then 'Cold'
         when temperature_2m >= 11 and temperature_2m <= 20 then 'Mild'
         when temperature_2m >= 21 and temperature_2m <= 30 then 'Warm' else 'Hot' end temperature_category,
    case when precipitation = 0 then 'No Rain' when precipitation <= 2.5 then 'Light Rain'
         when precipitation <= 10 then 'Moderate Rain' else 'Heavy Rain' end precipitation_category"""

ONLINE_LABELS = """
    case when day_of_week = 0 or day_of_week = 6 then 'weekend' else 'weekday' end day_type,
    case when hour_of_day >= 6 and hour_of_day < 12 then 'morning' when hour_of_day >= 12 and hour_of_day < 18 then 'afternoon'
         when hour_of_day >= 18 and hour_of_day < 23 then 'evening' else 'night' end time_period,
    case when temperature_2m < 0 then 'freezing' when temperature_2m <= 10 then 'cold' when temperature_2m <= 20 then 'mild'
         else 'warm' end temperature_category,
    case when precipitation = 0 then 'none' when precipitation < 2.5 then 'light' when precipitation < 10 then 'moderate'
         else 'heavy' end precipitation_category"""

MODEL_LABELS = {
    "day_type": "case trim(day_type) when 'weekend' then 'Weekend' when 'Weekend' then 'Weekend' else 'Weekday' end",
    "time_period": """case when trim(time_period) in ('morning', 'afternoon', 'evening', 'night') then trim(time_period)
                      else 'morning' end""",
    "temperature_category": """case when trim(temperature_category) in ('cold', 'cool', 'moderate', 'warm', 'hot')
                               then trim(temperature_category) else 'cold' end""",
    "precipitation_category": """case trim(precipitation_category) when 'light' then 'light_rain' when 'light_rain' then 'light_rain'
                                 when 'moderate' then 'moderate_rain' when 'moderate_rain' then 'moderate_rain'
                                 when 'heavy' then 'heavy_rain' when 'heavy_rain' then 'heavy_rain' else 'no_rain' end""",
}

MODEL_CODES = {
    "day_type": "case day_type when 'Weekday' then 0::double when 'Weekend' then 1 end",
    "time_period": "case time_period when 'morning' then 0::double when 'afternoon' then 1 when 'evening' then 2 when 'night' then 3 end",
    "temperature_category": """case temperature_category when 'cold' then 0::double when 'cool' then 1 when 'moderate' then 2
                               when 'warm' then 3 when 'hot' then 4 end""",
    "precipitation_category": """case precipitation_category when 'no_rain' then 0::double when 'light_rain' then 1
                                 when 'moderate_rain' then 2 when 'heavy_rain' then 3 end""",
}

WEATHER_NAMES = """(values (0, 'Clear'), (1, 'Mainly Clear'), (2, 'Partly Cloudy'), (3, 'Overcast'), (45, 'Fog'),
    (48, 'Depositing Rime Fog'), (51, 'Light Drizzle'), (53, 'Moderate Drizzle'), (55, 'Dense Drizzle'), (61, 'Slight Rain'),
    (63, 'Moderate Rain'), (65, 'Heavy Rain'), (71, 'Slight Snow'), (73, 'Moderate Snow'), (75, 'Heavy Snow'),
    (80, 'Slight Showers'), (81, 'Moderate Showers'), (82, 'Violent Showers'), (95, 'Thunderstorm'),
    (96, 'Thunderstorm with Hail'), (99, 'Thunderstorm with Heavy Hail')) d(code, label)"""


def columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in parts.items())


CALENDAR = ("cast(extract(hour from hour_timestamp) as int) hour_of_day, dayofweek(hour_timestamp) day_of_week, "
            "dayname(hour_timestamp) weekday_name, day(hour_timestamp) day_of_month, "
            "weekofyear(hour_timestamp) calendar_week, month(hour_timestamp) month_number, "
            "monthname(hour_timestamp) month_name")

_EVEN, _ODD = BLEND_WEIGHTS.values()
_ALPHA_ROWS = ", ".join(f"({lot}, {h}, {a}::double)" for lot in range(4)
                        for h, a in enumerate(_EVEN if lot % 2 == 0 else _ODD, 1))


_GAPPY = ["avg_free_spaces", "min_free_spaces", "max_free_spaces", "free_spaces_range", "hour_of_day", "day_of_week",
          "day_of_month", "calendar_week", "temperature_2m", "relative_humidity_2m", "precipitation",
          "avg_free_spaces_rolling_24h", "avg_free_spaces_std_24h", "avg_free_spaces_diff_1h", "temperature_diff_1h"]


def filled(name: str, source: str | None = None) -> str:
    """Last known, else next known, else 0."""
    x = source or name
    return (f"coalesce(last_value({x} ignore nulls) over (partition by parking_lot_id order by hour_timestamp "
            f"rows between unbounded preceding and current row), first_value({x} ignore nulls) over "
            f"(partition by parking_lot_id order by hour_timestamp rows between current row and unbounded following), "
            f"0) {name}")


CTES = {
    "parking_operations": """
        select cast(user_id % 4 as int) parking_lot_id, cast(user_id as int) parking_space_id,
               cast(floor(epoch(ts)) as bigint) arrival_unix_seconds,
               cast(floor(epoch(ts)) as bigint) + cast(floor(value * 60) as bigint) departure_unix_seconds,
               cast(event_id as int) xml_id from events""",
    "stays": """
        select *, make_timestamp(arrival_unix_seconds * 1000000) arrival,
               make_timestamp(departure_unix_seconds * 1000000) departure
        from parking_operations where arrival_unix_seconds < departure_unix_seconds""",
    "parking_lots": """
        select parking_lot_id, 'Lot ' || parking_lot_id as name, cast(count(distinct parking_space_id) as int) total_spaces
        from parking_operations group by parking_lot_id""",
    "lot_limits": "select parking_lot_id, name, nullif(40 + 15 * parking_lot_id, 85) total_spaces from parking_lots",
    "lots_open": "select parking_lot_id, name, 55 + 5 * parking_lot_id total_spaces from parking_lots",
    "calendar_ticks": """
        select parking_lot_id, unnest(generate_series(date_trunc('day', min(arrival))::timestamp,
               date_trunc('day', max(departure))::timestamp + interval 1 day, interval 1 minute)) minute_timestamp
        from stays group by parking_lot_id""",
    "occupied": """
        select t.parking_lot_id, t.minute_timestamp, count(s.parking_space_id) occupied_spaces
        from calendar_ticks t left join stays s on s.parking_lot_id = t.parking_lot_id
             and t.minute_timestamp >= s.arrival and t.minute_timestamp < s.departure
        group by all""",
    "occupancy": """
        select o.*, l.total_spaces - o.occupied_spaces free_spaces
        from occupied o left join parking_lots l using (parking_lot_id)""",
    "weather_hourly": """
        select date_trunc('hour', ts)::timestamp hour_timestamp,
               avg(case when event_type = 'view' then value end) / 2 - 8 temperature_2m,
               least(100, avg(case when event_type = 'signup' then value end)) relative_humidity_2m,
               greatest(0, avg(case when event_type = 'error' then value end) - 45) / 4 precipitation,
               cast(max(case when event_type = 'click' then user_id end) % 100 as int) weather_code
        from events group by 1""",
    "occupancy_snapshots": """
        select ts minute_timestamp, cast(user_id % 4 as int) parking_lot_id,
               cast(props->>'$.k' as int) general_occupied,
               case when event_id % 50 = 0 then 0 else 100 end general_total,
               event_type = 'error' invalid, event_id from events""",
    "minute_rows": """
        select parking_lot_id, minute_timestamp, event_id,
               case when general_total <> 0 then general_total - general_occupied end free_spaces,
               general_occupied occupied_spaces, general_total total_spaces,
               case when general_total > 0 then general_occupied * 100.0 / general_total end occupancy_rate,
               case when event_id % 3 <> 0 then 'Lot ' || parking_lot_id end parking_lot_name
        from occupancy_snapshots""",
    "hourly_base": """
        select parking_lot_id, date_trunc('hour', minute_timestamp)::timestamp hour_timestamp,
               avg(general_total - general_occupied) avg_free_spaces,
               min(general_total - general_occupied) min_free_spaces,
               max(general_total - general_occupied) max_free_spaces,
               max(general_total - general_occupied) - min(general_total - general_occupied) free_spaces_range
        from occupancy_snapshots where general_total > 0 group by 1, 2""",
    "hourly_calendar": f"select *, {CALENDAR} from hourly_base",
    "series": """
        select parking_lot_id, hour_timestamp, avg_free_spaces free_spaces, (100 - avg_free_spaces) / 100 occupancy_rate,
               hour_of_day, day_of_week from hourly_calendar""",
    "training": f"""
        select *, {TRAINING_LABELS}
        from hourly_calendar join (select hour_timestamp, temperature_2m, relative_humidity_2m, precipitation
                                   from weather_hourly) using (hour_timestamp)""",
    "online_weather": """
        select h.*, w.temperature_2m, w.relative_humidity_2m, w.precipitation
        from hourly_calendar h left join weather_hourly w
             on date_trunc('hour', h.hour_timestamp) = date_trunc('hour', w.hour_timestamp)""",
    "online": f"""
        select c.*, {ONLINE_LABELS},
               (select avg(p.avg_free_spaces) from hourly_base p where p.parking_lot_id = c.parking_lot_id
                and p.hour_timestamp > c.hour_timestamp - interval 24 hour
                and p.hour_timestamp <= c.hour_timestamp) avg_free_spaces_rolling_24h,
               (select stddev_samp(p.avg_free_spaces) from hourly_base p where p.parking_lot_id = c.parking_lot_id
                and p.hour_timestamp > c.hour_timestamp - interval 24 hour
                and p.hour_timestamp <= c.hour_timestamp) avg_free_spaces_std_24h,
               c.avg_free_spaces - (select p.avg_free_spaces from hourly_base p where p.parking_lot_id = c.parking_lot_id
                and p.hour_timestamp = c.hour_timestamp - interval 1 hour) avg_free_spaces_diff_1h,
               c.temperature_2m - (select w.temperature_2m from weather_hourly w
                where w.hour_timestamp = c.hour_timestamp - interval 1 hour) temperature_diff_1h
        from online_weather c""",
    "lot_hours": f"""
        select o.* exclude (hour_timestamp, hour_of_day, day_of_week, weekday_name, day_of_month, calendar_week, month_number,
                            month_name, parking_lot_id),
               g.parking_lot_id, g.hour_timestamp, {CALENDAR.replace('hour_timestamp', 'g.hour_timestamp')},
               o.avg_free_spaces is not null observed
        from (select parking_lot_id, unnest(generate_series(min(hour_timestamp), max(hour_timestamp), interval 1 hour))
                     hour_timestamp from online group by parking_lot_id) g
        left join online o on o.parking_lot_id = g.parking_lot_id and o.hour_timestamp = g.hour_timestamp""",
    "filled_hours": f"""
        select parking_lot_id, hour_timestamp, observed,
               {', '.join(filled(c, f'coalesce({c}, 0)' if c.endswith('std_24h') else c) for c in _GAPPY)},
               month(hour_timestamp) "month", {', '.join(f'{c} own_{c}' for c in MODEL_VOCABULARY)}
        from lot_hours""",
    "labelled_hours": f"""
        select * replace ({', '.join(f'coalesce(own_{c}, {c}) as {c}' for c in MODEL_VOCABULARY)})
        from (select *, {ONLINE_LABELS} from filled_hours)""",
    "model_rows": f"""
        select * replace ({columns(MODEL_LABELS)}) from labelled_hours""",
    "model_frame": f"""
        select * replace ({columns(MODEL_CODES)}) from model_rows""",
    "pair": """
        select g.parking_lot_id, g.origin, g.horizon, g.origin + to_hours(g.horizon) target_hour,
               a.avg_free_spaces model_a, b.avg_free_spaces model_b
        from (select distinct parking_lot_id, date_trunc('day', hour_timestamp)::timestamp origin,
                     cast(h as int) horizon from hourly_base, range(1, 25) t(h)) g
        join hourly_base a on a.parking_lot_id = g.parking_lot_id and a.hour_timestamp = g.origin - interval 1 hour
        join hourly_base b on b.parking_lot_id = g.parking_lot_id
             and b.hour_timestamp = g.origin + to_hours(g.horizon) - interval 24 hour""",
    "alpha": f"select * from (values {_ALPHA_ROWS}) t(parking_lot_id, horizon, alpha)",
    "blended": """
        select p.*, alpha, alpha * model_a + (1 - alpha) * model_b prediction
        from pair p join alpha using (parking_lot_id, horizon)""",
    "with_actual": """
        select p.*, h.avg_free_spaces actual from blended p join hourly_base h
        on h.parking_lot_id = p.parking_lot_id and h.hour_timestamp = p.target_hour""",
    "forecasts": """
        select origin prediction_made_at, target_hour, parking_lot_id, 'persistence' model_name, horizon hours_ahead,
               cast(greatest(0, round_even(model_a, 0)) as int) predicted_free_spaces from pair
        union all
        select origin, target_hour, parking_lot_id, 'seasonal', horizon,
               cast(greatest(0, round_even(model_b, 0)) as int) from pair
        union all
        select origin, target_hour, parking_lot_id, 'hybrid_persistence_seasonal', horizon,
               cast(trunc(least(greatest(prediction, 0), total_spaces)) as int)
        from blended join lots_open using (parking_lot_id)""",
    "judged": f"""
        select f.*, cast(round(h.avg_free_spaces) as int) actual_free_spaces
        from forecasts f left join hourly_base h on h.parking_lot_id = f.parking_lot_id
             and h.hour_timestamp = f.target_hour and h.hour_timestamp < date_trunc('hour', {NOW})""",
    "evaluated": """
        select *, predicted_free_spaces - actual_free_spaces prediction_error,
               abs(predicted_free_spaces - actual_free_spaces) absolute_error,
               case when actual_free_spaces <> 0
                    then abs(predicted_free_spaces - actual_free_spaces) * 100.0 / abs(actual_free_spaces) end percentage_error,
               case when actual_free_spaces is not null then target_hour + interval 70 minute end evaluated_at
        from judged""",
    "wide": f"""
        select parking_lot_id, prediction_made_at prediction_timestamp, model_name,
               list(predicted_free_spaces order by hours_ahead) predicted_free_spaces,
               {', '.join(f'max(case when hours_ahead = {h} then predicted_free_spaces end) hour_{h}' for h in range(1, 25))},
               case when lower(model_name) like '%hybrid%' then 0.92 else 0.85 end confidence_score
        from forecasts group by parking_lot_id, prediction_made_at, model_name""",
    "newest_batch": """
        select * from forecasts f where prediction_made_at =
            (select max(g.prediction_made_at) from forecasts g where g.parking_lot_id = f.parking_lot_id)""",
    "outlook": """
        select parking_lot_id, coalesce(total_spaces, 100) capacity, prediction_made_at,
               case when lower(model_name) like '%hybrid%' then 'Hybrid Model (Lot ' || parking_lot_id || ')'
                    else model_name end model,
               target_hour, hours_ahead, greatest(0, least(predicted_free_spaces, coalesce(total_spaces, 100))) free_spots
        from newest_batch left join lot_limits using (parking_lot_id)""",
    "outlook_classes": """
        select *, capacity - free_spots occupied_spots, free_spots / capacity probability,
               case when free_spots / capacity >= 0.5 then 'Very High' when free_spots / capacity >= 0.3 then 'High'
                    when free_spots / capacity >= 0.15 then 'Low' else 'Very Low' end availability_category
        from outlook""",
    "history": """
        select parking_lot_id, hour_timestamp, coalesce(avg_free_spaces, 0) free_spots
        from (select *, row_number() over (partition by parking_lot_id order by hour_timestamp desc) rn from online)
        where rn <= 48""",
}


def complete(body: str) -> str:
    """Puts the views that ``body`` names, and those they name, in front of it."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in seen and re.search(rf"\b(from|join)\s+{name}\b", text):
                seen.add(name)
                visit(CTES[name])
                needed.append(name)
    visit(body)
    views = ",\n".join(f"{n} as ({CTES[n]})" for n in needed)
    own = body.strip().removeprefix("with ")
    if own != body.strip():
        return f"with {views},\n{own}" if needed else body
    return f"with {views}\n{body}" if needed else body


# A result shape names columns with a kind: i whole number, d number to six decimals, m number
# to three decimals, t instant, s text, b truth value. Both engines are brought to it. Before
# rounding, a fixed amount below the last digit moves the rounding points away from short
# binary fractions such as 1/128, where sums taken in another order would round differently.
_SHIFT = {"d": (6, "0.00000037"), "m": (3, "0.00037")}


def _kinds(shape: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in shape.split()]


def shaped(df: DataFrame, shape: str) -> DataFrame:
    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in _SHIFT:
            digits, shift = _SHIFT[kind]
            return F.round(c.cast("double") + float(shift), digits).alias(name)
        return c.cast({"i": "long", "t": "timestamp", "s": "string", "b": "boolean"}[kind]).alias(name)
    return df.select(*[cell(n, k) for n, k in _kinds(shape)])


def shaped_sql(body: str, shape: str) -> str:
    def cell(name: str, kind: str) -> str:
        q = f'"{name}"'
        if kind in _SHIFT:
            digits, shift = _SHIFT[kind]
            return f"round(cast({q} as double) + {shift}::double, {digits}) + 0.0::double as {q}"
        kinds = {"i": "bigint", "t": "timestamp", "s": "varchar", "b": "boolean"}
        return f"cast({q} as {kinds[kind]}) as {q}"
    sql = complete(body)
    cells = ", ".join(cell(n, k) for n, k in _kinds(shape))
    return f"select {cells} from (\n{sql}\n) shaped_result"
