"""Checks of sources, sinks and the interval and rollup operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotwise.catalog.entry import Entry
from lotwise.catalog.oracle import CALENDAR, NOW
from lotwise.operators import intervals, rollups
from lotwise.plans.fixtures import AS_OF, Views
from lotwise.schemas import LOT
from lotwise.session import scratch_path
from lotwise.sources import operations, snapshots, tables, weather

_STAY = "parking_lot_id:i parking_space_id:i arrival_unix_seconds:i departure_unix_seconds:i xml_id:i"
_STAY_KEY = [LOT, "parking_space_id", "arrival_unix_seconds"]
_HOUR = "parking_lot_id:i hour_timestamp:t"


def stays(v: Views) -> DataFrame:
    return operations.operations_epoch_to_timestamp(operations.operations_valid_intervals(v.operations))


def minute_table(v: Views) -> DataFrame:
    return intervals.minute_free_spaces(intervals.minute_occupancy(stays(v)), v.lots)


def _csv(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "operations-csv")
    v.operations.write.option("sep", ";").option("header", True).csv(path)
    return operations.operations_csv_scan(v.spark, path)


def _weather_documents(v: Views) -> DataFrame:
    """Weather as one document per day; even days lack the last humidity value."""
    day = F.date_trunc("day", "hour_timestamp")
    hours = F.sort_array(F.collect_list(F.struct(
        "hour_timestamp", "temperature_2m", "relative_humidity_2m", "precipitation", "weather_code")))
    humidity = F.transform("h", lambda x: x["relative_humidity_2m"])
    short = F.when(F.dayofmonth("day") % 2 == 0, F.slice(humidity, 1, F.size("h") - 1)).otherwise(humidity)
    hourly = F.struct(
        F.transform("h", lambda x: F.date_format(x["hour_timestamp"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform("h", lambda x: x["temperature_2m"]).alias("temperature_2m"),
        short.alias("relative_humidity_2m"),
        F.transform("h", lambda x: x["precipitation"]).alias("precipitation"),
        F.transform("h", lambda x: x["weather_code"]).alias("weather_code"))
    return (v.weather.groupBy(day.alias("day")).agg(hours.alias("h"))
            .select(F.to_json(F.struct(hourly.alias("hourly"))).alias("payload")))


def _snapshot_documents(v: Views) -> DataFrame:
    """One fetched list per event; class counts absent, null or present in turn."""
    k = F.col("general_occupied") % 5
    family = (F.when(F.col("event_id") % 3 == 0, F.lit(""))
              .when(F.col("event_id") % 3 == 1, F.lit(', "family_occupied": null'))
              .otherwise(F.concat(F.lit(', "family_occupied": '), k.cast("string"))))
    invalid = F.when(F.col("invalid"), F.lit(', "invalid": true')).otherwise(F.lit(""))
    payload = F.concat(
        F.lit('[{"parking_lot_id": '), F.col(LOT).cast("string"), F.lit(', "name": "Lot '), F.col(LOT).cast("string"),
        F.lit('", "general_occupied": '), F.col("general_occupied").cast("string"),
        F.lit(', "general_total": '), F.col("general_total").cast("string"), family, invalid, F.lit("}]"))
    return v.snapshots.select(F.col("minute_timestamp").alias("fetched_at"), F.col("event_id").alias("sequence"),
                              payload.alias("payload"))


def _materialised(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "hourly")
    return tables.materialise(v.hourly, path, "hour_timestamp", [LOT, "hour_timestamp"])


def _exported(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "training")
    tables.parquet_export(v.training, path)
    return tables.parquet_reload(v.spark, path, [LOT, "hour_timestamp", "avg_free_spaces", "temperature_category"])


def _to_minute(df: DataFrame) -> DataFrame:
    """Keeps the event's own instant as the order and truncates the key to the minute."""
    return (df.withColumn("seen_at", F.col("minute_timestamp"))
            .withColumn("minute_timestamp", F.date_trunc("minute", "minute_timestamp")))


def _upsert(v: Views) -> DataFrame:
    rows = _to_minute(v.minute)
    stored, batch = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    return tables.upsert_latest(stored, batch, [LOT, "minute_timestamp"], ["seen_at", "event_id"])


def _unique(v: Views) -> DataFrame:
    rows = v.snapshots
    return tables.unique_append(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"),
                                [LOT, "minute_timestamp", "event_id"])


ENTRIES = {
    "operations_csv_scan": Entry(_STAY, _csv, "select * from parking_operations"),
    "operations_valid_intervals": Entry(
        _STAY, lambda v: operations.operations_valid_intervals(v.operations), "select * from stays"),
    "operations_epoch_to_timestamp": Entry(
        f"{_STAY} arrival:t departure:t", stays, "select * from stays"),
    "insert_ignore": Entry(
        _STAY, lambda v: tables.insert_ignore(v.operations.where("xml_id % 2 = 0"), v.operations, _STAY_KEY, ["xml_id"]),
        """select * from parking_operations where xml_id % 2 = 0
           union all
           select parking_lot_id, parking_space_id, arrival_unix_seconds, departure_unix_seconds, xml_id from (
             select *, row_number() over (partition by parking_lot_id, parking_space_id, arrival_unix_seconds
                                          order by xml_id) rn
             from parking_operations o where not exists (
               select 1 from parking_operations t where t.xml_id % 2 = 0 and t.parking_lot_id = o.parking_lot_id
               and t.parking_space_id = o.parking_space_id and t.arrival_unix_seconds = o.arrival_unix_seconds))
           where rn = 1"""),
    "upsert_latest": Entry(
        "parking_lot_id:i minute_timestamp:t free_spaces:i occupied_spaces:i event_id:i", _upsert,
        """select parking_lot_id, date_trunc('minute', minute_timestamp)::timestamp minute_timestamp,
                  arg_max(free_spaces_or_null, (minute_timestamp, event_id))[1] free_spaces,
                  arg_max(occupied_spaces, (minute_timestamp, event_id)) occupied_spaces,
                  arg_max(event_id, (minute_timestamp, event_id)) event_id
           from (select *, [free_spaces] free_spaces_or_null from minute_rows) group by 1, 2"""),
    "weather_json_explode": Entry(
        "hour_timestamp:t temperature_2m:d relative_humidity_2m:d precipitation:d wind_speed_10m:d weather_code:i",
        lambda v: weather.weather_json_explode(_weather_documents(v)),
        """select hour_timestamp, temperature_2m,
                  case when day(hour_timestamp) % 2 = 0 and hour_timestamp =
                       max(hour_timestamp) over (partition by date_trunc('day', hour_timestamp))
                       then null else relative_humidity_2m end relative_humidity_2m,
                  precipitation, null wind_speed_10m, weather_code from weather_hourly"""),
    "weather_current_hour": Entry(
        "hour_timestamp:t temperature_2m:d part:s",
        lambda v: weather.weather_current_hour(v.weather, AS_OF).withColumn("part", F.lit("now")).unionByName(
            weather.weather_current_hour(v.weather, AS_OF, 30).withColumn("part", F.lit("ahead"))),
        f"""select hour_timestamp, temperature_2m, 'now' part from weather_hourly
            where hour_timestamp = date_trunc('hour', {NOW})
            union all
            select hour_timestamp, temperature_2m, 'ahead' from weather_hourly
            where hour_timestamp::date between cast({NOW} as date)
                  and cast(date_trunc('hour', {NOW}) + interval 30 hour as date)"""),
    "occupancy_snapshot_parse": Entry(
        "sequence:i fetched_at:t parking_lot_id:i name:s city:s general_occupied:i general_total:i "
        "family_occupied:i family_total:i electrocharger_total:i invalid:b",
        lambda v: snapshots.occupancy_snapshot_parse(_snapshot_documents(v)),
        """select event_id as sequence, minute_timestamp fetched_at, parking_lot_id, 'Lot ' || parking_lot_id as name,
                  null city, general_occupied, general_total,
                  case event_id % 3 when 0 then 0 when 1 then null else general_occupied % 5 end family_occupied,
                  0 family_total, 0 electrocharger_total, invalid from occupancy_snapshots"""),
    "occupancy_rate": Entry(
        "event_id:i parking_lot_id:i free_spaces:i occupancy_rate:d",
        lambda v: snapshots.occupancy_rate(v.snapshots),
        "select event_id, parking_lot_id, free_spaces, occupancy_rate from minute_rows"),
    "unique_append": Entry(
        "event_id:i parking_lot_id:i minute_timestamp:t general_occupied:i", _unique,
        "select event_id, parking_lot_id, minute_timestamp, general_occupied from occupancy_snapshots"),
    "materialise": Entry(f"{_HOUR} avg_free_spaces:d min_free_spaces:i max_free_spaces:i", _materialised,
                         "select * from hourly_base"),
    "parquet_export": Entry(f"{_HOUR} avg_free_spaces:d temperature_category:s", _exported, "select * from training"),
    "table_scan": Entry(
        "o_orderkey:i o_custkey:i o_totalprice:d",
        lambda v: tables.table_scan(v.spark, f"{v.folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"],
                                    ["o_totalprice > 100000", "o_orderdate >= '1997-01-01'"]),
        "select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice > 100000 "
        "and o_orderdate >= '1997-01-01'"),
    "minute_calendar": Entry(
        "parking_lot_id:i minute_timestamp:t", lambda v: intervals.minute_calendar(stays(v)),
        "select * from calendar_ticks"),
    "minute_occupancy": Entry(
        "parking_lot_id:i minute_timestamp:t occupied_spaces:i", lambda v: intervals.minute_occupancy(stays(v)),
        "select * from occupied"),
    "minute_free_spaces": Entry(
        "parking_lot_id:i minute_timestamp:t occupied_spaces:i free_spaces:i", minute_table,
        "select * from occupancy"),
    "hourly_rollup": Entry(
        f"{_HOUR} avg_free_spaces:d min_free_spaces:i max_free_spaces:i free_spaces_range:i",
        lambda v: rollups.hourly_rollup(minute_table(v)),
        """select parking_lot_id, date_trunc('hour', minute_timestamp)::timestamp hour_timestamp,
                  case when sum(free_spaces) < 0 then -((200 * -sum(free_spaces) + count(*)) // (2 * count(*)))
                       else (200 * sum(free_spaces) + count(*)) // (2 * count(*)) end / 100.0 avg_free_spaces,
                  min(free_spaces) min_free_spaces, max(free_spaces) max_free_spaces,
                  max(free_spaces) - min(free_spaces) free_spaces_range
           from occupancy group by 1, 2"""),
    "calendar_fields": Entry(
        f"{_HOUR} hour_of_day:i day_of_week:i weekday_name:s day_of_month:i calendar_week:i month_number:i month_name:s",
        lambda v: rollups.calendar_fields(v.hourly), f"select *, {CALENDAR} from hourly_base"),
    "hourly_rollup_window": Entry(
        f"{_HOUR} avg_free_spaces:d min_free_spaces:i max_free_spaces:i free_spaces_range:i hour_of_day:i day_of_week:i",
        lambda v: rollups.hourly_rollup_window(v.minute, "2024-01-08 00:00:00", "2024-01-15 12:30:00"),
        """select parking_lot_id, date_trunc('hour', minute_timestamp)::timestamp hour_timestamp,
                  avg(free_spaces) avg_free_spaces, min(free_spaces) min_free_spaces, max(free_spaces) max_free_spaces,
                  max(free_spaces) - min(free_spaces) free_spaces_range,
                  any_value(extract(hour from minute_timestamp)) hour_of_day,
                  any_value(dayofweek(minute_timestamp)) day_of_week
           from minute_rows where free_spaces is not null and minute_timestamp >= timestamp '2024-01-08'
                and minute_timestamp < timestamp '2024-01-15 12:30:00' group by 1, 2"""),
    "last_complete_hour": Entry(
        "event_id:i parking_lot_id:i minute_timestamp:t",
        lambda v: rollups.last_complete_hour(v.snapshots, AS_OF, "minute_timestamp"),
        f"""select event_id, parking_lot_id, minute_timestamp from occupancy_snapshots
            where minute_timestamp >= date_trunc('hour', {NOW}) - interval 1 hour
                  and minute_timestamp < date_trunc('hour', {NOW})"""),
    "readiness_counts": Entry(
        "source:s n_rows:i ready:b", lambda v: rollups.readiness_counts(v.minute, v.hourly, v.weather, AS_OF),
        " union all ".join(
            f"""select '{name}' source, count(*) n_rows, count(*) > 0 ready from {view}
                where {ts} >= date_trunc('hour', {NOW}) - interval 1 hour and {ts} < date_trunc('hour', {NOW})"""
            for name, view, ts in (("minute", "minute_rows", "minute_timestamp"),
                                   ("hourly", "hourly_base", "hour_timestamp"),
                                   ("weather", "weather_hourly", "hour_timestamp")))),
}
