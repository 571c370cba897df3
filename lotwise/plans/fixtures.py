"""Views over the shared test tables that stand in for the landed parking data.

``CTES`` holds the same views for DuckDB, so both engines start from equal rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.functions.clock import HOUR, plus_hours
from lotwise.operators.categories import categories_online, categories_training
from lotwise.operators.features import online_features, temperature_diff_1h
from lotwise.operators.joins import training_join, weather_left_join
from lotwise.operators.rollups import calendar_fields
from lotwise.operators.supervised import model_frame
from lotwise.schemas import BLEND_WEIGHTS, LOT
from lotwise.session import stored

AS_OF = "2024-01-15 12:05:00"


class Views:
    """Lazily built frames for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def operations(self) -> DataFrame:
        arrival = F.unix_seconds("ts")
        return self.events.select(
            (F.col("user_id") % 4).cast("int").alias(LOT), F.col("user_id").cast("int").alias("parking_space_id"),
            arrival.alias("arrival_unix_seconds"),
            (arrival + F.floor(F.col("value") * 60).cast("long")).alias("departure_unix_seconds"),
            F.col("event_id").cast("int").alias("xml_id"))

    @cached_property
    def lots(self) -> DataFrame:
        return (self.operations.groupBy(LOT)
                .agg(F.count_distinct("parking_space_id").cast("int").alias("total_spaces"))
                .withColumn("name", F.concat(F.lit("Lot "), F.col(LOT).cast("string"))))

    @cached_property
    def lot_limits(self) -> DataFrame:
        """Capacities near the forecasts; the last lot's is unknown."""
        return self.lots.withColumn("total_spaces", F.nullif(F.lit(40) + 15 * F.col(LOT), F.lit(85)))

    @cached_property
    def weather(self) -> DataFrame:
        def value(kind: str):
            return F.when(F.col("event_type") == kind, F.col("value"))
        return self.events.groupBy(F.date_trunc("hour", "ts").alias("hour_timestamp")).agg(
            (F.avg(value("view")) / 2 - 8).alias("temperature_2m"),
            F.least(F.lit(100.0), F.avg(value("signup"))).alias("relative_humidity_2m"),
            (F.greatest(F.lit(0.0), F.avg(value("error")) - 45) / 4).alias("precipitation"),
            (F.max(F.when(F.col("event_type") == "click", F.col("user_id"))) % 100).cast("int").alias("weather_code"))

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.events.select(
            F.col("ts").alias("minute_timestamp"), (F.col("user_id") % 4).cast("int").alias(LOT),
            F.get_json_object("props", "$.k").cast("int").alias("general_occupied"),
            F.when(F.col("event_id") % 50 == 0, 0).otherwise(100).alias("general_total"),
            (F.col("event_type") == "error").alias("invalid"), "event_id")

    @cached_property
    def minute(self) -> DataFrame:
        """Snapshots in the minute table's layout, one row per snapshot, total 0 as unknown."""
        total, occupied = F.col("general_total").cast("long"), F.col("general_occupied").cast("long")
        return self.snapshots.select(
            LOT, "minute_timestamp", F.when(total != 0, total - occupied).alias("free_spaces"),
            occupied.alias("occupied_spaces"), total.alias("total_spaces"),
            F.when(total > 0, occupied / total * 100).alias("occupancy_rate"),
            F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Lot "), F.col(LOT).cast("string")))
            .alias("parking_lot_name"), "event_id")

    @cached_property
    def hourly(self) -> DataFrame:
        free = F.col("general_total") - F.col("general_occupied")
        return (self.snapshots.where("general_total > 0")
                .groupBy(LOT, F.date_trunc("hour", "minute_timestamp").alias("hour_timestamp"))
                .agg(F.avg(free).alias("avg_free_spaces"), F.min(free).alias("min_free_spaces"),
                     F.max(free).alias("max_free_spaces"), (F.max(free) - F.min(free)).alias("free_spaces_range")))

    @cached_property
    def series(self) -> DataFrame:
        """Hourly rows named as the row-based features expect them."""
        return calendar_fields(self.hourly).select(
            LOT, "hour_timestamp", F.col("avg_free_spaces").alias("free_spaces"),
            ((100 - F.col("avg_free_spaces")) / 100).alias("occupancy_rate"), "hour_of_day", "day_of_week")

    @cached_property
    def training(self) -> DataFrame:
        return categories_training(training_join(calendar_fields(self.hourly), self.weather))

    @cached_property
    def online(self) -> DataFrame:
        """Hours with weather, online categories and the four engineered features."""
        features = online_features(calendar_fields(self.hourly))
        return temperature_diff_1h(categories_online(weather_left_join(features, self.weather)), self.weather)

    @cached_property
    def features(self) -> DataFrame:
        """The online rows as a stored table, the form that the model inputs are built from."""
        return stored(self.online, "features")

    @cached_property
    def frame(self) -> DataFrame:
        return stored(model_frame(self.features), "frame")

    @cached_property
    def pair(self) -> DataFrame:
        """Two forecasts per lot and day: the last value, and the value of a day before the target."""
        days = self.hourly.select(LOT, F.date_trunc("day", "hour_timestamp").alias("origin")).distinct()
        grid = days.select(LOT, "origin", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("horizon"))
        a = self.hourly.select(LOT, plus_hours(F.col("hour_timestamp"), 1).alias("origin"),
                               F.col("avg_free_spaces").alias("model_a"))
        b = self.hourly.select(LOT, plus_hours(F.col("hour_timestamp"), 24).alias("target_hour"),
                               F.col("avg_free_spaces").alias("model_b"))
        return (grid.withColumn("target_hour", plus_hours(F.col("origin"), F.col("horizon")))
                .join(a, [LOT, "origin"]).join(b, [LOT, "target_hour"]))

    def one(self, column: str) -> DataFrame:
        return self.pair.select(LOT, "origin", "horizon", F.col(column).alias("prediction"))

    @cached_property
    def actual(self) -> DataFrame:
        """What happened at each target, on the forecasts' key."""
        happened = self.hourly.select(LOT, F.col("hour_timestamp").alias("target_hour"),
                                      F.col("avg_free_spaces").alias("actual"))
        return self.pair.select(LOT, "origin", "horizon", "target_hour").join(happened, [LOT, "target_hour"])

    @cached_property
    def alpha(self) -> DataFrame:
        """The published weights, given to even and odd lots in turn."""
        from lotwise.operators.blending import blend_weights
        even, odd = BLEND_WEIGHTS.values()
        return blend_weights(self.spark, {0: even, 1: odd, 2: even, 3: odd})

    @cached_property
    def forecasts(self) -> DataFrame:
        """Stored forecasts of three models, made daily."""
        from lotwise.operators.blending import blend_predictions, constrain_predictions, prediction_rows
        a, b = self.one("model_a"), self.one("model_b")
        rows = None
        for name, pred, rule in (("persistence", a, "baseline"), ("seasonal", b, "baseline"),
                                 ("hybrid_persistence_seasonal", blend_predictions(a, b, self.alpha), "hybrid")):
            part = prediction_rows(constrain_predictions(pred, self.lots_open, rule), F.col("origin"), name)
            rows = part if rows is None else rows.unionByName(part)
        return rows

    @cached_property
    def lots_open(self) -> DataFrame:
        """Capacities that cut some hybrid forecasts but not all."""
        return self.lots.withColumn("total_spaces", F.lit(55) + 5 * F.col(LOT))

    @cached_property
    def evaluated(self) -> DataFrame:
        from lotwise.operators.monitoring import backfill_actuals
        filled = backfill_actuals(self.forecasts, self.hourly, AS_OF)
        checked = F.timestamp_micros(F.unix_micros("target_hour") + (HOUR + 600) * 1_000_000)
        return filled.withColumn("evaluated_at", F.when(F.col("evaluated_at").isNotNull(), checked))
