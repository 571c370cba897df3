"""Minute occupancy from stays, as a sweep over arrivals and departures.

A stay covers the ticks from the first whole minute at or after its arrival up to, not
including, the first whole minute at or after its departure. Occupancy at a tick is
the running sum of +1/-1 changes, so no range join is needed. The running sum is taken
per lot and day; the net changes of earlier days enter as the day's opening value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.functions.clock import DAY, MINUTE, ceil_minute, seconds_floor
from lotwise.operators.frames import spread_out
from lotwise.schemas import LOT

MINUTES_PER_DAY = DAY // MINUTE


def _days(ops: DataFrame) -> DataFrame:
    """Every day of each lot's calendar, from its first arrival to the day after its last departure."""
    span = ops.groupBy(LOT).agg(F.min("arrival").alias("a"), F.max("departure").alias("d"))
    first, last = seconds_floor("a", DAY), seconds_floor("d", DAY) + 1
    return span.select(LOT, F.explode(F.sequence(first, last)).alias("day"), last.alias("last_day"))


def _minutes() -> Column:
    """The ticks of a day; the closing day contributes its midnight only."""
    start = F.col("day") * MINUTES_PER_DAY
    end = F.when(F.col("day") == F.col("last_day"), start).otherwise(start + MINUTES_PER_DAY - 1)
    return F.sequence(start, end)


def minute_calendar(ops: DataFrame) -> DataFrame:
    """Every minute per lot between the calendar's bounds, both ends included."""
    ticks = spread_out(_days(ops), LOT, "day").select(LOT, F.explode(_minutes()).alias("tick"))
    return ticks.select(LOT, F.timestamp_seconds(F.col("tick") * MINUTE).alias("minute_timestamp"))


def _changes(ops: DataFrame) -> DataFrame:
    """Net change of occupied spaces per lot and tick, combined before the shuffle."""
    covered = ops.select(LOT, ceil_minute("arrival").alias("enter"),
                         ceil_minute("departure").alias("leave"))
    events = covered.where("enter < leave").select(LOT, F.inline(F.array(
        F.struct(F.col("enter").alias("tick"), F.lit(1).alias("change")),
        F.struct(F.col("leave").alias("tick"), F.lit(-1).alias("change")))))
    return (events.groupBy(LOT, "tick").agg(F.sum("change").alias("change"))
            .withColumn("day", F.floor(F.col("tick") / MINUTES_PER_DAY).cast("long")))


def _opened_days(ops: DataFrame, changes: DataFrame) -> DataFrame:
    """Calendar days with the spaces still occupied from earlier days; one small row per day."""
    net = (_days(ops).withColumn("change", F.lit(0).cast("long"))
           .unionByName(changes.groupBy(LOT, "day").agg(F.sum("change").alias("change")),
                        allowMissingColumns=True)
           .groupBy(LOT, "day").agg(F.sum("change").alias("change"), F.max("last_day").alias("last_day")))
    past = Window.partitionBy(LOT).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return net.select(LOT, "day", "last_day", F.coalesce(F.sum("change").over(past), F.lit(0)).alias("change"))


def minute_occupancy(ops: DataFrame) -> DataFrame:
    """Occupied spaces per lot and minute; a minute without stays counts 0.

    Expects stays with ``arrival``/``departure`` timestamps and arrival < departure. Days and
    changes are shuffled by (lot, day) before a day is expanded into its minutes, so the
    minute rows themselves are never shuffled: merging per tick and the running sum both
    use that partitioning.
    """
    changes = _changes(ops)
    days = _opened_days(ops, changes)
    rows = spread_out(days.unionByName(changes, allowMissingColumns=True), LOT, "day")
    # A day row stands for every minute of its day and opens it at midnight.
    minute = F.explode(F.when(F.col("tick").isNull(), _minutes()).otherwise(F.array("tick"))).alias("minute")
    opens = F.col("tick").isNotNull() | (F.col("minute") == F.col("day") * MINUTES_PER_DAY)
    merged = (rows.select(LOT, "day", "tick", "change", minute)
              .select(LOT, "day", F.col("minute").alias("tick"), F.when(opens, F.col("change")).otherwise(0).alias("change"))
              .groupBy(LOT, "day", "tick").agg(F.sum("change").alias("change")))
    running = Window.partitionBy(LOT, "day").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    return merged.select(
        LOT, F.timestamp_seconds(F.col("tick") * MINUTE).alias("minute_timestamp"),
        F.sum("change").over(running).alias("occupied_spaces"))


def minute_free_spaces(occupancy: DataFrame, lots: DataFrame) -> DataFrame:
    """Adds capacity minus occupied; overbooked minutes are negative, not clamped."""
    capacity = lots.select(LOT, F.col("total_spaces").cast("long").alias("_capacity"))
    return (occupancy.join(capacity, LOT, "left")
            .withColumn("free_spaces", F.col("_capacity") - F.col("occupied_spaces"))
            .drop("_capacity"))
