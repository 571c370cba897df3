"""Occupancy snapshots: lists of lots in JSON, fetched every minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_TEXT = ["name", "address", "city", "country"]
_NUMBER = ["latitude", "longitude"]
_GENERAL = ["general_occupied", "general_total"]
_CLASSES = ["family_occupied", "family_total", "disabled_occupied", "disabled_total",
            "electrocharger_occupied", "electrocharger_total"]


def _field(name: str) -> Column:
    return F.try_element_at("lot", F.lit(name))


def _or_if_absent(name: str, default, kind: str) -> Column:
    """The default replaces an absent field; a present null stays null."""
    return (F.when(F.map_contains_key("lot", name), _field(name).cast(kind))
            .otherwise(F.lit(default).cast(kind)).alias(name))


def occupancy_snapshot_parse(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per lot of each fetched list; the columns of ``raw`` stay."""
    kept = [c for c in raw.columns if c != payload]
    lots = raw.select(*kept, F.explode(F.from_json(payload, "array<map<string,string>>")).alias("lot"))
    return lots.select(
        *kept,
        _field("parking_lot_id").cast("int").alias("parking_lot_id"),
        *[_field(n).alias(n) for n in _TEXT],
        *[_field(n).cast("double").alias(n) for n in _NUMBER],
        *[_field(n).cast("long").alias(n) for n in _GENERAL],
        *[_or_if_absent(n, 0, "int") for n in _CLASSES],
        _or_if_absent("invalid", False, "boolean"))


def occupancy_rate(snapshots: DataFrame) -> DataFrame:
    """Adds free spaces and the occupied share in percent.

    A total of 0 or NULL, or an unknown occupied count, gives NULL for both.
    """
    total, occupied = F.col("general_total"), F.col("general_occupied")
    return snapshots.select(
        "*",
        F.when(total != 0, total - occupied).alias("free_spaces"),
        F.when(total > 0, occupied / total * 100).alias("occupancy_rate"))


def minute_rows(snapshots: DataFrame) -> DataFrame:
    """Snapshot rows in the layout of the minute table, keyed by lot and whole minute."""
    return snapshots.select(
        F.date_trunc("minute", "fetched_at").alias("minute_timestamp"), "parking_lot_id",
        "free_spaces", F.col("general_occupied").alias("occupied_spaces"),
        F.col("general_total").alias("total_spaces"), "occupancy_rate",
        F.col("name").alias("parking_lot_name"),
        *[c for c in snapshots.columns if c in {"address", "city", "country", *_NUMBER, *_CLASSES}],
        "invalid", "fetched_at", "sequence")
