"""Sensor stays: landed CSV files, validity and timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lotwise.schemas import OPERATIONS


#: Where a line was read: file, block of the file, place in the task that reads the block.
PLACE = ["_file", "_block", "_line"]


def operations_csv_scan(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """Semicolon files with a header; only the first five fields count.

    Lines with fewer than five fields are skipped. A field that is not an integer
    stops the job instead of silently losing the stay. ``place`` adds the columns ``PLACE``.
    """
    names = OPERATIONS.fieldNames()
    text = ", ".join(f"{n} string" for n in names) + ", _malformed string"
    rows = (spark.read.schema(text)
            .option("sep", ";").option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
            .option("columnPruning", False)  # a pruned line would not show that it is short
            .csv(path))
    if place:
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                           F.monotonically_increasing_id().alias("_line"))
    complete = F.col("_malformed").isNull() | (F.size(F.split("_malformed", ";")) >= len(names))
    return rows.where(complete).select(*[
        F.coalesce(F.trim(f.name).cast(f.dataType),
                   F.raise_error(F.lit(f"{f.name} is empty")).cast(f.dataType)).alias(f.name)
        for f in OPERATIONS.fields], *(PLACE if place else []))


def operations_valid_intervals(ops: DataFrame) -> DataFrame:
    """Drops stays that end no later than they begin."""
    return ops.where("arrival_unix_seconds < departure_unix_seconds")


def operations_epoch_to_timestamp(ops: DataFrame, zone: str = "UTC") -> DataFrame:
    """Adds ``arrival``/``departure`` timestamps in ``zone``; the epochs stay."""
    def local(name: str):
        ts = F.timestamp_seconds(name)
        return ts if zone == "UTC" else F.from_utc_timestamp(ts, zone)
    return ops.select("*", local("arrival_unix_seconds").alias("arrival"),
                      local("departure_unix_seconds").alias("departure"))
