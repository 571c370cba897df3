"""Stored tables: scans, writes and the three insert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lotwise.schemas import STORED_TYPES
from lotwise.session import stored


def table_scan(spark: SparkSession, path: str, columns: list[str],
               predicates: list[str] | None = None) -> DataFrame:
    """Column list plus conditions; both reach the Parquet reader."""
    df = spark.read.parquet(path)
    for condition in predicates or []:
        df = df.where(condition)
    return df.select(*columns)


def jdbc_scan(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, **properties: str) -> DataFrame:
    """The same scan from a relational source, read in ``partitions`` key ranges."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties)


def as_stored(df: DataFrame) -> DataFrame:
    """Narrows the columns to the declared decimals of the stored tables."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in STORED_TYPES.items() if c in df.columns})


def materialise(df: DataFrame, path: str, time: str, order: list[str]) -> DataFrame:
    """Writes a stage as Parquet, one folder per day, and returns it read back.

    A rerun replaces the table. ``rebalance`` splits a day that is too large for a task
    and joins small ones; rows are sorted inside files instead of globally.
    """
    dated = df.withColumn("date", F.date_format(time, "yyyy-MM-dd"))
    (dated.hint("rebalance", "date").sortWithinPartitions("date", *order)
     .write.mode("overwrite").partitionBy("date").parquet(path))
    return df.sparkSession.read.schema(dated.schema).parquet(path).drop("date")


def parquet_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def parquet_reload(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def _first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _stored_keys(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the batch that the target already holds.

    A batch is usually far smaller than its table; as the right side of a semi join it
    can be broadcast, and the table is then only scanned, not shuffled.
    """
    return target.select(*keys).join(batch.select(*keys), keys, "left_semi")


def insert_ignore(target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stored rows win over the batch, then the first row of the batch in ``order``."""
    first = _first_per_key(batch, keys, [F.col(c).asc() for c in order])
    if target is None:
        return first
    return target.unionByName(first.join(_stored_keys(target, batch, keys), keys, "left_anti"))


def upsert_latest(target: DataFrame | None, batch: DataFrame, keys: list[str],
                  order: list[str]) -> DataFrame:
    """The last write per key wins; batch rows come after stored rows of equal order."""
    rows = batch.withColumn("_source", F.lit(1))
    if target is not None:
        rows = target.withColumn("_source", F.lit(0)).unionByName(rows)
    newest = [F.col(c).desc() for c in order] + [F.col("_source").desc()]
    return _first_per_key(rows, keys, newest).drop("_source")


def _all_new(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch; reading it fails if a key occurs twice or is already stored."""
    taken = _stored_keys(target, batch, keys).withColumn("_taken", F.lit(True))
    copies = F.count("*").over(Window.partitionBy(*keys))
    message = F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys)))
    clash = F.col("_taken").isNotNull() | (F.col("_copies") > 1)
    return (batch.withColumn("_copies", copies).join(taken, keys, "left")
            .where(F.when(clash, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
            .select(*batch.columns))


def unique_append(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Appends the batch; a key that occurs twice or is already stored stops the job."""
    return target.unionByName(_all_new(target, batch, keys))


def _same_days(path: str, dated: DataFrame) -> DataFrame | None:
    """Stored rows of the days of the batch; None if nothing is stored yet."""
    try:
        current = dated.sparkSession.read.schema(dated.schema).parquet(path)
        return current.join(dated.select("date").distinct(), "date", "left_semi")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def write_append(path: str, batch: DataFrame, keys: list[str], time: str) -> None:
    """``unique_append`` on a stored table: only the batch is written, and nothing of it if a key is taken.

    ``time`` is one of ``keys``, so only the days of the batch are read. One writer at a time.
    """
    dated = batch.withColumn("date", F.date_format(time, "yyyy-MM-dd"))
    current = _same_days(path, dated)
    checked = stored(_all_new(dated.limit(0) if current is None else current, dated, [*keys, "date"]), "append")
    checked.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


def write_upsert(path: str, batch: DataFrame, keys: list[str], order: list[str], time: str) -> None:
    """Last write wins on a stored table, touching only the days of the batch.

    The merged days are first written in full to the scratch folder, so a job that dies
    while replacing them leaves a complete copy behind. One writer at a time.
    """
    dated = batch.withColumn("date", F.date_format(time, "yyyy-MM-dd"))
    merged = stored(upsert_latest(_same_days(path, dated), dated, [*keys, "date"], order), "upsert")
    (merged.hint("rebalance", "date").sortWithinPartitions("date", *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))
