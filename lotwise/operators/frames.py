"""Window frames over long histories.

A window partitioned by lot alone puts a lot's whole history into one task. Here a
history is cut into fixed slots and each slot is handed the few neighbouring rows
its frames reach, so the largest task is one slot of one lot whatever the lot's share
of the table. The results equal those of the uncut window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from lotwise.functions.clock import DAY, seconds_floor
from lotwise.schemas import LOT

Build = Callable[[WindowSpec], dict[str, Column]]

SLOT_SECONDS = 30 * DAY
SLOT_ROWS = 1000


def copied_to_slots(df: DataFrame, position: Column, slot: int, before: int, after: int) -> DataFrame:
    """Copies each row into its home slot and into the slots whose frames reach it."""
    home = F.floor(position / slot).cast("long")
    first = F.floor((position - after) / slot).cast("long")
    last = F.floor((position + before) / slot).cast("long")
    return df.select("*", home.alias("_home"), F.explode(F.sequence(first, last)).alias("_slot"))


def _apply(spread: DataFrame, keys: list[str], order: list[Column], build: Build) -> DataFrame:
    window = Window.partitionBy(*keys, "_slot").orderBy(*order)
    added = build(window)
    kept = [c for c in spread.columns if c not in added]
    return (spread.select(*kept, *[c.alias(name) for name, c in added.items()])
            .where("_slot = _home").drop("_slot", "_home"))


def over_time(df: DataFrame, ts: str, build: Build, before: int = 0, after: int = 0,
              keys: tuple[str, ...] = (LOT,), slot: int = SLOT_SECONDS) -> DataFrame:
    """Window columns whose frames reach at most ``before``/``after`` seconds.

    The window is ordered by microseconds, so range frames are given in microseconds.
    """
    spread = copied_to_slots(df, F.unix_seconds(ts), slot, before, after)
    return _apply(spread, list(keys), [F.unix_micros(ts)], build)


def numbered(df: DataFrame, ts: str, keys: tuple[str, ...] = (LOT,), name: str = "_row",
             slot: int = SLOT_SECONDS, total: str | None = None) -> DataFrame:
    """Adds the 1-based position of each row in its lot's history, and the lot's row count as ``total``.

    Rows are numbered inside time slots; the row counts of the earlier slots, one small
    row per slot, give the offset.
    """
    keys = list(keys)
    cut = df.withColumn("_cut", seconds_floor(ts, slot))
    past = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.sum("_n").over(Window.partitionBy(*keys)).alias(total)] if total else []
    offsets = (cut.groupBy(*keys, "_cut").agg(F.count("*").alias("_n"))
               .select(*keys, "_cut", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_offset"), *totals))
    inside = F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy(ts))
    return (cut.withColumn("_inside", inside).join(offsets, [*keys, "_cut"])
            .withColumn(name, F.col("_inside") + F.col("_offset"))
            .select(*df.columns, name, *([total] if total else [])))


def over_rows(df: DataFrame, ts: str, build: Build, before: int = 0, after: int = 0,
              keys: tuple[str, ...] = (LOT,), slot: int = SLOT_ROWS, keep_row: bool = False,
              total: str | None = None) -> DataFrame:
    """Window columns whose frames reach at most ``before``/``after`` rows."""
    spread = copied_to_slots(numbered(df, ts, keys, total=total), F.col("_row"), slot, before, after)
    result = _apply(spread, list(keys), [F.col("_row")], build)
    return result if keep_row else result.drop("_row")


def carried(df: DataFrame, ts: str, columns: list[str], keys: tuple[str, ...] = (LOT,),
            slot: int = SLOT_SECONDS) -> DataFrame:
    """Adds ``_back_c``/``_ahead_c``: nearest non-null value at or before / after each row.

    The search is unbounded, so slots exchange their last and first non-null values
    through a summary of one row per slot.
    """
    keys = list(keys)
    cut = df.withColumn("_cut", seconds_floor(ts, slot))
    seen = {c: F.when(F.col(c).isNotNull(), F.col(ts)) for c in columns}
    summary = cut.groupBy(*keys, "_cut").agg(
        *[F.max_by(c, seen[c]).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, seen[c]).alias(f"_first_{c}") for c in columns])
    # Looking ahead runs as looking back in descending order: a frame that only grows is
    # kept up row by row, while one that shrinks would be recomputed for every row.
    slots = Window.partitionBy(*keys)
    earlier = slots.orderBy(F.col("_cut")).rowsBetween(Window.unboundedPreceding, -1)
    later = slots.orderBy(F.col("_cut").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys, "_cut",
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns],
        *[F.last(f"_first_{c}", ignorenulls=True).over(later).alias(f"_out_{c}") for c in columns])
    rows = Window.partitionBy(*keys, "_cut")
    back = rows.orderBy(F.col(ts)).rowsBetween(Window.unboundedPreceding, 0)
    ahead = rows.orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, 0)
    near = cut.select(
        "*",
        *[F.last(c, ignorenulls=True).over(back).alias(f"_b_{c}") for c in columns],
        *[F.last(c, ignorenulls=True).over(ahead).alias(f"_a_{c}") for c in columns])
    joined = near.join(summary, [*keys, "_cut"])
    return joined.select(
        *df.columns,
        *[F.coalesce(f"_b_{c}", f"_in_{c}").alias(f"_back_{c}") for c in columns],
        *[F.coalesce(f"_a_{c}", f"_out_{c}").alias(f"_ahead_{c}") for c in columns])


def join_per_lot(rows: DataFrame, per_lot: DataFrame, ts: str) -> DataFrame:
    """Left join of one row per lot to a large table, never shuffling by lot alone.

    The small side is repeated per slot in which a lot has rows, and the join runs on (lot, slot).
    """
    slot = seconds_floor(ts, SLOT_SECONDS)
    slots = rows.select(F.col(LOT).alias("_lot"), slot.alias("_cut")).distinct()
    repeated = per_lot.join(slots, F.col(LOT) == F.col("_lot")).drop("_lot")
    return rows.withColumn("_cut", slot).join(repeated, [LOT, "_cut"], "left").drop("_cut")


def spread_out(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions rows whose work is larger than their size.

    Adaptive execution sizes partitions by the bytes that enter them and would put rows
    that are about to be expanded or computed on into few tasks; an explicit count keeps
    the session's full shuffle parallelism.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
