"""From the feature table to model windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from lotwise.functions.clock import calendar, instant, plus_hours
from lotwise.operators.categories import categories_online, categories_to_model
from lotwise.operators.features import feature_fallbacks, fill_gaps
from lotwise.operators.frames import join_per_lot, over_rows
from lotwise.operators.rollups import hour_series_complete
from lotwise.schemas import (HORIZON_HOURS, HYBRID_FEATURES, LOT, MODEL_FEATURES, MODEL_VOCABULARY,
                             PAST_HOURS)

TS = "hour_timestamp"


def recent_window(df: DataFrame, n: int = 72) -> DataFrame:
    """The last ``n`` rows of each lot; the limit is applied before the shuffle."""
    newest = Window.partitionBy(LOT).orderBy(F.col(TS).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def recent_since(df: DataFrame, as_of: str | datetime | Column, hours: int = 72) -> DataFrame:
    """The time-based form: rows at or after ``as_of`` minus ``hours``."""
    return df.where(F.col(TS) >= plus_hours(instant(as_of), -hours))


def pad_window(df: DataFrame, n: int = PAST_HOURS) -> DataFrame:
    """Exactly ``n`` rows per lot as ``timestep`` 0..n-1; a short history repeats its first row."""
    recent = recent_window(df, n)
    lot = Window.partitionBy(LOT)
    placed = recent.select("*", F.row_number().over(lot.orderBy(TS)).alias("_i"),
                           F.count("*").over(lot).alias("_n"))
    own = (F.lit(n) - F.col("_n") + F.col("_i") - 1).cast("int")
    slots = F.when(F.col("_i") == 1, F.sequence(F.lit(0), own)).otherwise(F.array(own))
    return placed.select(*df.columns, F.explode(slots).alias("timestep"))


def ordinal_encode(df: DataFrame, mapping: dict[str, list[str]] | None = None) -> DataFrame:
    """Label -> its 0-based place in the configured list, as double; unknown labels give NULL."""
    mapping = mapping or MODEL_VOCABULARY
    def code(name: str, labels: list[str]) -> Column:
        place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(name))
        return (F.when(place > 0, place) - 1).cast("double")
    return df.withColumns({name: code(name, labels) for name, labels in mapping.items()})


def model_frame(features: DataFrame) -> DataFrame:
    """Online features as the 20 numeric model inputs, one row for every hour of a lot.

    Hours that are missing between a lot's first and last one are added: their calendar is their own, numbers are
    filled like other gaps, labels follow the filled numbers. ``observed`` tells whether the hour's value was there.
    """
    numeric = [c for c in MODEL_FEATURES if c not in MODEL_VOCABULARY and c != "month"]
    hours = hour_series_complete(features)
    fields = calendar(TS)
    placed = hours.withColumns({c: fields[c] for c in fields if c in hours.columns})
    seen = placed.withColumn("observed", F.col("avg_free_spaces").isNotNull())
    filled = fill_gaps(feature_fallbacks(seen), numeric)
    own = filled.withColumns({f"_own_{c}": F.col(c) for c in MODEL_VOCABULARY})
    labelled = categories_online(own).withColumns({c: F.coalesce(f"_own_{c}", c) for c in MODEL_VOCABULARY})
    coded = ordinal_encode(categories_to_model(labelled))
    return coded.select(LOT, TS, *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES], "observed")


def align_features(df: DataFrame, expected: list[str] | None = None, width: int = 20) -> DataFrame:
    """Expected columns that exist, cut to ``width`` or filled up with zero columns."""
    expected = HYBRID_FEATURES if expected is None else expected
    present = [c for c in expected if c in df.columns][:width]
    missing = [F.lit(0.0).alias(f"missing_feature_{i}") for i in range(width - len(present))]
    return df.select(LOT, TS, *[F.col(c).cast("double").alias(c) for c in present], *missing)


def flatten_window(padded: DataFrame, features: list[str] | None = None) -> DataFrame:
    """One row per lot: ``window`` holds the padded rows' features, timestep by timestep."""
    features = features or MODEL_FEATURES
    step = F.struct("timestep", F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    return (padded.groupBy(LOT).agg(F.max(TS).alias("origin"), F.sort_array(F.collect_list(step)).alias("_s"))
            .select(LOT, "origin", F.flatten(F.transform("_s", lambda s: s["x"])).alias("window")))


def share_of(past: int, horizon: int, train: float, validation: float) -> Column:
    """The split of the row ``_row`` of a lot's ``_rows``, by its place among the lot's possible origins."""
    samples = F.col("_rows") - (past + horizon - 1)
    # Shares in whole thousandths, so that the borders do not depend on binary fractions.
    place = (F.col("_row") - past) * 1000
    return (F.when(place < samples * round(train * 1000) - 999, "train")
            .when(place < samples * round((train + validation) * 1000) - 999, "validation")
            .otherwise("test"))


def supervised_windows(frame: DataFrame, past: int = PAST_HOURS, horizon: int = HORIZON_HOURS,
                       features: list[str] | None = None, target: str = "avg_free_spaces",
                       train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """Samples of ``past`` hours and the next ``horizon`` targets, split by time per lot.

    ``frame`` holds every hour of a lot (``model_frame``). Only full samples whose targets were all ``observed`` are
    kept. The first ``train`` share of a lot's possible origins is for training, the next ``validation`` share for
    validation, the rest for testing.
    """
    features = features or MODEL_FEATURES
    seen = F.col("observed") if "observed" in frame.columns else F.lit(True)
    rows = frame.select(LOT, TS, F.col(target).cast("double").alias("_y"), seen.cast("int").alias("_seen"),
                        F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    sampled = over_rows(rows, TS, lambda w: {
        "window": F.flatten(F.collect_list("_x").over(w.rowsBetween(-(past - 1), 0))),
        "targets": F.collect_list("_y").over(w.rowsBetween(1, horizon)),
        "_known": F.sum("_seen").over(w.rowsBetween(1, horizon))},
        before=past - 1, after=horizon, keep_row=True, total="_rows")
    split = share_of(past, horizon, train, validation)
    full = (F.col("_row") >= past) & (F.col("_known") == horizon)
    return (sampled.where(full)
            .select(LOT, F.col(TS).alias("origin"), split.alias("split"), "window", "targets"))


def fit_minmax(windows: DataFrame) -> DataFrame:
    """Smallest and largest value of every window position per lot, combined map-side."""
    extremes = Summarizer.metrics("min", "max").summary(F.col("_v"))
    return (windows.select(LOT, array_to_vector("window").alias("_v"))
            .groupBy(LOT).agg(extremes.alias("_s"))
            .select(LOT, vector_to_array("_s.min").alias("low"), vector_to_array("_s.max").alias("high")))


def minmax_per_timestep(windows: DataFrame, stats: DataFrame) -> DataFrame:
    """Scales each position with its own range; a constant position becomes 0.

    Positions without a fitted range pass through unscaled.
    """
    factor = F.zip_with("high", "low", lambda h, lo: F.when(h != lo, 1 / (h - lo)).otherwise(F.lit(0.0)))
    ranges = stats.select(LOT, "low", factor.alias("_factor"))
    known = F.size("low")
    moved = F.zip_with(F.slice("window", 1, known), "low", lambda x, lo: x - lo)
    scaled = F.concat(F.zip_with(moved, "_factor", lambda d, f: d * f),
                      F.slice("window", known + 1, F.greatest(F.size("window") - known, F.lit(0))))
    joined = join_per_lot(windows, ranges, "origin")
    return joined.withColumn("window", F.when(F.col("low").isNull(), F.col("window")).otherwise(scaled)) \
        .select(*windows.columns)
