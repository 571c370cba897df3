"""Window features of the hourly series.

Time-based features (range frames) tolerate missing hours; row-based ones count rows and
mean hours only on a series completed with ``hour_series_complete``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from lotwise.functions.clock import DAY, HOUR
from lotwise.operators.frames import carried, join_per_lot, over_rows, over_time
from lotwise.schemas import LAG_ROWS, LOT, MOVING_AVERAGE_ROWS, TREND_ROWS, WEEKEND_DAYS

TS = "hour_timestamp"
_MICROS = 1_000_000
# (t - 24 h, t]: the lower end is open, so the frame starts one microsecond later.
_LAST_24H = -(DAY * _MICROS - 1)


def _last_24h(w: WindowSpec) -> WindowSpec:
    return w.rangeBetween(_LAST_24H, 0)


def _step(w: WindowSpec, value: str) -> Column:
    """Value minus the value exactly one hour earlier, NULL if that hour is absent."""
    adjacent = F.unix_micros(F.lag(TS).over(w)) == F.unix_micros(TS) - HOUR * _MICROS
    return F.when(adjacent, F.col(value) - F.lag(value).over(w))


def rolling_avg_24h(hourly: DataFrame, value: str = "avg_free_spaces") -> DataFrame:
    return over_time(hourly, TS, lambda w: {
        f"{value}_rolling_24h": F.avg(value).over(_last_24h(w))}, before=DAY)


def rolling_std_24h(hourly: DataFrame, value: str = "avg_free_spaces") -> DataFrame:
    """Sample standard deviation; NULL for a single row."""
    return over_time(hourly, TS, lambda w: {
        f"{value}_std_24h": F.stddev_samp(value).over(_last_24h(w))}, before=DAY)


def diff_1h(hourly: DataFrame, value: str = "avg_free_spaces") -> DataFrame:
    return over_time(hourly, TS, lambda w: {f"{value}_diff_1h": _step(w, value)}, before=HOUR)


def temperature_diff_1h(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Temperature change of the weather series, attached per hour."""
    step = over_time(weather.select(TS, "temperature_2m"), TS,
                     lambda w: {"temperature_diff_1h": _step(w, "temperature_2m")},
                     before=HOUR, keys=())
    return df.join(step.select(TS, "temperature_diff_1h"), TS, "left")


def online_features(hourly: DataFrame) -> DataFrame:
    """The three per-lot features in one pass over one exchange."""
    value = "avg_free_spaces"
    return over_time(hourly, TS, lambda w: {
        f"{value}_rolling_24h": F.avg(value).over(_last_24h(w)),
        f"{value}_std_24h": F.stddev_samp(value).over(_last_24h(w)),
        f"{value}_diff_1h": _step(w, value)}, before=DAY)


def _rows_back(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def _moving_averages(w: WindowSpec) -> dict[str, Column]:
    return {f"free_spaces_ma_{n}": F.avg("free_spaces").over(_rows_back(w, n)) for n in MOVING_AVERAGE_ROWS}


def _lags(w: WindowSpec) -> dict[str, Column]:
    return {f"{c}_lag_{n}": F.lag(c, n).over(w) for c in ("free_spaces", "occupancy_rate") for n in LAG_ROWS}


def _trends(w: WindowSpec) -> dict[str, Column]:
    return {f"trend_{n}h": F.col("free_spaces") - F.lag("free_spaces", n).over(w) for n in TREND_ROWS}


def moving_averages(df: DataFrame) -> DataFrame:
    """Means of the last 3, 6, 12 and 24 rows, fewer at the start."""
    return over_rows(df, TS, _moving_averages, before=max(MOVING_AVERAGE_ROWS) - 1)


def lag_features(df: DataFrame) -> DataFrame:
    return over_rows(df, TS, _lags, before=max(LAG_ROWS))


def trend_features(df: DataFrame) -> DataFrame:
    return over_rows(df, TS, _trends, before=max(TREND_ROWS))


def hybrid_features(df: DataFrame) -> DataFrame:
    """Moving averages, lags and trends in one pass, plus cyclic time and ``is_weekend`` as 0 or 1."""
    timed = cyclic_time(over_rows(df, TS, lambda w: {**_moving_averages(w), **_lags(w), **_trends(w)},
                                  before=max(LAG_ROWS)))
    return timed.withColumn("is_weekend", F.col("day_of_week").isin(*WEEKEND_DAYS).cast("int"))


def cyclic_time(df: DataFrame) -> DataFrame:
    hour = F.col("hour_of_day") * F.lit(2 * math.pi) / 24
    day = F.col("day_of_week") * F.lit(2 * math.pi) / 7
    return df.withColumns({"hour_sin": F.sin(hour), "hour_cos": F.cos(hour),
                           "day_sin": F.sin(day), "day_cos": F.cos(day)})


def rolling_trend(df: DataFrame, value: str = "avg_free_spaces") -> DataFrame:
    """Weekly and daily row means, given only where enough values are known."""
    def build(w: WindowSpec) -> dict[str, Column]:
        return {name: F.when(F.count(value).over(_rows_back(w, rows)) >= least,
                             F.avg(value).over(_rows_back(w, rows)))
                for name, rows, least in (("rolling_avg_7d", 168, 24), ("rolling_avg_1d", 24, 12))}
    return over_rows(df, TS, build, before=167)


ENGINEERED = ["avg_free_spaces_rolling_24h", "avg_free_spaces_std_24h", "avg_free_spaces_diff_1h",
              "temperature_diff_1h"]


def _with_month(df: DataFrame) -> DataFrame:
    std = ENGINEERED[1]
    return df.withColumns({std: F.coalesce(std, F.lit(0.0)), "month": F.month(TS)})


def feature_fallbacks(df: DataFrame) -> DataFrame:
    """Replaces features that a lot lacks entirely by row-based ones; adds ``month``.

    A NULL standard deviation becomes 0 in any case. Whether a column is empty for a lot
    comes from one small aggregate per lot, not from a window over the lot.
    """
    value = "avg_free_spaces"
    known = df.groupBy(LOT).agg(*[F.max(F.col(c).isNotNull()).alias(f"_has_{c}") for c in ENGINEERED])

    def build(w: WindowSpec) -> dict[str, Column]:
        def step(c: str) -> Column:
            return F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0))
        last = _rows_back(w, 24)
        substitutes = [F.avg(value).over(last), F.stddev_samp(value).over(last), step(value), step("temperature_2m")]
        return {f"_alt_{c}": x for c, x in zip(ENGINEERED, substitutes)}
    rows = join_per_lot(over_rows(df, TS, build, before=23), known, TS)
    filled = {c: F.when(F.col(f"_has_{c}"), F.col(c)).otherwise(F.col(f"_alt_{c}")) for c in ENGINEERED}
    return _with_month(rows.withColumns(filled)).select(
        *df.columns, *([] if "month" in df.columns else ["month"]))


def fill_gaps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Last known value, else the next known one, else 0, along each lot's history."""
    if not columns:
        return df
    near = carried(df, TS, columns)
    filled = {c: F.coalesce(f"_back_{c}", f"_ahead_{c}", F.lit(0).cast(df.schema[c].dataType)) for c in columns}
    return near.withColumns(filled).select(*df.columns)
