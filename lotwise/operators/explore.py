"""Exploratory statistics of the training table.

Group columns are calendar fields and categories, so results are small while a group may
hold most of the rows: every aggregate combines map-side, and quantiles are ranked in
buckets (``quantiles``) instead of gathering a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lotwise.operators.categories import weekday_labels
from lotwise.operators.quantiles import exact_quantiles, quantile_columns, ranked, value_counts
from lotwise.schemas import LOT, TEMPERATURE_LABELS

VALUE = "avg_free_spaces"
WEATHER = ["temperature_2m", "relative_humidity_2m", "precipitation"]
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _long(df: DataFrame, columns: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """One row per (column, non-null value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])
    return df.select(F.inline(pairs)).where(F.col(value).isNotNull())


def hour_pattern(df: DataFrame) -> DataFrame:
    return df.groupBy("hour_of_day").agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.min(VALUE).alias("min_free_spaces"),
        F.max(VALUE).alias("max_free_spaces"), F.count("*").alias("n_rows"))


def hour_iqr(df: DataFrame) -> DataFrame:
    """Mean and quartiles by hour of day, both from the counted values."""
    keys = ["hour_of_day"]
    counts = ranked(value_counts(df.dropna(subset=keys), keys, VALUE), keys)
    mean = F.sum(F.col("_value") * F.col("_count")) / F.sum("_count")
    return counts.groupBy(*keys).agg(mean.alias("mean_free_spaces"),
                                     *quantile_columns({"q25": 0.25, "q75": 0.75}))


def hour_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("hour_of_day").agg(
        F.avg(VALUE).alias("avg_mean"), F.stddev_samp(VALUE).alias("avg_std"), F.min(VALUE).alias("avg_min"),
        F.max(VALUE).alias("avg_max"), F.avg("min_free_spaces").alias("min_avg"),
        F.avg("max_free_spaces").alias("max_avg"))


def day_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("day_of_week", "weekday_name").agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.stddev_samp(VALUE).alias("std_free_spaces"),
        F.count(VALUE).alias("sample_count"))


def _by_weather_means(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.stddev_samp(VALUE).alias("std_free_spaces"),
        F.avg("temperature_2m").alias("mean_temperature"), F.avg("precipitation").alias("mean_precipitation"))


def day_type_stats(df: DataFrame) -> DataFrame:
    return _by_weather_means(df, "day_type")


def month_stats(df: DataFrame) -> DataFrame:
    return _by_weather_means(df, "month_number", "month_name")


def month_trend(df: DataFrame) -> DataFrame:
    return df.groupBy(F.date_trunc("month", "hour_timestamp").alias("month_start")).agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.avg("temperature_2m").alias("mean_temperature"),
        F.avg("precipitation").alias("mean_precipitation"))


def weather_describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max of each column, one row per column."""
    long = _long(df, columns or WEATHER)
    basics = long.groupBy("column_name").agg(
        F.count("*").alias("n_values"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return basics.join(exact_quantiles(long, ["column_name"], "value", QUARTILES), "column_name")


def category_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per value of each category column; the distinct values are its rows."""
    columns = columns or ["day_type", "time_period", "temperature_category", "precipitation_category"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"))
                      for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "category").agg(F.count("*").alias("n_rows"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, time span in whole days and missing values per column, one row."""
    ts = F.col("hour_timestamp")
    span = F.floor((F.unix_seconds(F.max(ts)) - F.unix_seconds(F.min(ts))) / 86400).cast("long")
    return df.agg(F.count("*").alias("n_rows"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"),
                  span.alias("days_covered"),
                  *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns])


def histogram(df: DataFrame, bins: dict[str, int] | None = None) -> DataFrame:
    """Equal-width bins from smallest to largest value of each column; the last bin is closed.

    Precipitation counts values above 0 only. The bounds come as one row per column, a
    number fixed by the caller, and are broadcast.
    """
    bins = bins or {"temperature_2m": 30, "relative_humidity_2m": 30, "precipitation": 20}
    dry = (F.col("column_name") != "precipitation") | (F.col("value") > 0)
    long = _long(df, list(bins)).where(dry)
    bounds = long.groupBy("column_name").agg(F.min("value").alias("_low"), F.max("value").alias("_high"))
    n = F.create_map(*[F.lit(x) for pair in bins.items() for x in pair])[F.col("column_name")]
    width = F.col("_high") - F.col("_low")
    place = F.least(n, F.floor((F.col("value") - F.col("_low")) * n / width).cast("int") + 1)
    binned = long.join(F.broadcast(bounds), "column_name").select(
        "column_name", F.when(width > 0, place).otherwise(1).alias("bin"), "_low", "_high")
    return binned.groupBy("column_name", "bin").agg(
        F.count("*").alias("n_rows"), F.first("_low").alias("lowest"), F.first("_high").alias("highest"))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair over rows where both are known."""
    columns = columns or [VALUE, *WEATHER]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                      F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`").alias("correlation"))
             for a in columns for b in columns]
    return one.select(F.inline(F.array(*cells)))


def pearson_test(df: DataFrame, columns: list[str] | None = None, level: float = 0.05) -> DataFrame:
    """r, t and two-sided p of the free spaces against each column, all from one aggregation.

    Where r is undefined (a constant column, fewer than three pairs) r, t, p and the verdict are NULL.
    """
    columns = columns or WEATHER
    value = F.col(VALUE).cast("double")
    sums = []
    for c in columns:
        x = F.when(value.isNotNull(), F.col(c).cast("double"))
        y = F.when(F.col(c).isNotNull(), value)
        varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        sums += [F.count(x).alias(f"n_{c}"), varies.alias(f"varies_{c}"), F.covar_pop(x, y).alias(f"xy_{c}"),
                 F.var_pop(x).alias(f"xx_{c}"), F.var_pop(y).alias(f"yy_{c}")]
    one = df.agg(*sums).first()
    rows = []
    for c in columns:
        n, r, t, p = one[f"n_{c}"], None, None, None
        if one[f"varies_{c}"] and n > 2:
            r = max(-1.0, min(1.0, one[f"xy_{c}"] / math.sqrt(one[f"xx_{c}"] * one[f"yy_{c}"])))
            t = math.copysign(math.inf, r) if abs(r) >= 1 else r * math.sqrt((n - 2) / (1 - r * r))
            p = 0.0 if math.isinf(t) else _two_sided_p(t, n - 2)
        rows.append((c, r, t, p, int(n), None if p is None else p < level))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, r double, t_value double, p_value double, n_values long, significant boolean")


def _two_sided_p(t: float, freedom: int) -> float:
    """Student's two-sided p: Simpson's rule over the angle atan(t / sqrt(freedom)), where the density is cos^(freedom - 1)."""
    top, parts = math.pi / 2, 4000

    def area(a: float, b: float) -> float:
        step = (b - a) / parts
        height = [max(math.cos(a + k * step), 0.0) ** (freedom - 1) for k in range(parts + 1)]
        return step / 3 * (height[0] + height[-1] + 4 * sum(height[1:-1:2]) + 2 * sum(height[2:-1:2]))

    width = min(top, 12 / math.sqrt(freedom))   # beyond it lies less than e**-70 of the mass
    angle = math.atan(abs(t) / math.sqrt(freedom))
    return 0.0 if angle >= width else area(angle, min(width, top)) / area(0.0, min(width, top))


def weather_impact(df: DataFrame) -> DataFrame:
    """Free spaces by temperature and by precipitation category, from one scan."""
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).alias("category"))
                      for k in ("temperature_category", "precipitation_category")])
    return df.select(VALUE, F.inline(pairs)).groupBy("dimension", "category").agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.stddev_samp(VALUE).alias("std_free_spaces"),
        F.count(VALUE).alias("n_rows"))


def hour_temperature_pivot(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Mean by hour, one column per temperature category of the fixed list."""
    return df.groupBy("hour_of_day").pivot("temperature_category", labels or TEMPERATURE_LABELS).agg(F.avg(VALUE))


def weather_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("time_period", "day_type", "temperature_category").agg(
        F.avg(VALUE).alias("mean_free_spaces"), F.avg("temperature_2m").alias("mean_temperature"),
        F.avg("precipitation").alias("mean_precipitation"))


def conditional_means(df: DataFrame) -> DataFrame:
    """Cold against warm, dry against rain, peak against the other hours, one row."""
    def mean(condition: Column) -> Column:
        return F.avg(F.when(condition, F.col(VALUE)))
    temperature, dry = F.col("temperature_category"), F.col("precipitation_category") == "No Rain"
    peak = F.col("time_period").isin("Morning Rush", "Evening Rush")
    pairs = {"cold": mean(temperature == "Cold"), "warm": mean(temperature == "Warm"), "dry": mean(dry),
             "rain": mean(~dry), "peak": mean(peak), "off_peak": mean(~peak)}
    means = df.agg(*[c.alias(f"mean_{name}") for name, c in pairs.items()])
    return means.select("*", (F.col("mean_cold") - F.col("mean_warm")).alias("cold_minus_warm"),
                        (F.col("mean_dry") - F.col("mean_rain")).alias("dry_minus_rain"),
                        (F.col("mean_peak") - F.col("mean_off_peak")).alias("peak_minus_off_peak"))


def time_sample(df: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """A repeatable sample of up to ``n`` rows, in time order, with a rain flag.

    Rows are drawn by the hash of their key, so the sample does not depend on file order
    or partitioning. Each task keeps ``n`` candidates.
    """
    draw = F.md5(F.concat_ws("|", F.col(LOT).cast("string"),
                             F.unix_seconds("hour_timestamp").cast("string"), F.lit(str(seed))))
    return (df.withColumn("_draw", draw).orderBy("_draw", LOT, "hour_timestamp").limit(n).drop("_draw")
            .withColumn("rainy", F.coalesce(F.col("precipitation") > 0, F.lit(False)))
            .orderBy("hour_timestamp", LOT))


def box_stats(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outliers by five groupings.

    All groupings are ranked together on counted values; whiskers and outliers come from
    the same counts, so the rows themselves are read once.
    """
    labelled = weekday_labels(df)
    groupings = {
        "month": F.col("month_name"), "temperature": F.col("temperature_category"),
        "precipitation": F.col("precipitation_category"), "weekday": F.col("weekday_label"),
        "hour_by_weekday_type": F.concat_ws(" ", F.lpad(F.col("hour_of_day").cast("string"), 2, "0"), "weekday_type"),
    }
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), c.alias("category")) for d, c in groupings.items()])
    keys = ["dimension", "category"]
    long = labelled.select(F.col(value).cast("double").alias("_v"), F.inline(pairs)).dropna(subset=keys)
    counts = value_counts(long, keys, "_v")
    boxes = ranked(counts, keys).groupBy(*keys).agg(F.sum("_count").alias("n_rows"), *quantile_columns(QUARTILES))
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    low, high = F.col("q25") - reach, F.col("q75") + reach
    inside = (F.col("_value") >= low) & (F.col("_value") <= high)
    judged = counts.join(boxes, keys)
    return judged.groupBy(*keys, "n_rows", *QUARTILES).agg(
        F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_count"))), F.lit(0)).alias("n_outliers"))


def clean_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or ["weekday_name", "month_name", "temperature_category", "precipitation_category"]
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def period_columns(df: DataFrame) -> DataFrame:
    """Day, first day of the month and Monday of the week of each hour."""
    ts = F.col("hour_timestamp")
    return df.withColumns({
        "date": F.date_trunc("day", ts), "month_start": F.date_trunc("month", ts),
        "week_start": F.date_trunc("week", ts)})
