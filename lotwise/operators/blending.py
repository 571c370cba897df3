"""Two forecasts into one, its limits, its stored forms and its quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.functions.clock import plus_hours
from lotwise.schemas import BLEND_WEIGHTS, CONFIDENCE, DEFAULT_CAPACITY, HORIZON_HOURS, LOT

_KEY = [LOT, "origin", "horizon"]


def blend_weights(spark: SparkSession, weights: dict[int, list[float]] | None = None) -> DataFrame:
    """Weights of the first model as (lot, horizon, alpha)."""
    weights = BLEND_WEIGHTS if weights is None else weights
    rows = [(lot, values) for lot, values in weights.items()]
    return (spark.createDataFrame(rows, f"{LOT} int, alphas array<double>")
            .select(LOT, F.posexplode("alphas").alias("_i", "alpha"))
            .select(LOT, (F.col("_i") + 1).alias("horizon"), "alpha"))


def blend_predictions(a: DataFrame, b: DataFrame, alpha: DataFrame) -> DataFrame:
    """alpha * A + (1 - alpha) * B for every lot, origin and horizon that both forecast.

    ``unscored_lots`` names the lots that are left out, and why.
    """
    pair = a.select(*_KEY, F.col("prediction").alias("_a")).join(
        b.select(*_KEY, F.col("prediction").alias("_b")), _KEY)
    return (pair.join(alpha, [LOT, "horizon"])
            .select(*_KEY, (F.col("alpha") * F.col("_a") + (1 - F.col("alpha")) * F.col("_b")).alias("prediction")))


def unscored_lots(lots: DataFrame, **parts: DataFrame) -> DataFrame:
    """(lot, reason) of each of ``lots`` that one of the named frames does not hold; the first missing one is the reason."""
    out, missing = lots.select(LOT).distinct(), []
    for name, part in parts.items():
        out = out.join(part.select(LOT).distinct().withColumn(f"_{name}", F.lit(True)), LOT, "left")
        missing.append(F.when(F.col(f"_{name}").isNull(), F.lit(f"no {name}")))
    return out.select(LOT, F.coalesce(*missing).alias("reason")).where("reason is not null")


def fit_alpha(a: DataFrame, b: DataFrame, actual: DataFrame, step: float = 0.05) -> DataFrame:
    """The weight on a regular grid with the smallest squared error per lot and horizon.

    The error is a parabola in alpha, so three sums per lot and horizon give the error
    of every grid point; the rows are never multiplied by the grid. Errors are compared
    to six decimals and the smallest alpha wins a tie.
    """
    rows = (a.select(*_KEY, F.col("prediction").alias("_a"))
            .join(b.select(*_KEY, F.col("prediction").alias("_b")), _KEY)
            .join(actual.select(*_KEY, "actual"), _KEY)
            .select(LOT, "horizon", (F.col("_a") - F.col("_b")).alias("_d"),
                    (F.col("_b") - F.col("actual")).alias("_e")))
    sums = rows.groupBy(LOT, "horizon").agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_dd"), F.sum(F.col("_d") * F.col("_e")).alias("_de"),
        F.sum(F.col("_e") * F.col("_e")).alias("_ee"), F.count("*").alias("n_samples"))
    points = round(1 / step)
    grid = F.array(*[F.lit(i / points) for i in range(points + 1)])
    scored = F.transform(grid, lambda x: F.struct(
        F.round(x * x * F.col("_dd") + 2 * x * F.col("_de") + F.col("_ee"), 6).alias("sse"), x.alias("alpha")))
    return (sums.withColumn("_best", F.array_min(scored))
            .select(LOT, "horizon", F.col("_best.alpha").alias("alpha"),
                    F.col("_best.sse").alias("sse"), "n_samples"))


def constrain_predictions(pred: DataFrame, lots: DataFrame, rule: str) -> DataFrame:
    """Adds ``predicted_free_spaces`` by one of three rules.

    ``baseline`` rounds half to even and cuts below 0; ``hybrid`` clips to the capacity and
    truncates; ``dashboard`` only clips, an unknown capacity counting as the default.
    """
    value = F.col("prediction")
    if rule == "baseline":
        return pred.withColumn("predicted_free_spaces", F.greatest(F.lit(0), F.bround(value, 0).cast("int")))
    capacity = F.col("_capacity")
    if rule == "hybrid":
        limited = F.when(capacity.isNull(), F.greatest(value, F.lit(0.0))).otherwise(
            F.least(F.greatest(value, F.lit(0.0)), capacity)).cast("int")
    elif rule == "dashboard":
        limited = F.greatest(F.lit(0.0), F.least(value, F.coalesce(capacity, F.lit(float(DEFAULT_CAPACITY)))))
    else:
        raise ValueError(f"unknown rule {rule}")
    sizes = lots.select(LOT, F.col("total_spaces").cast("double").alias("_capacity"))
    return pred.join(sizes, LOT, "left").withColumn("predicted_free_spaces", limited).drop("_capacity")


def prediction_rows(pred: DataFrame, made_at: Column, model_name: str) -> DataFrame:
    """One stored row per horizon; the target is the last known hour plus the horizon."""
    return pred.select(
        made_at.alias("prediction_made_at"),
        plus_hours(F.col("origin"), F.col("horizon")).alias("target_hour"), LOT,
        F.lit(model_name).alias("model_name"), F.col("horizon").alias("hours_ahead"),
        F.col("predicted_free_spaces").cast("int").alias("predicted_free_spaces"))


def confidence(model_name: str | Column = "model_name") -> Column:
    name = F.col(model_name) if isinstance(model_name, str) else model_name
    return F.when(F.lower(name).contains("hybrid"), CONFIDENCE["hybrid"]).otherwise(CONFIDENCE["baseline"])


def prediction_wide(rows: DataFrame) -> DataFrame:
    """One row per forecast: ``hour_1``..``hour_24``, the array by horizon, a constant confidence."""
    key = [LOT, F.col("prediction_made_at").alias("prediction_timestamp"), "model_name"]
    ordered = F.sort_array(F.collect_list(F.struct("hours_ahead", "predicted_free_spaces")))
    hours = [F.max(F.when(F.col("hours_ahead") == h, F.col("predicted_free_spaces"))).alias(f"hour_{h}")
             for h in range(1, HORIZON_HOURS + 1)]
    return (rows.groupBy(*key).agg(ordered.alias("_o"), *hours)
            .select(LOT, "prediction_timestamp", "model_name",
                    F.transform("_o", lambda x: x["predicted_free_spaces"]).alias("predicted_free_spaces"),
                    *[f"hour_{h}" for h in range(1, HORIZON_HOURS + 1)],
                    confidence().alias("confidence_score")))


def prediction_summary(rows: DataFrame, alpha: DataFrame, hourly: DataFrame) -> DataFrame:
    """Smallest, largest and mean forecast, mean weight and last known value of each forecast."""
    weights = alpha.groupBy(LOT).agg(F.avg("alpha").alias("mean_alpha"))
    batches = rows.groupBy(LOT, "prediction_made_at", "model_name").agg(
        F.min("predicted_free_spaces").alias("min_predicted"), F.max("predicted_free_spaces").alias("max_predicted"),
        F.avg("predicted_free_spaces").alias("mean_predicted"),
        F.min(plus_hours(F.col("target_hour"), -F.col("hours_ahead"))).alias("last_known_hour"))
    known = hourly.select(LOT, F.col("hour_timestamp").alias("last_known_hour"),
                          F.col("avg_free_spaces").alias("last_known_value"))
    return batches.join(weights, LOT, "left").join(known, [LOT, "last_known_hour"], "left")


def regression_metrics(pred: DataFrame, keys: list[str]) -> DataFrame:
    """mse, rmse, mae, r2 and mape per group; mape leaves out rows whose actual is 0."""
    error = F.col("prediction") - F.col("actual")
    share = F.when(F.col("actual") != 0, F.abs(error) / F.abs("actual") * 100)
    sums = pred.where(F.col("prediction").isNotNull() & F.col("actual").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n_samples"), F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
        F.var_pop("actual").alias("_variance"), F.avg(share).alias("mape"))
    r2 = F.when(F.col("_variance") > 0, 1 - F.col("mse") / F.col("_variance"))
    return sums.select(*keys, "n_samples", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"), "mape")
