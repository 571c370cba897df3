"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query runs to
the end of its full result (``noop`` sink); one small query warms the session up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lotwise.catalog.inputs import stays
from lotwise.catalog.registry import ENTRIES
from lotwise.catalog.results import scaled_samples, training_hours
from lotwise.operators import lagged, models
from lotwise.plans.fixtures import Views
from lotwise.plans.training import prepare_training_data
from lotwise.session import build_session, scratch_path, stored

HEADLINES = [
    "minute_occupancy", "hourly_rollup", "occupancy_snapshot_parse", "insert_ignore", "upsert_latest",
    "hour_series_complete", "training_join", "weather_left_join", "rolling_avg_24h", "rolling_std_24h", "diff_1h",
    "moving_averages", "feature_fallbacks", "fill_gaps", "supervised_windows", "minmax_per_timestep",
    "blend_predictions", "fit_alpha",
    "regression_metrics", "backfill_actuals", "model_performance", "availability_outlook", "current_status",
    "dashboard_bundle", "hour_iqr", "box_stats", "weather_describe", "correlation_matrix", "stream_minute_feed",
    "stream_hourly_rollup", "stream_feature_refresh",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false"})
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    def finish(name: str) -> None:
        ENTRIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()

    finish("hour_pattern")
    views = Views(spark, folder)
    timed("prepare_training_data", lambda: prepare_training_data(
        stays(views), views.weather, views.lots, scratch_path(spark, "prepared")))
    for name in HEADLINES:
        timed(name, lambda: finish(name))

    # Model steps on stored samples of all lots: 48 hours of 20 inputs, 24 horizons.
    samples: list = []

    def prepare_samples() -> None:
        samples.append(training_hours(views))
        samples.append(scaled_samples(views, samples[0]))
    timed("model_samples", prepare_samples)
    (hours, ranges, _), scaled = samples
    train, rest = scaled.where("split = 'train'"), scaled.where("split <> 'train'")
    fitted: dict = {}
    timed("fit_linear", lambda: fitted.update(linear=stored(lagged.fit_linear_hours(hours, ranges), "model")))
    timed("fit_random_forest", lambda: fitted.update(forest=models.fit_random_forest(train)))
    timed("fit_gradient_boosting", lambda: fitted.update(boosted=models.fit_gradient_boosting(train)))
    for name, model in fitted.items():
        timed(f"predict_{name}", lambda: models.predict_long(model, rest).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
