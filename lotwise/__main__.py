"""Jobs on stored tables; ``--lots`` is a Parquet table with ``parking_lot_id`` and ``total_spaces``.

``prepare --operations DIR --weather DIR --lots FILE --out DIR [--zone ZONE]`` builds the minute, hourly and training
tables. ``transform --minute DIR --weather DIR --hourly DIR --features DIR --as-of TIME`` runs the hourly cycle.
``train --features DIR --out DIR [--trees forest|boosting]`` fits and saves a forecaster. ``forecast --features DIR
--model DIR --lots FILE --name NAME --rows DIR --wide DIR`` stores the next 24 hours of every lot.
"""

from __future__ import annotations

import argparse

from lotwise.operators.models import fit_gradient_boosting, fit_random_forest
from lotwise.plans.forecast import forecast, train_hybrid
from lotwise.plans.online import transform_last_hour
from lotwise.plans.store import load_hybrid, save_hybrid, store_forecast
from lotwise.plans.training import load_operations, load_weather, prepare_training_data
from lotwise.session import build_session, clear_scratch


_ARGUMENTS = {
    "prepare": ["operations", "weather", "lots", "out"],
    "transform": ["minute", "weather", "hourly", "features", "as-of"],
    "train": ["features", "out"],
    "forecast": ["features", "model", "lots", "name", "rows", "wide"],
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="lotwise", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for command, names in _ARGUMENTS.items():
        one = commands.add_parser(command)
        for name in names:
            one.add_argument(f"--{name}", required=True)
        if command == "prepare":
            one.add_argument("--zone", default="UTC")
        if command == "train":
            one.add_argument("--trees", choices=["forest", "boosting"], default="forest")
    args = parser.parse_args()
    spark = build_session(f"lotwise-{args.command}")
    table = spark.read.parquet
    if args.command == "prepare":
        prepare_training_data(load_operations(spark, args.operations, args.zone), load_weather(spark, args.weather),
                              table(args.lots), args.out)
    elif args.command == "transform":
        transform_last_hour(table(args.minute), table(args.weather), args.hourly, args.features, args.as_of)
    elif args.command == "train":
        trees = fit_random_forest if args.trees == "forest" else fit_gradient_boosting
        save_hybrid(spark, train_hybrid(table(args.features).drop("date"), None, trees), args.out)
    else:
        rows, wide, _ = forecast(table(args.features).drop("date"), load_hybrid(spark, args.model), table(args.lots), args.name)
        store_forecast(rows, wide, args.rows, args.wide)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
