"""What the dashboard shows, for all lots in one pass over each table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from lotwise.operators import monitoring, serving


def lot_documents(minute: DataFrame, predictions: DataFrame, training: DataFrame, lots: DataFrame) -> DataFrame:
    """Status, forecast and history of each lot as one JSON document."""
    return serving.dashboard_bundle(
        serving.current_status(minute, lots), serving.availability_outlook(predictions, lots),
        serving.historical_window(training))


def forecast_quality(predictions: DataFrame, hourly: DataFrame, as_of: str | datetime | Column) -> dict[str, DataFrame]:
    """Overall errors, errors per horizon and the newest errors after filling in the actuals."""
    filled = monitoring.backfill_actuals(predictions, hourly, as_of)
    return {"overall": monitoring.model_performance(filled),
            "by_horizon": monitoring.performance_by_horizon(filled),
            "recent": monitoring.recent_errors(filled, as_of)}
