"""One registered query: a Spark result, its shape, and the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lotwise.catalog.oracle import shaped, shaped_sql
from lotwise.plans.fixtures import Views


@dataclass(frozen=True)
class Entry:
    shape: str
    build: Callable[[Views], DataFrame]
    body: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return shaped(self.build(Views(spark, folder)), self.shape)

    def sql(self) -> str | None:
        return None if self.body is None else shaped_sql(self.body, self.shape)
