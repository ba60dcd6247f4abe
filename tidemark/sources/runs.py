"""A log of runs as an append-only table (run_id, parent_run_id, name, kind, key, value)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import append_rows, read_rows

SCHEMA = "run_id string, parent_run_id string, name string, kind string, key string, value string"


@dataclass
class RunLog:
    """Collects what one run reports and appends it when the run ends."""

    spark: SparkSession
    path: str
    name: str
    parent: RunLog | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows: list[tuple] = field(default_factory=list)

    def nested(self, name: str) -> RunLog:
        return RunLog(self.spark, self.path, name, self)

    def log_params(self, values: Mapping) -> None:
        self._add("param", values)

    def log_metrics(self, values: Mapping) -> None:
        self._add("metric", values)

    def set_tags(self, values: Mapping) -> None:
        self._add("tag", values)

    def log_dict(self, value: Mapping, key: str) -> None:
        self._add("dict", {key: json.dumps(value)})

    def end(self) -> None:
        append_rows(self.spark.createDataFrame(self.rows, SCHEMA), self.path)
        self.rows = []

    def _add(self, kind: str, values: Mapping) -> None:
        parent = self.parent.run_id if self.parent else None
        self.rows += [
            (self.run_id, parent, self.name, kind, str(k), None if v is None else str(v))
            for k, v in values.items()
        ]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, SCHEMA)


def run_values(runs: DataFrame, run_id: str, kinds=("param", "tag")) -> dict[str, str]:
    rows = runs.filter((F.col("run_id") == run_id) & F.col("kind").isin(*kinds))
    return {row.key: row.value for row in rows.select("key", "value").collect()}


def metrics_report(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run, one column per metric."""
    return (
        runs.filter((F.col("kind") == "metric") & F.col("key").isin(*metrics))
        .groupBy("run_id", "name")
        .agg(
            *[
                F.max(F.when(F.col("key") == m, F.col("value").try_cast("double"))).alias(m)
                for m in metrics
            ]
        )
    )
