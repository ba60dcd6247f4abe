"""Versioned models: a folder per version and a table of versions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import append_rows, claim, path_exists, read_rows

SCHEMA = (
    "name string, version string, uri string, run_id string, tags map<string,string>, "
    "created_at timestamp, input_schema string"
)


@dataclass
class LoadedModel:
    model: PipelineModel
    name: str
    version: str
    uri: str
    run_id: str | None


def latest_versions(models: DataFrame) -> DataFrame:
    """Per name the version with the largest number; versions are text."""
    number = F.col("version").cast("int")
    return models.groupBy("name").agg(
        F.max_by("version", number).alias("version"),
        F.max_by("uri", number).alias("uri"),
        F.max_by("run_id", number).alias("run_id"),
    )


def register_model(
    spark: SparkSession,
    base: str,
    model: PipelineModel,
    name: str,
    *,
    run_id: str | None = None,
    tags: Mapping[str, str] | None = None,
    example: DataFrame | None = None,
) -> str:
    """Saves the model as the next version and adds it to the table; returns the version.

    A version is claimed by creating a file that was not there; who comes second takes the next one.
    The table names a version only after its model is complete, so a save that breaks off leaves a
    gap in the numbers and no entry. The example's schema is kept in the table and its first row
    beside the model.
    """
    known = _table(spark, base)
    last = 0
    if known is not None:
        row = latest_versions(known.filter(F.col("name") == name)).first()
        last = int(row["version"]) if row else 0
    while not claim(spark, f"{base}/claims/{name}/{last + 1}"):
        last += 1
    version = str(last + 1)
    uri = f"{base}/{name}/version={version}"
    model.write().save(uri)
    schema = None
    if example is not None:
        schema = example.schema.json()
        example.limit(1).write.json(f"{uri}/input_example")
    entry = [(name, version, uri, run_id, dict(tags or {}), None, schema)]
    rows = spark.createDataFrame(entry, SCHEMA).withColumn("created_at", F.current_timestamp())
    append_rows(rows, f"{base}/models")
    return version


def load_latest(spark: SparkSession, base: str, name: str) -> LoadedModel:
    known = _table(spark, base)
    row = None
    if known is not None:
        row = latest_versions(known.filter(F.col("name") == name)).first()
    if row is None:
        raise ValueError(f"No version of model {name!r} in {base}.")
    return LoadedModel(PipelineModel.load(row.uri), name, row.version, row.uri, row.run_id)


def _table(spark: SparkSession, base: str) -> DataFrame | None:
    path = f"{base}/models"
    return read_rows(spark, path, SCHEMA) if path_exists(spark, path) else None
