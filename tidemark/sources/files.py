"""Datasets as Parquet or CSV: checked before the read, partitioned by series on write."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_columns
from tidemark.operators.ordered import SERIES, TIME

FORMATS = ("parquet", "csv")


def dataset_path(config: Mapping[str, object]) -> str:
    """``path``, or else ``path`` inside ``save``."""
    save = config.get("save")
    nested = save.get("path") if isinstance(save, Mapping) else None
    path = config.get("path") or nested
    if not path:
        raise ValueError("The configuration names neither 'path' nor 'save.path'.")
    return str(path)


def load_dataset(
    spark: SparkSession, config: Mapping[str, object], schema: T.StructType | str | None = None
) -> DataFrame:
    """Reads what ``save_dataset`` wrote, or a table like it; the suffix of the path names the format.

    ``config["time_column"]`` is the name that the time column has in the file, ``ts`` if not given;
    a file of one series, without a column for it, gets ``config["series"]`` as its name, and rows
    without an ordinal take the time as theirs. Of a CSV without a schema the header is used: the helper
    columns have their types, other columns are double if every value is a number, else text. That
    takes one more pass.
    """
    time = str(config.get("time_column") or TIME)
    path = dataset_path(config)
    fmt = os.path.splitext(path.rstrip("/"))[1].lstrip(".")
    if fmt not in FORMATS:
        raise ValueError(f"Unknown dataset format {fmt!r}. Options: {list(FORMATS)}")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"No dataset at {path}")
    if schema is None:
        found = spark.read.format(fmt).option("header", True).load(path).schema
        # A folder name such as series_id=007 would be read as a number.
        schema = _csv_schema(spark, path, found.names, time) if fmt == "csv" else _text_keys(found)
    rows = spark.read.schema(schema).format(fmt).option("header", True).load(path)
    if time != TIME:
        require_columns(rows, [time])
        rows = rows.withColumnRenamed(time, TIME)
    if config.get("series") is not None and SERIES not in rows.columns:
        rows = rows.select(F.lit(str(config["series"])).alias(SERIES), "*")
    if config.get("series") is not None and "ordinal" not in rows.columns:
        # The microseconds order the rows as well as a number would, and need no shuffle.
        rows = rows.withColumn("ordinal", F.unix_micros(F.col(TIME).cast("timestamp")))
    return rows


def save_dataset(
    df: DataFrame, path: str, fmt: str = "parquet", split_by: str | None = "series_id"
):
    """Overwrites ``path``; folders per series let a read of one series skip the rest.

    Rows are gathered by series first, so that a folder gets few files; a large series is
    split over several tasks. With very many series use ``split_by=None``: the files are
    then ranges of (series, time), which their statistics let a read skip.
    """
    if fmt not in FORMATS:
        raise ValueError(f"Unknown dataset format {fmt!r}. Options: {list(FORMATS)}")
    require_columns(df, [split_by])
    order = [split_by or "series_id", "ts"]
    order = [c for c in order if c in df.columns]
    if split_by:
        rows = df.hint("rebalance", split_by)
    else:
        rows = df.repartitionByRange(*order)
    writer = rows.sortWithinPartitions(*order).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if split_by:
        writer = writer.partitionBy(split_by)
    writer.save(path)


def _text_keys(found: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "series_id" else f.dataType, True, f.metadata)
            for f in found.fields
        ]
    )


def _csv_schema(spark: SparkSession, path: str, columns: list[str], time: str) -> T.StructType:
    types = {SERIES: T.StringType(), time: T.TimestampType(), "ordinal": T.LongType()}
    others = [c for c in columns if c not in types]
    if others:
        every = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.schema(every).option("header", True).csv(path)
        text = [
            F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull())
            for c in others
        ]
        found = rows.agg(*[t.alias(f"c{i}") for i, t in enumerate(text)]).first()
        types |= {c: T.StringType() if found[i] else T.DoubleType() for i, c in enumerate(others)}
    return T.StructType([T.StructField(c, types[c]) for c in columns])


def append_rows(rows: DataFrame, path: str) -> None:
    """Adds rows to a table that several jobs may add to at once.

    Each call writes a folder of its own: jobs that share a folder delete each other's unfinished
    files when they commit. Rows are seen once all of them are written.
    """
    rows.coalesce(1).write.parquet(f"{path}/entry={uuid.uuid4().hex}")


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that ``append_rows`` finished adding."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file, or returns False if it is there; one of many callers succeeds.

    Hadoop's local file system first looks and then creates, so local files are created by the
    operating system.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place.getParent())
    try:
        if store.getUri().getScheme() == "file":
            local = store.makeQualified(place).toUri().getPath()
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        else:
            store.create(place, False).close()
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works for any file system Spark can read."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
