"""Session settings, and the shared folder in which intermediate tables are kept."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = "spark.tidemark.blockRows"
BROADCAST_ROWS = "spark.tidemark.broadcastRows"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; keyword keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Without the place of every column in the source, plans are built a fifth faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for a while; the value it had before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def compiled(spark: SparkSession):
    """For jobs over many computed columns.

    Spark makes one method of a whole stage; Java compiles none of more than 8,000 bytes and
    interprets it, ten times as slow. Beyond that size every operator is to have methods of its own.
    """
    return setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def block_rows(spark: SparkSession) -> int:
    """Rows one task may hold of one series before the series is cut into blocks."""
    return int(spark.conf.get(BLOCK_ROWS, "1000000"))


def broadcast_rows(spark: SparkSession) -> int:
    """Rows a table may have and still be broadcast."""
    return int(spark.conf.get(BROADCAST_ROWS, "200000"))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether rows times width stay small; the limit in rows is for tables of 8 plain columns.

    Text counts as four columns, nested values as sixteen. At most one row more than the limit is
    counted, so the check itself stays small.
    """
    weight = {T.StringType: 4, T.BinaryType: 4, T.ArrayType: 16, T.MapType: 16, T.StructType: 16}
    width = sum(weight.get(type(f.dataType), 1) for f in df.schema.fields)
    limit = broadcast_rows(df.sparkSession) * 8 // max(8, width)
    return df.limit(limit + 1).count() <= limit


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only for local sessions."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


_OPEN_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that are frozen inside are removed at the end; read or write results before."""
    _OPEN_SCRATCH.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in _OPEN_SCRATCH.pop():
            place = hadoop.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_shared(df: DataFrame) -> str:
    """Writes ``df`` to a new table in the shared folder and returns its path."""
    path = f"{shared_folder(df.sparkSession)}/tidemark/{uuid.uuid4().hex}"
    if _OPEN_SCRATCH:
        _OPEN_SCRATCH[-1].append(path)
    df.write.parquet(path)
    return path


def freeze(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends, columns still prune."""
    return df.sparkSession.read.schema(df.schema).parquet(write_shared(df))


def in_written_order(df: DataFrame) -> DataFrame:
    """A table that was just read, with its rows in the order in which Spark wrote them.

    A scan takes files by size, so it loses the order. The names of the files hold the number of
    the task, and of the file if a task wrote several; the place of a row in its file is known.
    """
    name, hidden = F.col("_metadata.file_name"), ["_part", "_piece", "_name", "_place"]
    places = [
        F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long"),
        name,
        F.col("_metadata.row_index"),
    ]
    placed = df.select("*", *[place.alias(h) for place, h in zip(places, hidden)])
    return placed.repartitionByRange(*hidden).sortWithinPartitions(*hidden).drop(*hidden)
