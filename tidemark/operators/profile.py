"""Profiles of a table: missing values, time range, frequency, calendar gaps, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import numeric_columns
from tidemark.functions.values import iso_text, moment_rank, nan_to_null
from tidemark.operators.clean import HELPERS
from tidemark.operators.ordered import KEYS, ORDER, over_rows

_DAY = 86400


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls), most first."""
    return _per_column(df, columns, lambda c: F.count_if(F.col(c).isNull()), "nulls").orderBy(
        F.desc("nulls"), "column"
    )


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, values): the non-null count and the type of each column."""
    columns = list(columns or df.columns)
    types = F.create_map(
        *[item for c in columns for item in (F.lit(c), F.lit(df.schema[c].dataType.simpleString()))]
    )
    counted = _per_column(df, columns, F.count, "values")
    return counted.select("column", types[F.col("column")].alias("type"), "values")


def range_profile(df: DataFrame) -> DataFrame:
    """Per series: first and last time, rows, distinct times, and whether time never falls."""
    stepped = over_rows(
        df,
        lambda window: [(F.col("ts") < F.lag("ts").over(window)).alias("_falls")],
        before=1,
        order=("ordinal",),
    )
    per_moment = stepped.groupBy(*KEYS, "ts").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("_falls", F.lit(False))).alias("falls")
    )
    return per_moment.groupBy(*KEYS).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_ts"),
        (~F.max("falls")).alias("is_monotonic"),
    )


def infer_frequency(df: DataFrame) -> DataFrame:
    """Per series: a fixed step as seconds, ``B`` for Mon-Fri days, or NULL."""
    stepped = over_rows(
        df,
        lambda window: [
            (F.unix_seconds("ts") - F.unix_seconds(F.lag("ts").over(window))).alias("_gap"),
            F.weekday("ts").alias("_day"),
        ],
        before=1,
    ).filter(F.col("_gap").isNotNull())
    # From Monday the last business day lies three days back, from any other one day.
    regular = F.col("_gap") == F.when(F.col("_day") == 0, 3 * _DAY).otherwise(_DAY)
    business = F.bool_and(regular & (F.col("_day") < 5))
    return stepped.groupBy(*KEYS).agg(
        F.when(F.min("_gap") == F.max("_gap"), F.min("_gap").cast("string"))
        .when(business, F.lit("B"))
        .alias("frequency")
    )


def missing_days(df: DataFrame) -> DataFrame:
    """Per series, the calendar days between its first and last bar without a bar."""
    days = df.select(*KEYS, F.to_date("ts").alias("day"))
    spans = days.groupBy(*KEYS).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = spans.select(
        *KEYS, F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")
    )
    return calendar.join(days.distinct(), [*KEYS, "day"], "left_anti")


def ingest_summary(df: DataFrame) -> DataFrame:
    """One row: row count, first and last time."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        iso_text(F.min("ts")).alias("first_ts"),
        iso_text(F.max("ts")).alias("last_ts"),
    )


def first_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ORDER) -> DataFrame:
    """The first rows with NaN as NULL, ready for output."""
    numeric = numeric_columns(df, HELPERS)
    rows = df.orderBy(*order, *KEYS).limit(n)
    return rows.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in numeric})


def last_rows(df: DataFrame, n: int, order: Sequence[str] = ORDER) -> DataFrame:
    """The last rows, in ascending order again."""
    ordered = [*order, *KEYS]
    return df.orderBy(*[F.desc(c) for c in ordered]).limit(n).orderBy(*ordered)


def latest_row(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """The newest row per series, combined before the shuffle."""
    rank = moment_rank(F.col("ts"), F.col("ordinal"))
    return df.groupBy(*keys).agg(*[F.max_by(c, rank).alias(c) for c in (*ORDER, *columns)])


def _per_column(df, columns, aggregate, value) -> DataFrame:
    columns = list(columns or df.columns)
    counts = df.agg(*[aggregate(c).cast("long").alias(c) for c in columns])
    return counts.unpivot([], columns, "column", value)
