"""The table of registered queries, and the common form of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Times as text, whole numbers as long, doubles rounded and without a negative zero."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            rounded = F.round(value.cast("double"), digits)
            value = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
        elif isinstance(field.dataType, T.IntegralType):
            value = value.cast("long")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def num(expression: str, name: str | None = None, digits: int = 4) -> str:
    """SQL for a rounded double, as ``tidy`` writes it."""
    name = name or expression
    alias = f'"{name}"' if not name.startswith('"') else name
    rounded = f"round(({expression})::DOUBLE, {digits})"
    return f"CASE WHEN {rounded} = 0 THEN 0.0::DOUBLE ELSE {rounded} END AS {alias}"


def nums(*columns: str, digits: int = 4) -> str:
    return ", ".join(num(f'"{c}"', c, digits) for c in columns)


def when(expression: str = "ts", name: str | None = None) -> str:
    """SQL for a time as text, as ``tidy`` writes it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name or expression}"
