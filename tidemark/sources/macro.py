"""Macro-economic series: a long table (macro_id, ts, value) read as wide columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import empty_columns
from tidemark.session import freeze


def fetch_macro(
    macro: DataFrame,
    series: Mapping[str, str] | Sequence[str],
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One row per ts, one column per requested series; absent series are an error.

    ``series`` maps ids to column names, or lists ids that are their own names.
    """
    if not series:
        raise ValueError("Name at least one macro series.")
    names = dict(series) if isinstance(series, Mapping) else {key: key for key in series}
    wanted = macro.filter(F.col("macro_id").isin(*names) & F.col("value").isNotNull())
    if start is not None:
        wanted = wanted.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        wanted = wanted.filter(F.col("ts") <= F.lit(end).cast("timestamp"))

    # The table is read several times from here on, and is small: keep it.
    wide = freeze(widen(wanted, names))
    empty = empty_columns(wide, list(names.values()))
    if empty:
        missing = [key for key, name in names.items() if name in empty]
        raise ValueError(f"No observations for macro series: {missing}")
    return wide


def widen(macro: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The full outer join of all series on ts, as one aggregate."""
    return macro.groupBy("ts").agg(
        *[
            F.max(F.when(F.col("macro_id") == key, F.col("value"))).cast("double").alias(name)
            for key, name in names.items()
        ]
    )
