"""Row and column cleaning: casts, missing values, duplicates, fitted column lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import label_prefix, numeric_columns
from tidemark.operators.ordered import KEYS

HELPERS = ("series_id", "ts", "ordinal")


def double_or_null(column: str) -> str:
    """SQL for a column as a double, with NaN read as NULL.

    One text per column is much cheaper to hand to the JVM than a tree of calls, which
    counts for the wide matrices that are built again for every model.
    """
    return f"nullif(cast(`{column}` as double), double('NaN')) as `{column}`"


def numbers_to_double(df: DataFrame, exclude: Sequence[str] = HELPERS) -> DataFrame:
    """Every numeric column as a double, with NaN read as NULL; one projection."""
    numeric = set(numeric_columns(df, exclude))
    return df.selectExpr(*[double_or_null(c) if c in numeric else f"`{c}`" for c in df.columns])


def drop_rows_with_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns is not None else None)


def empty_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns without a single value, from one aggregate."""
    if not columns:
        return []
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] == 0]


def drop_empty_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*empty_columns(df, columns))


def keep_one_per_key(
    df: DataFrame, keep: str = "last", keys: Sequence[str] = (*KEYS, "ts"), by: str = "ordinal"
) -> DataFrame:
    """The first or last row per key by ``by``; combined before the shuffle, not sorted after it."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}.")
    pick = F.max_by if keep == "last" else F.min_by
    others = [c for c in df.columns if c not in (*keys, by)]
    bound = F.max(by) if keep == "last" else F.min(by)
    picked = df.groupBy(*keys).agg(bound.alias(by), *[pick(c, by).alias(c) for c in others])
    return picked.select(*df.columns)


def base_columns(
    columns: Sequence[str], target: str, base: Sequence[str] | None = None
) -> list[str]:
    """The listed columns, or all but the target and its labels."""
    if base is not None:
        return list(base)
    prefix = label_prefix(target)
    return [c for c in columns if c != target and not c.startswith(prefix)]


def impose_columns(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``features``, in order: absent ones are 0.0, others are dropped."""
    present = set(df.columns)
    kept = [c for c in keep if c in present and c not in features]
    return df.select(*kept, *[f if f in present else F.lit(0.0).alias(f) for f in features])


def fill_missing(df: DataFrame, value: float = 0.0, columns: Sequence[str] | None = None):
    """NULL and NaN to a constant, in a table or in some of its columns."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"Expected a DataFrame, not {type(df).__name__}.")
    numeric = list(columns if columns is not None else numeric_columns(df, HELPERS))
    return df.fillna(value, subset=numeric) if numeric else df
