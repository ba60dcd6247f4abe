"""Column names that downstream code refers to, and checks of their parameters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from numbers import Integral

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AMPLITUDE = "amplitude"
NOMINAL = "nominal_value"


def lag_name(target: str, n: int) -> str:
    return f"{target}_lag_{n}"


def return_name(target: str, n: int, *, log: bool = False) -> str:
    return f"{target}_{'logret' if log else 'ret'}_{n}"


def mean_name(target: str, window: int) -> str:
    return f"{target}_sma_{window}"


def deviation_name(target: str, window: int) -> str:
    return f"{target}_std_{window}"


def label_prefix(target: str) -> str:
    return f"{target}_target"


def label_name(target: str, horizon: int) -> str:
    return f"{label_prefix(target)}_h{horizon}"


def positive(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, Integral) or value < 1:
        raise ValueError(f"{name} must be a positive integer, not {value!r}.")
    return int(value)


def expand_lags(lags: int | Iterable[int]) -> tuple[int, ...]:
    """A single number n stands for the lags 1..n."""
    if isinstance(lags, Integral):
        return tuple(range(1, positive("lags", lags) + 1))
    if isinstance(lags, str) or not isinstance(lags, Iterable):
        raise ValueError("lags must be a positive integer or a list of them.")
    values = tuple(positive("lags", n) for n in lags)
    if not values:
        raise ValueError("lags must not be empty.")
    return values


def require_columns(df: DataFrame, columns: Iterable[str | None]) -> None:
    """KeyError naming every missing column; None entries are not required."""
    missing = [c for c in columns if c is not None and c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns: {missing}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
