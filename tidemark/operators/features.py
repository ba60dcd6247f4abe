"""Features of a target column: lags, returns, rolling statistics, amplitude, traded value."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.values import natural_log, ratio
from tidemark.operators.ordered import KEYS, ORDER, for_each_part, over_rows, with_fills
from tidemark.operators.rolling import LONG, with_long_windows


def lag_column(target: str, n: int, window: WindowSpec) -> Column:
    n = names.positive("lag", n)
    return F.lag(target, n).over(window).alias(names.lag_name(target, n))


def log_return_column(target: str, n: int, window: WindowSpec) -> Column:
    n = names.positive("periods", n)
    change = ratio(F.col(target), F.lag(target, n).over(window))
    return natural_log(change).alias(names.return_name(target, n, log=True))


def return_column(target: str, n: int, window: WindowSpec, filled: str) -> Column:
    """Change of the forward-filled target ``filled`` against n rows before."""
    n = names.positive("periods", n)
    change = ratio(F.col(filled), F.lag(filled, n).over(window)) - 1
    return change.alias(names.return_name(target, n))


def rolling_mean_column(
    target: str, size: int, window: WindowSpec, min_periods: int | None = None
) -> Column:
    value = _rolling(F.avg(target), target, size, window, min_periods)
    return value.alias(names.mean_name(target, size))


def rolling_deviation_column(
    target: str, size: int, window: WindowSpec, min_periods: int | None = None
) -> Column:
    """Sample standard deviation; NULL for a window of one."""
    value = _rolling(F.stddev_samp(target), target, size, window, min_periods)
    return value.alias(names.deviation_name(target, size))


def amplitude_column(high: str = "High", low: str = "Low") -> Column:
    return (F.col(high) - F.col(low)).alias(names.AMPLITUDE)


def nominal_column(price: str = "Close", volume: str = "Volume") -> Column:
    return (F.col(price) * F.col(volume)).alias(names.NOMINAL)


def add_features(
    df: DataFrame,
    target: str,
    *,
    lags: int | Iterable[int] = (1, 5, 10),
    returns: Iterable[int] = (1,),
    rolling_windows: Iterable[int] = (5, 20),
    log_returns: Iterable[int] = (),
    min_periods: int | None = None,
    high_column: str | None = None,
    low_column: str | None = None,
    volume_column: str | None = None,
    price_for_nominal: str | None = None,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Adds the whole bundle at once, so that all windows share one shuffle and one sort.

    Rolling windows of many rows are merged from blocks, whose cost does not grow with the window.
    """
    lags = names.expand_lags(lags) if lags != () else ()
    returns = [names.positive("returns", n) for n in returns]
    log_returns = [names.positive("returns", n) for n in log_returns]
    sizes = [names.positive("rolling_windows", n) for n in rolling_windows]
    price = price_for_nominal or target
    names.require_columns(df, [target, high_column, low_column, volume_column, price_for_nominal])

    def windows(window: WindowSpec) -> list[Column]:
        columns = [lag_column(target, n, window) for n in lags]
        columns += [return_column(target, n, window, f"{target}__forward") for n in returns]
        columns += [log_return_column(target, n, window) for n in log_returns]
        for size in short:
            columns.append(rolling_mean_column(target, size, window, min_periods))
            columns.append(rolling_deviation_column(target, size, window, min_periods))
        return columns

    short, long = [s for s in sizes if s < LONG], [s for s in sizes if s >= LONG]
    reach = max([0, *lags, *returns, *log_returns, *(size - 1 for size in short)])

    def add(part: DataFrame) -> DataFrame:
        if returns:
            part = with_fills(part, [target], keys=keys, order=order)
        if lags or returns or log_returns or short:
            part = over_rows(part, windows, before=reach, keys=keys, order=order)
        return with_long_windows(part, target, long, min_periods, keys, order)

    if lags or returns or log_returns or sizes:
        df = for_each_part(df, add, keys, order).drop(f"{target}__forward")

    derived = []
    if high_column is not None and low_column is not None:
        derived.append(amplitude_column(high_column, low_column))
    if volume_column is not None:
        derived.append(nominal_column(price, volume_column))
    if long:
        # Columns come in the order of the sizes, however they were made.
        rolled = [f(target, n) for n in sizes for f in (names.mean_name, names.deviation_name)]
        df = df.select(*[f"`{c}`" for c in df.columns if c not in rolled], *rolled)
    return df.select("*", *derived)


def feature_names(
    target: str,
    *,
    lags: int | Iterable[int] = (1, 5, 10),
    returns: Iterable[int] = (1,),
    rolling_windows: Iterable[int] = (5, 20),
    high_column: str | None = None,
    low_column: str | None = None,
    volume_column: str | None = None,
) -> list[str]:
    """Names of the bundle's columns in the order they are added."""
    result = [names.lag_name(target, n) for n in names.expand_lags(lags)]
    result += [names.return_name(target, n) for n in returns]
    for size in rolling_windows:
        result += [names.mean_name(target, size), names.deviation_name(target, size)]
    if high_column is not None and low_column is not None:
        result.append(names.AMPLITUDE)
    if volume_column is not None:
        result.append(names.NOMINAL)
    return result


def _rolling(
    aggregate: Column, target: str, size: int, window: WindowSpec, min_periods: int | None
) -> Column:
    size = names.positive("window", size)
    needed = size if min_periods is None else names.positive("min_periods", min_periods)
    frame = window.rowsBetween(1 - size, 0)
    return F.when(F.count(target).over(frame) >= needed, aggregate.over(frame))
