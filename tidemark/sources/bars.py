"""Price bars: built from ticks, read for one series, reshaped long and wide.

A bar table has the columns series_id, ts, ordinal, Open, High, Low, Close, Volume.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import require_columns
from tidemark.functions.values import field_name, moment_rank
from tidemark.operators.ordered import declare_rows_per_series

PRICES = ("Open", "High", "Low", "Close")
FIELDS = (*PRICES, "Volume")

_UNIT_SECONDS = {"m": 60, "h": 3600, "d": 86400}
_CALENDAR = {"1wk": "week", "1mo": "month", "3mo": "quarter"}
_LONGEST_DAYS = {"1wk": 7, "1mo": 31, "3mo": 92}

# Timestamps counted in nanoseconds since 1970 span 584 years, from 1677 to 2262.
_CALENDAR_DAYS = 584 * 366


def bar_start(ts: Column, interval: str = "1d") -> Column:
    """The start of the bar that ``ts`` falls into, in UTC."""
    if interval in _CALENDAR:
        return F.date_trunc(_CALENDAR[interval], ts)
    width = _interval_seconds(interval)
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(width)))


def rows_per_series(interval: str) -> int:
    """Most bars of one series the calendar has room for."""
    if interval in _CALENDAR:
        return _CALENDAR_DAYS // 7 + 1
    return _CALENDAR_DAYS * 86400 // _interval_seconds(interval)


def bars_from_ticks(
    ticks: DataFrame,
    *,
    series: str,
    ts: str,
    price: str,
    order: Sequence[str],
    interval: str = "1d",
    volume: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One bar per series and interval; ``order`` says which tick came first.

    With bounds, bars with start <= ts < end. Bounds on the ticks' own time reach the scan: a bar
    from ``start`` on has no earlier tick, and one before ``end`` none an interval later.

    The aggregates combine on the map side, so a hot series or day costs no more
    than any other. Volume is the number of ticks unless a column is named.
    """
    require_columns(ticks, [series, ts, price, *order, volume])
    kind = ticks.schema[ts].dataType
    if start is not None:
        ticks = ticks.filter(F.col(ts) >= F.lit(start).cast("timestamp").cast(kind))
    if end is not None:
        longest = f"{_LONGEST_DAYS.get(interval) or -(-_interval_seconds(interval) // 86400)} days"
        last = F.lit(end).cast("timestamp") + F.expr(f"INTERVAL {longest}")
        ticks = ticks.filter(F.col(ts) < last.cast(kind))
    rank = _rank(ticks, order)
    amount = F.sum(F.col(volume)) if volume else F.count(F.lit(1))
    bars = (
        ticks.filter(F.col(series).isNotNull() & F.col(ts).isNotNull())
        .groupBy(
            F.col(series).alias("series_id"),
            bar_start(F.col(ts).cast("timestamp"), interval).alias("ts"),
        )
        .agg(
            F.max(order[-1]).cast("long").alias("ordinal"),
            F.min_by(price, rank).cast("double").alias("Open"),
            F.max(price).cast("double").alias("High"),
            F.min(price).cast("double").alias("Low"),
            F.max_by(price, rank).cast("double").alias("Close"),
            amount.cast("double").alias("Volume"),
        )
    )
    if start is not None:
        bars = bars.filter(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        bars = bars.filter(F.col("ts") < F.lit(end).cast("timestamp"))
    return declare_rows_per_series(bars, rows_per_series(interval))


def fetch_history(
    bars: DataFrame, ticker: str | None, start: datetime | str, end: datetime | str
) -> DataFrame:
    """The bars of one series, or with None of all, with start <= ts < end.

    Both bounds reach the scan.
    """
    if ticker is not None and not ticker.strip():
        raise ValueError("ticker must not be empty.")
    first, last = _moment(start), _moment(end)
    if first >= last:
        raise ValueError("start must lie before end.")
    history = bars.filter(
        (F.lit(True) if ticker is None else F.col("series_id") == ticker.strip())
        & (F.col("ts") >= F.lit(first).cast("timestamp"))
        & (F.col("ts") < F.lit(last).cast("timestamp"))
    )
    if history.isEmpty():
        name = "any series" if ticker is None else repr(ticker)
        raise ValueError(f"No bars for {name} between {start} and {end}.")
    return history


def to_long(bars: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row per series, ts and field, with the flat name ``Field_TICKER``."""
    return bars.unpivot(["series_id", "ts"], list(fields), "field", "value").withColumn(
        "name", field_name(F.col("field"), F.col("series_id"))
    )


def to_wide(
    bars: DataFrame, series: Sequence[str], fields: Sequence[str] = FIELDS
) -> DataFrame:
    """One row per ts and a column ``Field_TICKER`` per field and listed series.

    A single series needs no suffix. Conditional aggregates need one shuffle.
    """
    def name(field: str, ticker: str) -> str:
        return field if len(series) == 1 else f"{field}_{ticker}"

    cells = [
        F.max(F.when(F.col("series_id") == ticker, F.col(field))).alias(name(field, ticker))
        for field in fields
        for ticker in series
    ]
    return bars.filter(F.col("series_id").isin(*series)).groupBy("ts").agg(*cells)


def _rank(ticks: DataFrame, order: Sequence[str]) -> Column:
    types = [ticks.schema[c].dataType for c in order]
    if len(order) == 1:
        return F.col(order[0])
    if (
        len(order) == 2
        and isinstance(types[0], (T.TimestampType, T.TimestampNTZType))
        and isinstance(types[1], T.IntegralType)
    ):
        return moment_rank(F.col(order[0]), F.col(order[1]))
    return F.struct(*order)


def _interval_seconds(interval: str) -> int:
    match = re.fullmatch(r"(\d+)([mhd])", interval)
    if not match or int(match[1]) == 0:
        options = ["<n>m", "<n>h", "<n>d", *_CALENDAR]
        raise ValueError(f"Unknown interval {interval!r}. Options: {options}")
    return int(match[1]) * _UNIT_SECONDS[match[2]]


def _moment(value: datetime | str) -> str:
    """ISO text in UTC, for a literal that does not depend on the driver's time zone."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).isoformat()
