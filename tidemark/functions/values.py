"""Scalar expressions: division, missing values, text and business days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error or an infinity when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def natural_log(value: Column) -> Column:
    """NULL for zero and negative input."""
    return F.when(value > 0, F.ln(value))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def number_or_null(value: Column) -> Column:
    """Text or number to a double; anything else, and NaN, to NULL."""
    return nan_to_null(value.try_cast("double"))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def to_utc(ts: Column, zone: str | None = None) -> Column:
    """Naive times are read as UTC; with ``zone`` they are local times of that zone."""
    return F.to_utc_timestamp(ts, zone) if zone else ts.cast("timestamp")


def moment_rank(ts: Column, number: Column) -> Column:
    """One number that orders rows by time, then by a whole number.

    Aggregates that pick a row by (time, number) can hash on it; a struct would make
    them sort all rows first. Exact for every long and every year up to 160,000.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    step = F.lit("2" + 19 * "0").cast("decimal(20,0)")
    return micros * step + number.cast("decimal(19,0)")


def date_or_now(text: Column) -> Column:
    """Unreadable dates become the current time."""
    return F.coalesce(F.try_to_timestamp(text), F.current_timestamp())


def largest_digits(text: Column) -> Column:
    """The largest run of digits in a text, of any length, as text without leading zeros."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    bare = F.transform(runs, lambda run: F.ltrim(run, F.lit("0")))
    sized = F.transform(bare, lambda run: F.struct(F.char_length(run), run.alias("run")))
    largest = F.array_max(sized)["run"]
    return F.when(largest == "", F.lit("0")).otherwise(largest)


def largest_integer(text: Column) -> Column:
    """The largest run of digits as a number; NULL if it has more than 38 digits."""
    return largest_digits(text).try_cast("decimal(38,0)")


def field_name(field: Column, series: Column) -> Column:
    """``Field_TICKER``, the flat name of a field of one of several series."""
    return F.concat_ws("_", field, F.trim(series))


def business_day_offset(ts: Column, days: int) -> Column:
    """Moves ``ts`` by Mon-Fri days and keeps the time of day.

    A weekend start first rolls back to Friday when moving forward, and on to
    Monday when moving back, so that the first step lands on the next weekday.
    """
    if days == 0:
        raise ValueError("days must not be zero.")
    weekday = F.weekday(ts)
    roll = F.greatest(weekday - 4, F.lit(0))  # days since Friday: 1 on Saturday, 2 on Sunday
    shift = -roll if days > 0 else F.when(roll > 0, 3 - roll).otherwise(0)
    start = F.when(roll > 0, F.lit(4 if days > 0 else 0)).otherwise(weekday)
    steps = start + days
    move = shift + 7 * F.floor(steps / 5) + F.pmod(steps, F.lit(5)) - start
    return ts + F.make_interval(days=move.cast("int"))
