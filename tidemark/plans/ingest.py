"""The ingest job: history, macro series, fills, cleaning, file, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.operators.align import attach_macro, fill_macro
from tidemark.operators.clean import (
    HELPERS,
    drop_rows_with_nulls,
    empty_columns,
    numbers_to_double,
)
from tidemark.sources.bars import fetch_history
from tidemark.sources.files import save_dataset
from tidemark.sources.macro import fetch_macro

REQUIRED = ("ticker", "start", "end")


def aligned_dataset(
    bars: DataFrame,
    macro: DataFrame | None = None,
    policy: str | None = "ffill",
    on: str = "timestamp",
) -> DataFrame:
    """Bars with filled macro columns, complete in the bar columns, all numbers double.

    A macro column without any match in any series is dropped. That is known before
    the fills, which cannot add a value to a series that has none.
    """
    original = [c for c in bars.columns if c not in HELPERS]
    dataset = bars
    if macro is not None:
        names = [c for c in macro.columns if c != "ts"]
        dataset = attach_macro(bars, macro, on)
        empty = empty_columns(dataset, names)
        kept = [c for c in names if c not in empty]
        dataset = fill_macro(dataset.drop(*empty), kept, policy)
    return numbers_to_double(drop_rows_with_nulls(dataset, original))


def fetch_market_data(
    bars: DataFrame,
    *,
    ticker: str | None,
    start: str,
    end: str,
    macro: DataFrame | None = None,
    macro_series: Mapping[str, str] | Sequence[str] | None = None,
    macro_fill_method: str | None = "ffill",
    macro_on: str = "timestamp",
    save_path: str | None = None,
    save_format: str = "parquet",
) -> DataFrame:
    """One series between two dates, or with ``ticker=None`` every series, ready to train on."""
    if macro_series and macro is None:
        raise ValueError("Macro series are named, but there is no macro table.")
    history = fetch_history(bars, ticker, start, end)
    wide = fetch_macro(macro, macro_series, start, end) if macro_series else None
    dataset = aligned_dataset(history, wide, macro_fill_method, macro_on)
    if save_path:
        save_dataset(dataset, save_path, save_format)
    return dataset


def ingest_from_config(
    bars: DataFrame,
    config: Mapping[str, object],
    macro: DataFrame | None = None,
    *,
    skip_macro: bool = False,
) -> DataFrame:
    """The same from a configuration mapping with ticker, start, end, save and macro.

    A ticker of None means every series. ``macro`` has ``series``, ``fill_method`` and ``on``.
    """
    for key in REQUIRED:
        if key not in config:
            raise ValueError(f"The data configuration needs '{key}'.")
    save = config.get("save") if isinstance(config.get("save"), Mapping) else {}
    wanted = config.get("macro") if isinstance(config.get("macro"), Mapping) else {}
    ticker = config["ticker"]
    return fetch_market_data(
        bars,
        ticker=None if ticker is None else str(ticker),
        start=str(config["start"]),
        end=str(config["end"]),
        macro=macro,
        macro_series=None if skip_macro else wanted.get("series") or None,
        macro_fill_method=wanted.get("fill_method", "ffill"),
        macro_on=wanted.get("on", "timestamp"),
        save_path=save.get("path"),
        save_format=save.get("format", "parquet"),
    )
