"""Rolling statistics merged from blocks against plain frames."""

from __future__ import annotations

import random
import statistics
from datetime import timedelta

import pytest

from tests.conftest import START, values
from tests.test_ordered import skewed
from tidemark.operators import features
from tidemark.operators.features import add_features

NAMES = ["Close_sma_7", "Close_std_7", "Close_sma_1", "Close_std_1", "Close_sma_40", "Close_std_40"]
SIZES = [7, 1, 40]


def rolled(df, **more):
    return add_features(df, "Close", lags=(), returns=[], rolling_windows=SIZES, **more)


def assert_alike(got, want):
    assert len(got) == len(want)
    for a, b in zip((x for row in got for x in row), (x for row in want for x in row)):
        assert (a is None) == (b is None)
        assert a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9, nan_ok=True)


@pytest.mark.parametrize("rows", [None, 5, 16, 100])
@pytest.mark.parametrize("least", [None, 1, 3])
def test_blocks_equal_plain_frames(spark, blocks, monkeypatch, rows, least):
    """Nulls, a series of one row, a hot series, and series in parts."""
    df = skewed(spark)
    plain = rolled(df, min_periods=least)
    wanted = values(plain, *NAMES)
    if rows:
        blocks(rows)
    monkeypatch.setattr(features, "LONG", 1)
    merged = rolled(df, min_periods=least)
    assert merged.columns == plain.columns
    assert_alike(values(merged, *NAMES), wanted)


def test_values_far_from_zero_and_trends(spark, monkeypatch):
    """Against exact arithmetic; plain frames themselves lose half the digits near 1e9."""
    draw = random.Random(4)
    rows = []
    for name, level, slope in (("far", 1e9, 0.0), ("trend", 0.0, 1e6)):
        for i in range(300):
            rows.append((name, START + timedelta(days=i), i, level + slope * i + draw.uniform(-1, 1)))
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, ordinal long, Close double")
    monkeypatch.setattr(features, "LONG", 2)
    got = values(rolled(df), *NAMES)
    for k, (name, _, i, _) in enumerate(rows):
        own = [r[3] for r in rows if r[0] == name]
        for at, size in ((0, 7), (4, 40)):
            if i + 1 < size:
                assert got[k][at] is None
                continue
            window = own[i + 1 - size : i + 1]
            assert got[k][at] == pytest.approx(statistics.fmean(window), rel=1e-12)
            assert got[k][at + 1] == pytest.approx(statistics.stdev(window), rel=1e-9)


def test_nan(spark, monkeypatch):
    rows = [("nan", START + timedelta(days=i), i, float("nan") if i == 9 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, ordinal long, Close double")
    plain = values(rolled(df), *NAMES)
    monkeypatch.setattr(features, "LONG", 2)
    assert_alike(values(rolled(df), *NAMES), plain)


def test_empty(spark, monkeypatch):
    monkeypatch.setattr(features, "LONG", 1)
    assert rolled(skewed(spark).limit(0)).count() == 0
