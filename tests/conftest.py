from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def blocks(spark):
    """Sets the rows per block for one test."""

    def set_rows(rows: int) -> None:
        spark.conf.set("spark.tidemark.blockRows", str(rows))

    yield set_rows
    spark.conf.unset("spark.tidemark.blockRows")


START = datetime(2024, 1, 1)


def series(spark, values, name="s", step=timedelta(days=1), start=START, column="Close"):
    """One series with a value per day."""
    rows = [
        (name, start + i * step, i, None if v is None else float(v)) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, f"series_id string, ts timestamp, ordinal long, {column} double"
    )


def values(df, *columns):
    rows = df.orderBy("series_id", "ts", "ordinal").select(*columns).collect()
    return [row[0] if len(columns) == 1 else tuple(row) for row in rows]


@pytest.fixture(scope="session")
def bars(spark):
    """Three series of different length; one holds most of the rows."""
    import random

    draw = random.Random(5)
    rows = []
    for name, n in (("big", 260), ("mid", 90), ("small", 70)):
        price = 100.0
        for i in range(n):
            price = max(5.0, price + draw.uniform(-3, 3))
            high, low = price + draw.uniform(0, 2), price - draw.uniform(0, 2)
            rows.append(
                (name, START + timedelta(days=i), i, price - 0.5, high, low, price, draw.randint(1, 90) * 1.0)
            )
    return spark.createDataFrame(
        rows,
        "series_id string, ts timestamp, ordinal long, Open double, High double, Low double, "
        "Close double, Volume double",
    )
