from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import START, series, values
from tidemark.functions import names
from tidemark.functions import values as scalar
from tidemark.operators.features import add_features, feature_names


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("days", [1, -1, 4, 5, -5, 7, 20, -60, 64, -64])
def test_business_days_equal_pandas(spark, days):
    starts = [datetime(2025, 9, 25, 13, 30) + timedelta(days=i) for i in range(15)]
    df = spark.createDataFrame([(s,) for s in starts], "ts timestamp")
    moved = df.select("ts", scalar.business_day_offset(F.col("ts"), days).alias("to")).toPandas()
    assert list(moved["to"]) == [t + pd.tseries.offsets.BDay(days) for t in moved["ts"]]


def test_business_day_cases(spark):
    def move(text, n):
        return one(spark, scalar.business_day_offset(F.lit(text).cast("timestamp"), n).cast("date"))

    assert str(move("2025-10-18", 1)) == "2025-10-20"  # Saturday to Monday
    assert str(move("2025-10-18", -1)) == "2025-10-17"  # Saturday to Friday
    assert str(move("2025-10-20", -60)) == "2025-07-28"
    assert str(move("2025-10-17", 20)) == "2025-11-14"
    with pytest.raises(ValueError):
        scalar.business_day_offset(F.lit(0), 0)


def test_unreadable_date_is_now(spark):
    now = datetime.now(timezone.utc).timestamp()
    found = one(spark, F.unix_seconds(scalar.date_or_now(F.lit("not a date"))))
    assert abs(found - now) < 60
    assert one(spark, F.unix_seconds(scalar.date_or_now(F.lit("2024-01-02")))) == 1704153600


def test_text_and_number_functions(spark):
    assert one(spark, scalar.largest_integer(F.lit("lags 1 to 20, ret 3"))) == 20
    assert one(spark, scalar.largest_integer(F.lit("none"))) is None
    assert one(spark, scalar.number_or_null(F.lit("2.5"))) == 2.5
    assert one(spark, scalar.number_or_null(F.lit("x"))) is None
    assert one(spark, scalar.number_or_null(F.lit("NaN"))) is None
    assert one(spark, scalar.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, scalar.natural_log(F.lit(0.0))) is None
    assert one(spark, scalar.natural_log(F.lit(-1.0))) is None
    assert one(spark, scalar.field_name(F.lit("Close"), F.lit(" ABC "))) == "Close_ABC"
    assert one(spark, scalar.iso_text(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == (
        "2024-01-02T03:04:05"
    )


def test_rank_orders_by_time_then_number(spark):
    rows = [(START, 5), (START, -(2**62)), (START + timedelta(microseconds=1), -(2**63)), (START, 2**63 - 1)]
    df = spark.createDataFrame(rows, "ts timestamp, n long")
    ranked = df.orderBy(scalar.moment_rank(F.col("ts"), F.col("n"))).collect()
    assert [tuple(r) for r in ranked] == sorted(rows)


def test_return_carries_the_last_value_over_gaps(spark):
    df = add_features(series(spark, [1, 2, None, 4]), "Close", lags=(), returns=[1], rolling_windows=[])
    assert values(df, "Close_ret_1") == [None, 1.0, 0.0, 1.0]


def test_division_by_zero_is_null(spark):
    df = add_features(
        series(spark, [2, 0, 3]), "Close", lags=(), returns=[1], rolling_windows=[], log_returns=[1]
    )
    assert values(df, "Close_ret_1", "Close_logret_1") == [(None, None), (-1.0, None), (None, None)]


def test_rolling_deviation_with_a_gap(spark):
    df = series(spark, [1, 2, None, 4, 5, 0, 3])
    got = values(add_features(df, "Close", lags=(), returns=[], rolling_windows=[3]), "Close_std_3")
    assert got[:5] == [None] * 5
    assert got[5:] == pytest.approx([2.6457513, 2.5166115])
    one_wide = add_features(df, "Close", lags=(), returns=[], rolling_windows=[1])
    assert values(one_wide, "Close_std_1") == [None] * 7
    assert values(one_wide, "Close_sma_1") == [1, 2, None, 4, 5, 0, 3]


def test_min_periods(spark):
    df = add_features(
        series(spark, [1, 2, 6]), "Close", lags=(), returns=[], rolling_windows=[3], min_periods=2
    )
    assert values(df, "Close_sma_3") == [None, 1.5, 3.0]


def test_names_in_order():
    assert feature_names(
        "Close", lags=2, returns=[1], rolling_windows=[3], high_column="High", low_column="Low",
        volume_column="Volume",
    ) == ["Close_lag_1", "Close_lag_2", "Close_ret_1", "Close_sma_3", "Close_std_3", "amplitude", "nominal_value"]
    assert names.label_name("Close", 20) == "Close_target_h20"
    assert names.return_name("Close", 2, log=True) == "Close_logret_2"


@pytest.mark.parametrize("lags", [0, -1, [], [1, 0], "3", None, True])
def test_bad_lags(lags):
    with pytest.raises(ValueError):
        names.expand_lags(lags)


def test_bad_windows_and_columns(spark):
    df = series(spark, [1.0])
    for bad in ({"rolling_windows": [0]}, {"returns": [-1]}, {"rolling_windows": [3], "min_periods": 0}):
        with pytest.raises(ValueError):
            add_features(df, "Close", **bad)
    with pytest.raises(KeyError, match="High"):
        add_features(df, "Close", high_column="High", low_column="Close")
    with pytest.raises(KeyError, match="Open"):
        add_features(df, "Open")


def test_one_shuffle_and_one_sort_for_the_bundle(spark):
    df = add_features(series(spark, [1.0, 2.0]), "Close", lags=20, returns=[1], rolling_windows=[3])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_largest_digits_of_any_length(spark):
    long = "9" * 50
    assert one(spark, scalar.largest_digits(F.lit(f"7 {long} 0{long[:-1]} 12"))) == long
    assert one(spark, scalar.largest_digits(F.lit("000 x"))) == "0"
    assert one(spark, scalar.largest_integer(F.lit(f"7 {long}"))) is None
