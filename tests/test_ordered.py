"""Plain windows and blocks must agree, whatever the block size and the skew."""

from __future__ import annotations

import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import START, series, values
from tidemark.operators import ordered
from tidemark.operators.features import add_features
from tidemark.operators.split import add_label, expanding_folds, temporal_split


def skewed(spark, seed=1, nulls=0.3):
    """One series has more than a third of the rows; times repeat; values are missing."""
    draw = random.Random(seed)
    rows, ordinal = [], 0
    for name, n in (("hot", 137), ("b", 60), ("c", 41), ("one", 1)):
        for i in range(n):
            value = None if draw.random() < nulls else draw.uniform(1, 9)
            rows.append((name, START + timedelta(hours=i // 3), ordinal, value))
            ordinal += 1
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "series_id string, ts timestamp, ordinal long, Close double")


BUNDLE = {"lags": [1, 2, 7], "returns": [1, 3], "rolling_windows": [1, 4]}


@pytest.mark.parametrize("rows", [5, 16, 100])
def test_features_in_blocks_equal_plain_windows(spark, blocks, rows):
    df = skewed(spark)
    names = add_features(df, "Close", **BUNDLE).columns
    plain = values(add_features(df, "Close", **BUNDLE), *names)
    blocks(rows)
    assert ordered.is_long(df, ["series_id"])
    assert values(add_features(df, "Close", **BUNDLE), *names) == plain


def test_features_equal_pandas(spark, blocks):
    df = skewed(spark, nulls=0.0)
    blocks(20)
    got = add_features(df, "Close", **BUNDLE).toPandas()
    got = got.sort_values(["series_id", "ts", "ordinal"]).reset_index(drop=True)
    close = got.groupby("series_id")["Close"]
    pd.testing.assert_series_equal(got["Close_lag_7"], close.shift(7), check_names=False)
    pd.testing.assert_series_equal(
        got["Close_ret_3"], close.pct_change(3, fill_method=None), check_names=False
    )
    mean = close.transform(lambda s: s.rolling(4).mean())
    deviation = close.transform(lambda s: s.rolling(4).std())
    pd.testing.assert_series_equal(got["Close_sma_4"], mean, check_names=False)
    pd.testing.assert_series_equal(got["Close_std_4"], deviation, check_names=False)


@pytest.mark.parametrize("rows", [3, 10, 50])
def test_fills_in_blocks_equal_plain_windows(spark, blocks, rows):
    df = skewed(spark, nulls=0.9)
    columns = ["series_id", "ordinal", "Close", "Close__forward", "Close__backward"]
    plain = values(ordered.with_fills(df, ["Close"], backward=True), *columns)
    blocks(rows)
    assert values(ordered.with_fills(df, ["Close"], backward=True), *columns) == plain


def test_fills_equal_pandas(spark, blocks):
    df = skewed(spark, nulls=0.8)
    blocks(7)
    got = ordered.with_fills(df, ["Close"], backward=True).toPandas()
    got = got.sort_values(["series_id", "ts", "ordinal"]).reset_index(drop=True)
    close = got.groupby("series_id")["Close"]
    pd.testing.assert_series_equal(got["Close__forward"], close.ffill(), check_names=False)
    pd.testing.assert_series_equal(got["Close__backward"], close.bfill(), check_names=False)


@pytest.mark.parametrize("rows", [4, 64])
def test_positions_in_blocks(spark, blocks, rows):
    df = skewed(spark)
    plain = values(ordered.with_position(df), "ordinal", "position", "rows")
    blocks(rows)
    assert values(ordered.with_position(df), "ordinal", "position", "rows") == plain


def test_positions_without_keys(spark, blocks):
    df = skewed(spark)
    blocks(10)
    got = ordered.with_position(df, keys=(), order=("ordinal",)).orderBy("ordinal").collect()
    assert [r.position for r in got] == list(range(df.count()))


def test_null_keys_keep_their_rows(spark, blocks):
    df = skewed(spark).withColumn("series_id", F.nullif("series_id", F.lit("b")))
    blocks(10)
    assert add_features(df, "Close", **BUNDLE).count() == df.count()


@pytest.mark.parametrize("horizon", [1, 9])
def test_label_split_and_folds_in_blocks(spark, blocks, horizon):
    df = skewed(spark, nulls=0.1).filter(F.col("series_id") != "one")
    label = [f"Close_target_h{horizon}", "ordinal"]

    def run():
        split = temporal_split(df, "Close", gap=1, horizon=horizon)
        folds = expanding_folds(df, 3, 1)
        return (
            values(add_label(df, "Close", horizon), *label),
            values(split, *label, "split"),
            sorted(values(folds, "ordinal", "fold", "role")),
        )

    plain = run()
    blocks(12)
    assert run() == plain


def test_notes_on_length(spark, blocks, tmp_path, monkeypatch):
    keys = ["series_id"]
    df = series(spark, [1.0, 2.0, 3.0])
    assert ordered.rows_per_group(df, keys) == 3
    bounded = ordered.declare_rows_per_series(df, 50)
    bounded.write.parquet(str(tmp_path / "bars"))
    bounded = spark.read.parquet(str(tmp_path / "bars"))
    assert ordered.declared_rows(bounded.filter("ordinal = 0"), [*keys, "split"]) == 50
    assert ordered.declared_rows(bounded, ["split"]) is None

    blocks(10)  # the bound is no proof for such blocks, the count is
    assert not ordered.is_long(bounded, keys)
    measured = ordered.measure(bounded)
    assert ordered.declared_rows(measured, keys, ordered.MEASURED) == 3
    blocks(2)
    assert ordered.is_long(bounded, keys) and ordered.is_long(measured, keys)

    def no_count(*_):
        raise AssertionError("counted")

    monkeypatch.setattr(ordered, "rows_per_group", no_count)
    assert ordered.is_long(measured, keys)
    blocks(50)
    assert not ordered.is_long(bounded, keys)


def test_long_series_spread_over_tasks(spark, blocks):
    """The blocks of the only series are windowed by all tasks."""
    df = spark.range(0, 20_000).select(
        F.lit("hot").alias("series_id"),
        F.timestamp_seconds("id").alias("ts"),
        F.col("id").alias("ordinal"),
        F.rand(3).alias("Close"),
    )
    blocks(500)
    result = add_features(df, "Close", lags=[20], returns=[], rolling_windows=[])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = result.groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("rows"), F.max("Close_lag_20")
        )
        per_task = [r["rows"] for r in tasks.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) == 4 and sum(per_task) == 20_000
    assert max(per_task) < 10_000
