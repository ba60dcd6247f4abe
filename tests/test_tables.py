"""Sources, cleaning, alignment, profiles, splits, statistics."""

from __future__ import annotations

import itertools
import math
import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import START, series, values
from tidemark import session
from tidemark.operators import align, clean, metrics, moments, profile, quantiles, scaling
from tidemark.operators.split import add_label, expanding_folds, temporal_split
from tidemark.plans.ingest import aligned_dataset, fetch_market_data, ingest_from_config
from tidemark.session import fits_broadcast, scratch, shared_folder, write_shared
from tidemark.sources import bars as bar_source
from tidemark.sources.files import dataset_path, load_dataset, save_dataset
from tidemark.sources.macro import fetch_macro

FRIDAY = START + timedelta(days=4)


def macro_table(spark, rows):
    return spark.createDataFrame(rows, "macro_id string, ts timestamp, value double")


# --- sources


def test_bars_from_ticks_break_ties_by_id(spark):
    ticks = spark.createDataFrame(
        [("a", START, 2, 7.0), ("a", START, 1, 5.0), ("a", START + timedelta(minutes=59), 3, 6.0),
         ("a", START + timedelta(hours=1), 4, 9.0), (None, START, 5, 1.0)],
        "s string, t timestamp, i long, p double",
    )
    got = bar_source.bars_from_ticks(
        ticks, series="s", ts="t", price="p", order=["t", "i"], interval="1h"
    )
    assert values(got, "Open", "High", "Low", "Close", "Volume") == [
        (5.0, 7.0, 5.0, 6.0, 3.0), (9.0, 9.0, 9.0, 9.0, 1.0)
    ]


@pytest.mark.parametrize(
    "interval, start", [("15m", "2024-01-03 10:30:00"), ("1h", "2024-01-03 10:00:00"),
                        ("1d", "2024-01-03 00:00:00"), ("1wk", "2024-01-01 00:00:00"),
                        ("1mo", "2024-01-01 00:00:00")]
)
def test_intervals(spark, interval, start):
    ts = F.lit("2024-01-03 10:44:59").cast("timestamp")
    got = spark.range(1).select(bar_source.bar_start(ts, interval).cast("string")).first()[0]
    assert got == start
    with pytest.raises(ValueError, match="Options"):
        bar_source.bar_start(ts, "1y")


def test_history_bounds_and_errors(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0], "abc")
    got = bar_source.fetch_history(df, " abc ", "2024-01-02", "2024-01-04")
    assert values(got, "Close") == [2.0, 3.0]
    for bad in (("", "2024-01-01", "2024-01-02"), ("abc", "2024-01-02", "2024-01-02"),
                ("abc", "2025-01-01", "2025-01-02"), ("x", "2024-01-01", "2024-01-05")):
        with pytest.raises(ValueError):
            bar_source.fetch_history(df, *bad)


def test_history_filter_reaches_the_scan(spark, tmp_path, bars):
    save_dataset(bars, str(tmp_path / "bars.parquet"))
    stored = load_dataset(spark, {"path": str(tmp_path / "bars.parquet")})
    got = bar_source.fetch_history(stored, "mid", "2024-01-10", "2024-01-20").select("Close")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(series_id" in plan
    assert "GreaterThanOrEqual(ts," in plan and "ReadSchema: struct<ts:timestamp,Close:double>" in plan
    assert got.count() == 10


def test_long_and_wide(spark):
    df = series(spark, [1.0, 2.0], "a").unionByName(series(spark, [3.0], "b"))
    wide = bar_source.to_wide(df, ["a", "b"], ["Close"]).orderBy("ts").collect()
    assert [(r.Close_a, r.Close_b) for r in wide] == [(1.0, 3.0), (2.0, None)]
    assert bar_source.to_wide(df, ["a"], ["Close"]).columns == ["ts", "Close"]
    long = bar_source.to_long(df, ["Close"])
    assert {r.name for r in long.collect()} == {"Close_a", "Close_b"}


def test_datasets_round_trip(spark, tmp_path, bars):
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / f"bars.{fmt}")
        save_dataset(bars, path, fmt)
        back = load_dataset(spark, {"save": {"path": path}})
        assert set(back.columns) == set(bars.columns)
        assert values(back, *bars.columns) == values(bars, *bars.columns)
        assert dict(back.dtypes)["Close"] == "double"


def test_series_names_stay_text_and_need_no_folders(spark, tmp_path):
    df = series(spark, [1.0, 2.0], "007").unionByName(series(spark, [3.0], "8"))
    for fmt, split in itertools.product(("parquet", "csv"), ("series_id", None)):
        path = str(tmp_path / f"{split}.{fmt}")
        save_dataset(df, path, fmt, split)
        back = load_dataset(spark, {"path": path})
        assert values(back, "series_id", "Close") == [("007", 1.0), ("007", 2.0), ("8", 3.0)]


def test_dataset_errors(spark, tmp_path, bars):
    with pytest.raises(ValueError, match="parquet"):
        save_dataset(bars, str(tmp_path / "x"), "feather")
    with pytest.raises(ValueError, match="parquet"):
        load_dataset(spark, {"path": str(tmp_path / "x.feather")})
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, {"path": str(tmp_path / "none.parquet")})
    with pytest.raises(ValueError):
        dataset_path({"save": {}})


def test_macro_series(spark):
    macro = macro_table(spark, [("x", START, 1.0), ("y", START + timedelta(days=1), 2.0), ("z", START, None)])
    wide = fetch_macro(macro, {"x": "ex", "y": "why"}).orderBy("ts").collect()
    assert [(r.ex, r.why) for r in wide] == [(1.0, None), (None, 2.0)]
    assert fetch_macro(macro, ["x"]).columns == ["ts", "x"]
    with pytest.raises(ValueError, match="'z', 'gone'"):
        fetch_macro(macro, ["x", "z", "gone"])
    with pytest.raises(ValueError):
        fetch_macro(macro, [])


# --- alignment


@pytest.fixture(params=["broadcast", "salted"])
def join_way(request, spark):
    if request.param == "salted":
        spark.conf.set("spark.tidemark.broadcastRows", "0")
    yield request.param
    spark.conf.unset("spark.tidemark.broadcastRows")


def test_weekend_observation_is_lost(spark, join_way):
    days = [FRIDAY, FRIDAY + timedelta(days=3), FRIDAY + timedelta(days=4)]
    bars = spark.createDataFrame([("s", d, i, 1.0) for i, d in enumerate(days)],
                                 "series_id string, ts timestamp, ordinal long, Close double")
    macro = fetch_macro(macro_table(spark, [("m", FRIDAY + timedelta(days=2), 5.0)]), ["m"])
    joined = align.attach_macro(bars, macro)
    assert values(align.fill_macro(joined, ["m"]), "m") == [None, None, None]
    assert "m" not in aligned_dataset(bars, macro).columns
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (join_way == "salted")


@pytest.mark.parametrize(
    "policy, expected", [("ffill", [3.0, 3.0, 3.0, 7.0, 7.0]), ("bfill", [3.0, 3.0, 7.0, 7.0, 7.0]),
                         ("nearest", [3.0, 3.0, 3.0, 7.0, 7.0]), (None, [3.0, 3.0, 3.0, 7.0, 7.0])]
)
def test_fill_policies(spark, join_way, policy, expected):
    bars = series(spark, [1.0] * 5)
    macro = fetch_macro(
        macro_table(spark, [("m", START + timedelta(days=1), 3.0), ("m", START + timedelta(days=3), 7.0)]), ["m"]
    )
    assert values(align.fill_macro(align.attach_macro(bars, macro), ["m"], policy), "m") == expected
    with pytest.raises(ValueError, match="ffill"):
        align.fill_macro(bars, ["Close"], "cubic")


def test_join_on_date(spark):
    bars = series(spark, [1.0, 2.0], step=timedelta(hours=7))
    macro = fetch_macro(macro_table(spark, [("m", START, 5.0)]), ["m"])
    assert values(align.attach_macro(bars, macro), "m") == [5.0, None]
    assert values(align.attach_macro(bars, macro, on="date"), "m") == [5.0, 5.0]
    with pytest.raises(ValueError):
        align.attach_macro(bars, macro, on="week")


def test_ingest_drops_incomplete_bars_after_filling(spark, tmp_path):
    bars = series(spark, [1.0, None, 3.0], "t")
    macro = macro_table(spark, [("m", START + timedelta(days=1), 5.0)])
    path = str(tmp_path / "out.parquet")
    got = fetch_market_data(bars, ticker="t", start="2024-01-01", end="2024-02-01", macro=macro,
                            macro_series={"m": "em"}, save_path=path)
    assert values(got, "Close", "em") == [(1.0, 5.0), (3.0, 5.0)]
    assert load_dataset(spark, {"path": path}).count() == 2
    config = {"ticker": "t", "start": "2024-01-01", "end": "2024-02-01", "macro": {"series": {"m": "em"}}}
    assert "em" in ingest_from_config(bars, config, macro).columns
    assert "em" not in ingest_from_config(bars, config, macro, skip_macro=True).columns
    with pytest.raises(ValueError, match="ticker"):
        ingest_from_config(bars, {"start": "2024-01-01", "end": "2024-02-01"})
    with pytest.raises(ValueError, match="macro"):
        ingest_from_config(bars, config)  # series are named, but there is no table
    every = ingest_from_config(bars, {**config, "ticker": None, "save": {}}, skip_macro=True)
    assert every.select("series_id").distinct().count() == bars.select("series_id").distinct().count()
    dated = {**config, "save": {}, "macro": {**config["macro"], "on": "date"}}
    noon = macro.withColumn("ts", F.col("ts") + F.expr("interval 12 hours"))
    assert ingest_from_config(bars, dated, noon).filter("em is not null").count() > 0


# --- cleaning


def test_numbers_to_double_reads_nan_as_null(spark):
    df = spark.createDataFrame([("s", 1, math.nan, "x"), ("s", 2, 1.5, "y")],
                               "series_id string, a int, b double, c string")
    got = clean.numbers_to_double(df)
    assert dict(got.dtypes) == {"series_id": "string", "a": "double", "b": "double", "c": "string"}
    assert got.filter("b is null").count() == 1


def test_keep_one_per_key(spark):
    df = spark.createDataFrame(
        [("s", START, 1, 1.0), ("s", START, 3, None), ("s", START, 2, 2.0), ("t", START, 4, 9.0)],
        "series_id string, ts timestamp, ordinal long, Close double")
    assert values(clean.keep_one_per_key(df, "last"), "ordinal", "Close") == [(3, None), (4, 9.0)]
    assert values(clean.keep_one_per_key(df, "first"), "ordinal", "Close") == [(1, 1.0), (4, 9.0)]
    with pytest.raises(ValueError):
        clean.keep_one_per_key(df, "any")


def test_column_rules(spark):
    df = spark.createDataFrame([(1.0, None, math.nan)], "a double, b double, c double")
    assert clean.empty_columns(df, ["a", "b"]) == ["b"]
    assert clean.drop_empty_columns(df, ["a", "b"]).columns == ["a", "c"]
    assert tuple(clean.fill_missing(df, 7).first()) == (1.0, 7.0, 7.0)
    assert tuple(clean.fill_missing(df, 7, ["b"]).first())[:2] == (1.0, 7.0)
    assert clean.impose_columns(df, ["z", "a"]).first().asDict() == {"z": 0.0, "a": 1.0}
    names = ["Open", "Close", "Close_target_h5", "Volume"]
    assert clean.base_columns(names, "Close") == ["Open", "Volume"]
    assert clean.base_columns(names, "Close", ["Volume"]) == ["Volume"]
    assert clean.drop_rows_with_nulls(df).count() == 0
    with pytest.raises(TypeError):
        clean.fill_missing([1, None])


# --- profiles


def test_profiles(spark):
    df = series(spark, [1.0, None, 3.0])
    assert profile.null_counts(df, ["series_id", "Close"]).collect()[0] == ("Close", 1)
    rows = {r.column: (r.type, r["values"]) for r in profile.completeness(df).collect()}
    assert rows["Close"] == ("double", 2) and rows["ordinal"] == ("bigint", 3)
    summary = profile.ingest_summary(df).first()
    assert tuple(summary) == (3, "2024-01-01T00:00:00", "2024-01-03T00:00:00")
    assert [r.Close for r in profile.first_rows(df, 2).collect()] == [1.0, None]
    assert [r.ordinal for r in profile.last_rows(df, 2).collect()] == [1, 2]
    assert profile.latest_row(df, ["Close"]).first().Close == 3.0


def test_range_profile_sees_a_step_back(spark):
    back = spark.createDataFrame(
        [("s", START, 0), ("s", START + timedelta(days=2), 1), ("s", START + timedelta(days=1), 2),
         ("s", START + timedelta(days=1), 3), ("t", START, 4)],
        "series_id string, ts timestamp, ordinal long")
    rows = {r.series_id: r for r in profile.range_profile(back).collect()}
    assert not rows["s"].is_monotonic and rows["t"].is_monotonic
    assert (rows["s"]["rows"], rows["s"].distinct_ts) == (4, 3)


def test_frequencies(spark):
    weekdays = [START + timedelta(days=d) for d in range(12) if (START + timedelta(days=d)).weekday() < 5]
    business = spark.createDataFrame([("b", d, i) for i, d in enumerate(weekdays)],
                                     "series_id string, ts timestamp, ordinal long")
    hourly = series(spark, [1.0] * 4, "h", timedelta(hours=1)).drop("Close")
    odd = spark.createDataFrame([("o", START + timedelta(days=d), d) for d in (0, 1, 5)],
                                "series_id string, ts timestamp, ordinal long")
    single = series(spark, [1.0], "one").drop("Close")
    df = business.unionByName(hourly).unionByName(odd).unionByName(single)
    got = {r.series_id: r.frequency for r in profile.infer_frequency(df).collect()}
    assert got == {"b": "B", "h": "3600", "o": None}


def test_missing_days(spark):
    df = spark.createDataFrame([("s", START + timedelta(days=d), d) for d in (0, 1, 4)],
                               "series_id string, ts timestamp, ordinal long")
    assert [str(r.day) for r in profile.missing_days(df).orderBy("day").collect()] == ["2024-01-03", "2024-01-04"]


# --- splits


def test_fold_example(spark):
    folds = expanding_folds(series(spark, [1.0] * 103), 3, 1).groupBy("fold", "role").agg(
        F.min("ordinal").alias("a"), F.max("ordinal").alias("b")).collect()
    got = {(r.fold, r.role): (r.a, r.b + 1) for r in folds}
    assert [got[i, "train"] for i in range(3)] == [(0, 27), (0, 52), (0, 77)]
    assert [got[i, "test"] for i in range(3)] == [(28, 53), (53, 78), (78, 103)]
    with pytest.raises(ValueError):
        expanding_folds(series(spark, [1.0]), 1)


@pytest.mark.parametrize("n, gap", [(100, 0), (100, 1), (37, 3)])
def test_split_sizes(spark, n, gap):
    df = temporal_split(series(spark, [float(i) for i in range(n + 5)]), "Close", gap=gap, horizon=5)
    a = int(n * 0.7)
    b = a + int(n * 0.15)
    expected = {"train": range(0, a - gap), "val": range(a + gap, b), "test": range(b + gap, n)}
    rows = df.collect()
    for split, places in expected.items():
        assert sorted(r.ordinal for r in rows if r.split == split) == list(places)
    assert all(r.Close_target_h5 == r.Close + 5 for r in rows)


def test_purge_keeps_labels_inside_their_split(spark):
    df = temporal_split(series(spark, [float(i) for i in range(200)]), "Close", gap=1, horizon=5, purge=5)
    ends = {r.split: (r.a, r.b) for r in df.groupBy("split").agg(
        F.min("ordinal").alias("a"), F.max("Close_target_h5").alias("b")).collect()}
    assert ends["train"][1] < ends["val"][0] and ends["val"][1] < ends["test"][0]


def test_split_errors(spark):
    short = series(spark, [1.0] * 6)
    with pytest.raises(ValueError, match="Too few"):
        temporal_split(short, "Close", horizon=3)
    both = short.unionByName(series(spark, [1.0] * 90, "long"))
    with pytest.raises(ValueError, match="'s'"):
        temporal_split(both, "Close", horizon=3)
    kept = temporal_split(both, "Close", horizon=3, short_series="drop")
    assert {r.series_id for r in kept.select("series_id").distinct().collect()} == {"long"}
    with pytest.raises(KeyError):
        add_label(short, "Price", 1)
    with pytest.raises(ValueError):
        add_label(short, "Close", 0)


# --- statistics


@pytest.fixture(scope="module")
def wide(spark):
    draw = np.random.default_rng(3)
    frame = pd.DataFrame(draw.normal(1e6, 3, (400, 4)), columns=list("abcd"))
    frame["b"] = frame["a"] * 2 + draw.normal(0, 1, 400)
    frame["c"] = frame["b"] + draw.normal(0, 1, 400)
    frame["e"] = 5.0
    frame = frame.mask(draw.random(frame.shape) < 0.2)
    frame["e"] = 5.0
    return frame, spark.createDataFrame(frame.astype(object).where(frame.notna(), None),
                                        "a double, b double, c double, d double, e double")


def test_correlation_equals_pandas(wide):
    frame, df = wide
    expected = frame.corr()
    for r in moments.pairwise_correlation(df, list("abcde")).collect():
        if "e" in (r.a, r.b):
            assert r.corr is None
        else:
            assert r.corr == pytest.approx(expected.loc[r.a, r.b], abs=1e-9)
            assert r.n == (frame[r.a].notna() & frame[r.b].notna()).sum()


@pytest.mark.parametrize("tile", [1, 2, 3])
def test_correlation_by_tiles(spark, wide, monkeypatch, tile):
    _, df = wide
    cells = lambda d: {(r.a, r.b): (r.n, r.corr) for r in d.collect()}
    whole = cells(moments.pairwise_correlation(df, list("abcde")))
    monkeypatch.setattr(moments, "_TILE", tile)
    parts = cells(moments.pairwise_correlation(df, list("abcde")))
    assert set(parts) == set(whole) and len(whole) == 10
    for key, (n, corr) in whole.items():
        assert parts[key][0] == n and parts[key][1] == (corr if corr is None else pytest.approx(corr, rel=1e-12))


def test_correlated_columns_count_dropped_ones(wide):
    _, df = wide
    # b goes because of a; c goes because of b, though b is gone itself.
    assert moments.correlated_columns(df, list("abcde"), 0.9) == ["b", "c"]
    assert moments.correlated_columns(df, list("dabc"), 0) == []
    assert moments.correlated_columns(df, ["a", "none"], 0.5) == []


@pytest.mark.parametrize("few", [3, 50, 10_000])
def test_exact_quantiles_equal_numpy(spark, few):
    draw = random.Random(9)
    # A third of the rows share one value; another column has a heavy top value.
    rows = [
        (draw.gauss(0, 1), 4.0 if i % 3 == 0 else draw.uniform(0, 9), 7.0 if i % 2 else draw.random(), None if i else 1.0, 2.5)
        for i in range(1001)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    wanted = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = quantiles.exact_quantiles(df, list("abcde"), wanted, few)
    for i, c in enumerate("abcde"):
        column = np.array([r[i] for r in rows if r[i] is not None])
        assert got[c] == pytest.approx(list(np.quantile(column, wanted)))
    empty = df.filter("a is null")
    assert quantiles.exact_quantiles(empty, ["a"], (0.5,)) == {"a": [None]}


@pytest.mark.parametrize("kind", ["standard", "minmax", "robust", "Standard_Scaler"])
def test_scalers_equal_numpy(wide, kind):
    frame, df = wide
    got = scaling.fit_scaler(df, list("abe"), kind)
    filled = frame.fillna(frame.mean())
    for c in "abe":
        x = filled[c].to_numpy()
        low, mid, high = np.quantile(x, (0.25, 0.5, 0.75))
        expected = {
            "standard": (x.mean(), x.std()), "minmax": (x.min(), x.max() - x.min()), "robust": (mid, high - low),
        }[scaling.scaler_kind(kind)]
        assert got[c] == pytest.approx((expected[0], expected[1] or 1.0), rel=1e-9)


def test_scaled_columns_keep_nulls_and_have_mean_zero(wide):
    frame, df = wide
    out = scaling.apply_scaler(df, scaling.fit_scaler(df, list("abcde"), "standard")).toPandas()
    assert (out.isna() == frame.isna()).all().all()
    assert out.mean().abs().max() < 1e-9
    assert (out["e"] == 0).all()
    with pytest.raises(ValueError, match="minmax"):
        scaling.fit_scaler(df, ["a"], "power")


def test_metrics_equal_numpy(spark):
    draw = np.random.default_rng(1)
    y, f = draw.normal(0, 5, 50), draw.normal(0, 5, 50)
    rows = [(float(a), float(b)) for a, b in zip(y, f)] + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "y double, f double")
    got = metrics.evaluate_one(df, "y", "f")
    e = y - f
    assert got == pytest.approx({
        "rmse": math.sqrt((e**2).mean()), "mae": np.abs(e).mean(), "mse": (e**2).mean(),
        "mape": 100 * np.abs(e / (y + 1e-8)).mean(), "r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
    })
    score = metrics.score_column("neg_mean_absolute_percentage_error", "y", "f")
    assert df.agg(score).first()[0] == pytest.approx(-np.abs(e / y).mean())
    constant = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, f double")
    assert metrics.evaluate_one(constant, "y", "f")["r2"] is None
    with pytest.raises(ValueError):
        metrics.evaluate_one(df.filter("y is null"), "y", "f")
    with pytest.raises(ValueError, match="Options"):
        metrics.score_column("accuracy", "y", "f")


def test_leaderboard_and_fold_summary(spark):
    results = spark.createDataFrame([("a", 0, 2.0, 0.1), ("b", 1, 1.0, 0.9), ("c", 2, 1.0, 0.5)],
                                    "candidate string, position int, rmse double, r2 double")
    order = lambda m: [r.candidate for r in metrics.leaderboard(results, m).orderBy("place").collect()]
    assert order("rmse") == ["b", "c", "a"]
    assert order("r2") == ["b", "c", "a"]
    with pytest.raises(KeyError):
        metrics.leaderboard(results, "accuracy")
    scores = spark.createDataFrame([("p", 0, 1.0), ("p", 1, 3.0), ("q", 0, 2.0), ("q", 1, 2.0), ("r", 0, 0.0)],
                                   "params string, fold int, score double")
    got = {r.params: (r.mean_test_score, r.std_test_score, r.rank_test_score)
           for r in metrics.summarize_folds(scores).collect()}
    assert got == {"p": (2.0, 1.0, 1), "q": (2.0, 0.0, 1), "r": (0.0, 0.0, 3)}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_macro_on_date_takes_the_last_of_the_day(spark):
    bars = series(spark, [1.0, 2.0], step=timedelta(hours=10))
    macro = spark.createDataFrame([(START + timedelta(hours=1), 9.0, None), (START + timedelta(hours=9), 3.0, 5.0),
                                   (START + timedelta(hours=12), None, None)], "ts timestamp, a double, b double")
    got = align.attach_macro(bars, macro, on="date")
    assert values(got, "a", "b") == [(3.0, 5.0), (3.0, 5.0)]


def test_fill_policy_names(spark):
    df = series(spark, [None, 1.0, None, 2.0, None])
    assert values(align.fill_macro(df, ["Close"], "pad"), "Close") == values(align.fill_macro(df, ["Close"], "ffill"), "Close")
    assert values(align.fill_macro(df, ["Close"], "backfill"), "Close") == values(align.fill_macro(df, ["Close"], "bfill"), "Close")
    with pytest.raises(ValueError):
        align.fill_macro(df, ["Close"], "cubic")


def test_nearest_fill(spark, blocks):
    """The closer neighbour in time, of two the earlier; ends take the only one; times, not places."""
    rows = [("s", START + timedelta(hours=h), i, v) for i, (h, v) in enumerate(
        [(0, None), (1, 1.0), (2, None), (9, None), (10, 2.0), (12, None), (14, 3.0), (99, None)])]
    rows += [("none", START, 0, None)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, ordinal long, m double")
    want = [None, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 3.0, 3.0]
    assert values(align.fill_macro(df, ["m"], "nearest"), "m") == want
    blocks(2)
    assert values(align.fill_macro(df, ["m"], "nearest"), "m") == want


def test_csv_with_other_names(spark, tmp_path):
    """A time column named otherwise, and a file of one series without a column for it."""
    (tmp_path / "one.csv").write_text("Date,Close,note\n2024-01-02,1.5,a\n2024-01-01,2.5,b\n")
    got = load_dataset(spark, {"path": str(tmp_path / "one.csv"), "time_column": "Date", "series": "X"})
    assert [(r.series_id, str(r.ts.date()), r.Close, r.note) for r in got.orderBy("ordinal").collect()] == [
        ("X", "2024-01-01", 2.5, "b"), ("X", "2024-01-02", 1.5, "a")]
    with pytest.raises((KeyError, ValueError)):
        load_dataset(spark, {"path": str(tmp_path / "one.csv"), "time_column": "When"})


def test_csv_keeps_text(spark, tmp_path):
    path = str(tmp_path / "data.csv")
    df = series(spark, [1.5, None]).withColumn("note", F.lit("hello"))
    save_dataset(df, path, "csv", split_by=None)
    got = load_dataset(spark, {"path": path})
    assert dict(got.dtypes)["note"] == "string" and dict(got.dtypes)["Close"] == "double"
    assert values(got, "note", "Close") == [("hello", 1.5), ("hello", None)]


def test_ingest_of_all_series_checks_its_range(spark, bars):
    with pytest.raises(ValueError, match="before"):
        fetch_market_data(bars, ticker=None, start="2025-01-01", end="2024-01-01")
    with pytest.raises(ValueError, match="any series"):
        fetch_market_data(bars, ticker=None, start="1990-01-01", end="1991-01-01")
    with pytest.raises(ValueError, match="macro"):
        fetch_market_data(bars, ticker=None, start="2024-01-01", end="2025-01-01", macro_series=["A"])


def test_quantiles_ignore_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (2.0,)], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]) == {"x": [1.0, 2.0, 3.0]}


def _wide_with_gaps(spark, rows: int, width: int):
    """Columns with a tenth of the values missing, made by one projection."""
    value = "pmod(xxhash64(id, {i}), 1000003) / {i}.5D"
    items = [f"if(pmod(xxhash64(id, -{i}), 10) = 0, null, {value.format(i=i)}) as x{i}" for i in range(1, width + 1)]
    return spark.range(0, rows, 1, 4).selectExpr(*items)


def _filled_statistics(df) -> dict[str, tuple[float, float]]:
    frame = df.toPandas()
    low, mid, high = np.quantile(frame.fillna(frame.mean()), (0.25, 0.5, 0.75), axis=0)
    return {c: (m, h - q) for c, q, m, h in zip(frame.columns, low, mid, high)}


def test_robust_scaling_keeps_few_of_the_values(spark, monkeypatch):
    df = _wide_with_gaps(spark, 40_000, 8)
    kept, write = [], session.write_shared

    def written(df, *args):
        path = write(df, *args)
        kept.append(spark.read.parquet(path).count() * len(df.columns))
        return path

    monkeypatch.setattr(session, "write_shared", written)
    got, expected = scaling.fit_scaler(df, df.columns, "robust"), _filled_statistics(df)
    for c in df.columns:
        assert got[c] == pytest.approx(expected[c], rel=1e-9)
    assert sum(kept) < 0.15 * 40_000 * 8


@pytest.mark.parametrize("slack", [-0.02, 0.0, 0.6])
def test_quantiles_do_not_rest_on_the_sketch(spark, monkeypatch, slack):
    """Brackets that miss the ranks cost another pass, wide ones more rows."""
    monkeypatch.setattr(quantiles, "_SLACK", slack)
    df = _wide_with_gaps(spark, 20_000, 3)
    wanted, frame = [0.0, 0.001, 0.3, 0.301, 0.5, 0.999, 1.0], df.toPandas()
    got = quantiles.exact_quantiles(df, df.columns, wanted, 50)
    fitted, expected = scaling.fit_scaler(df, df.columns, "robust"), _filled_statistics(df)
    for c in df.columns:
        assert got[c] == pytest.approx(list(np.quantile(frame[c].dropna(), wanted)), rel=1e-12)
        assert fitted[c] == pytest.approx(expected[c], rel=1e-9)


def test_robust_scaling_of_odd_columns(spark):
    """Mostly missing, no value, NaN, one value, negative and both zeros, infinities, whole numbers."""
    inf, nan = math.inf, math.nan
    rows = [
        (float(i) if i < 3 else None, None, nan if i == 5 else float(i), 0.1, -0.0 if i % 2 else 0.0,
         -inf if i < 4 else inf if i > 15 else float(i), i if i % 3 else None)
        for i in range(20)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g long")
    got, empty = scaling.fit_columns(df, list("abcdefg"), "robust")
    assert empty == ["b"]
    assert got["a"] == (1.0, 1.0) and got["b"] == (0.0, 1.0) and got["d"] == (0.1, 1.0) and got["e"] == (0.0, 1.0)
    low, mid, high = np.quantile([i for i in range(20) if i != 5], (0.25, 0.5, 0.75))
    assert got["c"] == pytest.approx((mid, high - low))
    assert got["f"] == pytest.approx((9.5, 9.5))
    g = np.array([r[6] if r[6] is not None else nan for r in rows])
    low, mid, high = np.quantile(np.where(np.isnan(g), np.nanmean(g), g), (0.25, 0.5, 0.75))
    assert got["g"] == pytest.approx((mid, high - low))


def test_long_code_is_compiled_while_statistics_are_taken(spark):
    """The setting holds for the pass only."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    with session.compiled(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("interval", ["1d", "36h", "1wk", "1mo"])
def test_bounds_reach_the_ticks(spark, tmp_path, interval):
    """Bounded bars are the bounded part of all bars, and both bounds are pushed to the scan."""
    draw = random.Random(2)
    rows = [("s", START + timedelta(hours=7 * i), i, draw.uniform(1, 9)) for i in range(400)]
    path = str(tmp_path / "ticks")
    spark.createDataFrame(rows, "s string, t timestamp, id long, p double").write.parquet(path)
    make = lambda **more: bar_source.bars_from_ticks(
        spark.read.parquet(path), series="s", ts="t", price="p", order=["id"], interval=interval, **more)
    bounded = make(start="2024-02-05", end="2024-03-11")
    want = make().filter("ts >= '2024-02-05' and ts < '2024-03-11'")
    assert sorted(map(tuple, bounded.collect())) == sorted(map(tuple, want.collect())) != []
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


def test_scratch_removes_frozen_tables(spark):
    with scratch(spark):
        path = write_shared(spark.range(3))
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()


def test_broadcast_limit_counts_width(spark):
    spark.conf.set("spark.tidemark.broadcastRows", "100")
    narrow = spark.range(90)
    wide = narrow.selectExpr("id", *[f"id AS c{i}" for i in range(30)])
    assert fits_broadcast(narrow) and not fits_broadcast(wide) and fits_broadcast(wide.limit(20))
    spark.conf.unset("spark.tidemark.broadcastRows")
