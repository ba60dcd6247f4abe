"""Stages, estimators, selection, tuning, competition, registry, forecast."""

from __future__ import annotations

import itertools
import json
import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.conftest import START, series, values
from tidemark.ml import knn
from tidemark.ml.competition import Candidate, choose_features, complete_rows, feature_stages, run_competition
from tidemark.ml.estimators import ESTIMATORS, create_estimator
from tidemark.ml.linear import lasso
from tidemark.ml.selection import (
    SelectionConfig,
    elimination_sizes,
    load_selected_features,
    save_selection,
    select_features,
    with_folds,
)
from tidemark.ml.stages import (
    ColumnScaler,
    FeatureAssembler,
    FeatureSubset,
    FeatureVector,
    FillMissing,
    extra_stage,
    feature_columns,
)
from tidemark.ml.tuning import TuningConfig, parameter_sets, save_tuning, search
from tidemark.operators.split import temporal_split
from tidemark.plans.forecast import forecast, forecast_from_registry, required_history
from tidemark.plans.ingest import fetch_market_data
from tidemark.plans.train import run_training
from tidemark.sources.models import latest_versions, load_latest, register_model
from tidemark.sources.runs import RunLog, metrics_report, read_runs, run_values

LABEL = "Close_target_h5"
ASSEMBLER = {"lags": 3, "returns": [1], "rolling_windows": [3]}


@pytest.fixture(scope="module")
def splits(bars):
    return temporal_split(bars, "Close", gap=1, horizon=5).cache()


@pytest.fixture(scope="module")
def train(splits):
    return splits.filter("split = 'train'")


# --- stages


def test_assembler_columns_scale_and_nulls(train):
    model = FeatureAssembler(**ASSEMBLER, attach_base=True, scaler="standard").fit(train)
    out = model.transform(train)
    base = ["Open", "High", "Low", "Volume"]
    built = ["Close_lag_1", "Close_lag_2", "Close_lag_3", "Close_ret_1", "Close_sma_3", "Close_std_3",
             "amplitude", "nominal_value"]
    assert model.feature_columns() == base + built
    assert out.columns == ["series_id", "ts", "ordinal", LABEL, "split", *base, *built]
    frame = out.toPandas()
    assert frame[base + built].mean().abs().max() < 1e-9
    assert frame["Close_lag_3"].isna().sum() == 9  # three rows in each of three series


def test_windows_stop_at_the_slice(splits):
    model = FeatureAssembler(**ASSEMBLER).fit(splits)
    rows = model.transform(splits).filter("series_id = 'big'").toPandas()
    assert rows.groupby("split")["Close_lag_2"].apply(lambda c: c.isna().sum()).tolist() == [2, 2, 2]


def test_fitted_columns_are_imposed(train):
    empty = train.withColumn("gap", F.lit(None).cast("double"))
    bare = FeatureAssembler(**ASSEMBLER, attach_base=True, base_columns=["Open", "gap"])
    model = bare.fit(empty)
    assert model.feature_columns()[:2] == ["Open", "gap"]  # base columns stay even if empty
    with pytest.raises(KeyError, match="gap"):
        model.transform(train)
    everything = FeatureAssembler(**ASSEMBLER, attach_base=True).fit(train)
    other = train.drop("Open").withColumn("extra", F.lit(1.0))
    out = everything.transform(other)
    assert "extra" not in out.columns and {r.Open for r in out.collect()} == {0.0}
    none = train.withColumn("Close", F.lit(None).cast("double"))
    assert FeatureAssembler(**ASSEMBLER).fit(none).feature_columns() == ["amplitude"]


def test_stage_errors(train):
    for settings in ({"lags": 0}, {"returns": [0]}, {"rolling_windows": [-2]}, {"scaler": "power"}):
        with pytest.raises(ValueError):
            FeatureAssembler(**{**ASSEMBLER, **settings})
    with pytest.raises(TypeError, match="Options"):
        FeatureAssembler(lag=3)
    assert FeatureAssembler(scaler=ColumnScaler(kind="robust")).setting("scaler") == "robust"
    with pytest.raises(KeyError, match="High"):
        FeatureAssembler(**ASSEMBLER).fit(train.drop("High"))
    with pytest.raises(ValueError, match="standard_scaler"):
        extra_stage("power")


def test_subset_fill_and_vector(train):
    wide = FeatureAssembler(**ASSEMBLER).fit(train).transform(train)
    filled = FillMissing().transform(wide)
    assert filled.dropna().count() == train.count()
    subset = FeatureSubset(features=["none", "amplitude"], fail_on_missing=False)
    assert subset.missing(filled) == ["none"]
    out = subset.transform(filled)
    assert out.columns == ["series_id", "ts", "ordinal", LABEL, "split", "none", "amplitude"]
    assert feature_columns(out) == ["none", "amplitude"]
    with pytest.raises(KeyError, match="none"):
        FeatureSubset(features=["none"]).transform(filled)
    vector = FeatureVector().transform(out)
    assert vector.columns == ["series_id", "ts", "ordinal", LABEL, "split", "features"]
    scaled = ColumnScaler(kind="minmax").fit(out).transform(out).toPandas()
    assert scaled["amplitude"].min() == 0 and scaled["amplitude"].max() == 1
    assert scaled["none"].eq(0).all()


def test_whole_model_is_saved_and_loaded(train, splits, tmp_path):
    stages = feature_stages(
        FeatureAssembler(**ASSEMBLER, attach_base=True, scaler="robust"), None, ["standard_scaler"]
    )
    held = splits.filter("split = 'val'")
    for name in ("linear_regression", "knn"):
        model = Pipeline(stages=[*stages, create_estimator(name, {}, LABEL)]).fit(train)
        model.write().save(str(tmp_path / name))
        loaded = PipelineModel.load(str(tmp_path / name))
        want = values(model.transform(held), "prediction")
        assert values(loaded.transform(held), "prediction") == pytest.approx(want)


# --- estimators


@pytest.fixture(scope="module")
def regression(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(200, 4)) * [1, 2, 3, 4]
    y = x @ [3.0, 0.0, -2.0, 0.5] + 7 + draw.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                               "a double, b double, c double, d double, label double")
    return x, y, VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)


def test_linear_estimators_equal_closed_forms(regression):
    x, y, df = regression
    xc, yc = x - x.mean(0), y - y.mean()
    ols = create_estimator("linear_regression").fit(df)
    assert ols.coefficients.toArray() == pytest.approx(np.linalg.lstsq(xc, yc, rcond=None)[0])
    ridge = create_estimator("ridge", {"alpha": 50.0}).fit(df)
    expected = np.linalg.solve(xc.T @ xc + 50 * np.eye(4), xc.T @ yc)
    assert ridge.coefficients.toArray() == pytest.approx(expected, rel=1e-6)
    l1 = create_estimator("lasso", {"alpha": 0.7, "max_iter": 1000, "tol": 1e-12}).fit(df)
    expected = lasso(xc.T @ xc / 200, xc.T @ yc / 200, 0.7)
    assert l1.coefficients.toArray() == pytest.approx(expected, abs=1e-6)


def test_lasso_meets_its_conditions_with_dependent_features():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(80, 6))
    x[:, 3] = x[:, 0] - x[:, 1]
    y = x @ draw.normal(size=6)
    xx, xy = x.T @ x / 80, x.T @ y / 80
    for alpha in (1e-3, 0.1, 0.5, 100.0):
        w = lasso(xx, xy, alpha)
        slope = xx @ w - xy
        assert np.abs(slope).max() <= alpha * 1.01
        assert slope[w != 0] == pytest.approx(-alpha * np.sign(w[w != 0]), rel=1e-2)


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "gradient_boosting"])
def test_trees_beat_the_mean(regression, name):
    _, y, df = regression
    size = {} if name == "decision_tree" else {"n_estimators": 5}
    model = create_estimator(name, {"max_depth": 4, "random_state": 1, **size}).fit(df)
    error = model.transform(df).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert error < 0.5 * y.var()


def test_estimator_errors():
    with pytest.raises(KeyError, match="ridge"):
        create_estimator("svr")
    with pytest.raises(ValueError, match="n_estimators"):
        create_estimator("random_forest", {"trees": 3})
    assert create_estimator("decision_tree").getMaxDepth() == 30
    assert set(ESTIMATORS) >= {"linear_regression", "lasso", "ridge", "knn"}


def test_neighbours_visit_few_blocks(spark, monkeypatch):
    """Eight features of like spread; predictions are exact all the same."""
    monkeypatch.setattr(knn, "_BLOCK_ROWS", 100)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(12_000, 8))
    label = draw.normal(size=12_000)
    df = spark.createDataFrame(
        [(*map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, label))],
        ", ".join(f"f{i} double" for i in range(8)) + ", label double, id int",
    )
    rows = VectorAssembler(inputCols=[f"f{i}" for i in range(8)], outputCol="features").transform(df)
    model = create_estimator("knn", {"n_neighbors": 5}).fit(rows)
    asked = rows.filter("id % 60 = 0")
    assert model.table(spark).select("block").distinct().count() == 128
    assert model.visited_share(asked) <= 0.3
    got = model.transform(asked).orderBy("id").select("prediction").collect()
    distance = ((x[::60, None] - x[None]) ** 2).sum(-1)
    expected = [label[np.argsort(d, kind="stable")[:5]].mean() for d in distance]
    assert [r.prediction for r in got] == pytest.approx(expected)


@pytest.mark.parametrize("block, share", [(10_000, 10_000), (17, 5), (1, 3)])
def test_neighbours_equal_brute_force(spark, monkeypatch, blocks, block, share):
    """Small blocks and shares, many equal rows, and queries far outside the data."""
    monkeypatch.setattr(knn, "_BLOCK_ROWS", block)
    monkeypatch.setattr(knn, "_NEXT", 2)
    monkeypatch.setattr(knn, "_QUERIES_PER_TASK", share)
    monkeypatch.setattr(knn, "_PAIRS_AT_ONCE", 50)
    blocks(40)
    draw = np.random.default_rng(8)
    known = np.vstack([draw.normal(size=(60, 3)), np.zeros((35, 3))])
    label = draw.normal(size=len(known))
    label[60:] = 4.0  # equal rows have equal labels, so that any choice among them is right
    asked = np.vstack([draw.normal(size=(25, 3)), np.full((2, 3), 40.0), np.zeros((9, 3))])

    def frame(x, y):
        df = spark.createDataFrame([(*map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, y))],
                                   "a double, b double, c double, label double, id int")
        return VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df)

    model = create_estimator("knn", {"n_neighbors": 4}).fit(frame(known, label))
    got = model.transform(frame(asked, np.zeros(len(asked)))).orderBy("id").select("prediction").collect()
    distance = ((asked[:, None] - known[None]) ** 2).sum(-1)
    expected = [label[np.argsort(d, kind="stable")[:4]].mean() for d in distance]
    assert [r.prediction for r in got] == pytest.approx(expected)
    with pytest.raises(ValueError):
        create_estimator("knn", {"n_neighbors": 500}).fit(frame(known, label))


# --- selection


def brute_force(x, y, folds, least, step, score):
    """Elimination with least squares, written without sums of products."""

    def path(xt, yt, least):
        kept = list(range(x.shape[1]))
        out = []
        while True:
            middle = xt[:, kept].mean(0)
            w = np.linalg.lstsq(xt[:, kept] - middle, yt - yt.mean(), rcond=None)[0]
            w = np.concatenate([[yt.mean() - middle @ w], w])
            out.append((list(kept), w))
            if len(kept) == least:
                return out
            n = min(step, len(kept) - least)
            gone = {kept[i] for i in np.argsort(w[1:] ** 2, kind="stable")[:n]}
            kept = [i for i in kept if i not in gone]

    scores = [
        [score(y[test], np.column_stack([np.ones(len(test)), x[test][:, kept]]) @ w)
         for kept, w in path(x[train], y[train], least)]
        for train, test in folds
    ]
    means = np.mean(scores, axis=0)[::-1]
    sizes = [len(kept) for kept, _ in path(x, y, least)][::-1]
    best = sizes[int(np.argmax(means))]
    final = path(x, y, best)
    return means, [1 + sum(i not in kept for kept, _ in final) for i in range(x.shape[1])]


@pytest.mark.parametrize("scoring, step", [(None, 1), ("neg_mean_absolute_percentage_error", 2)])
def test_elimination_equals_brute_force(spark, scoring, step):
    draw = np.random.default_rng(6)
    n, p = 103, 6
    x = draw.normal(size=(n, p)) + 1e6  # far from zero: sums of squares lose digits
    y = (x - 1e6) @ [2.0, 0.0, 1.0, 0.05, -0.5, 0.0] + draw.normal(size=n) * 0.3 + 5
    names = [f"f{i}" for i in range(p)]
    df = spark.createDataFrame(
        [("s", START + timedelta(days=i), i, float(y[i]), *map(float, x[i])) for i in range(n)],
        f"series_id string, ts timestamp, ordinal long, {LABEL} double, " + ", ".join(f"{c} double" for c in names),
    )
    config = SelectionConfig("linear_regression", n_splits=3, gap=1, scoring=scoring, step=step)
    got = select_features(df, LABEL, config)

    def score(truth, guess):
        if scoring:
            return -np.mean(np.abs(truth - guess) / np.abs(truth))
        return 1 - ((truth - guess) ** 2).sum() / ((truth - truth.mean()) ** 2).sum()

    folds = [(np.arange(s - 1), np.arange(s, s + 25)) for s in (28, 53, 78)]
    means, ranking = brute_force(x, y, folds, 1, step, score)
    assert got.validation_scores == pytest.approx(list(means))
    assert got.ranking == ranking
    assert sum(got.support) == ranking.count(1) == len(got.selected_features)


def test_elimination_with_trees(train):
    matrix, _ = complete_rows(train, FeatureAssembler(**ASSEMBLER))
    config = SelectionConfig("decision_tree", {"max_depth": 2, "random_state": 1}, n_splits=2, min_features_to_select=3, step=3)
    got = select_features(matrix, LABEL, config)
    assert len(got.validation_scores) == len(elimination_sizes(8, 3, 3)) == 3
    assert sum(got.support) == len(got.selected_features) >= 3
    assert max(got.ranking) <= 3


def test_selection_rules(spark, train, tmp_path):
    matrix, original = complete_rows(train, FeatureAssembler(**ASSEMBLER, attach_base=True))
    config = SelectionConfig("lasso", {"alpha": 1e-4}, n_splits=2, min_features_to_select=3,
                             correlation_threshold=0.9, gap=1)
    got = choose_features(matrix, original, LABEL, config, "lasso")
    assert set(got.dropped_features) == {"High", "Low"}  # both follow Open
    assert not set(got.dropped_features) & set(got.columns)
    assert len(got.validation_scores) == len(got.columns) - 3 + 1
    assert max(got.ranking) == len(got.columns) - sum(got.support) + 1

    path = str(tmp_path / "selected.json")
    save_selection(spark, got, config, path)
    assert load_selected_features(spark, path) == got.selected_features
    (tmp_path / "bad.json").write_text(json.dumps({"selected_features": "Open"}))
    with pytest.raises(ValueError):
        load_selected_features(spark, str(tmp_path / "bad.json"))

    few = matrix.filter("series_id = 'small'").limit(2)
    passed = select_features(few, LABEL, config)
    assert all(passed.support) and set(passed.ranking) == {1} and passed.validation_scores == []
    assert all(choose_features(matrix, original, LABEL, None, "x").support)
    with pytest.raises(ValueError):
        select_features(matrix, LABEL, SelectionConfig("lasso", n_splits=1))
    with pytest.raises(ValueError, match="weights"):
        select_features(matrix, LABEL, SelectionConfig("knn"))
    with pytest.raises(ValueError):
        select_features(matrix.select("series_id", "ts", "ordinal", LABEL), LABEL, config)


def test_folds_never_train_on_the_future(spark):
    for n, k, gap in itertools.product((40, 101), (2, 4), (0, 3)):
        rows = with_folds(series(spark, [0.0] * n), k, gap).orderBy("ordinal").collect()
        for fold in range(k):
            train = [r.ordinal for r in rows if r._train_from <= fold]
            test = [r.ordinal for r in rows if r._test_fold == fold]
            assert train == list(range(test[0] - gap)) and len(test) == n // (k + 1)


# --- tuning, competition, jobs


def test_parameter_sets():
    grid = {"estimator__alpha": [1, 2, 3], "feature_assembler__lags": [2, 4]}
    assert len(parameter_sets(TuningConfig(param_grid=grid))) == 6
    config = TuningConfig("random", grid, n_iter=4, random_state=3)
    draws = parameter_sets(config)
    assert draws == parameter_sets(config) and len({json.dumps(d) for d in draws}) == 4
    assert len(parameter_sets(TuningConfig("random", grid, random_state=1))) == 6
    for bad in (TuningConfig(), TuningConfig(param_grid={"estimator__alpha": []}),
                TuningConfig("bayes", grid), TuningConfig(param_grid={"alpha": [1]})):
        with pytest.raises(ValueError):
            parameter_sets(bad)
    assert TuningConfig.from_mapping({"strategy": "GRID", "n_splits": 4, "artifact_dir": "x"}).strategy == "grid"


def test_search_scores_each_fold_like_a_fit_by_hand(train, tmp_path):
    stages = feature_stages(FeatureAssembler(**ASSEMBLER), None)
    config = TuningConfig(param_grid={"estimator__alpha": [0.1, 1e6]}, n_splits=2, gap=1, scoring="r2")
    result = search(stages, "ridge", {}, train, LABEL, config)
    folds = with_folds(train, 2, 1)
    got = {(r.params, r.fold): r.score for r in result.scores.collect()}
    assert len(got) == 4
    model = Pipeline(stages=[*stages, create_estimator("ridge", {"alpha": 0.1}, LABEL)]).fit(
        folds.filter("_train_from <= 1").drop("_train_from", "_test_fold"))
    test = folds.filter("_test_fold = 1").drop("_train_from", "_test_fold")
    rows = model.transform(test).toPandas()
    y, f = rows[LABEL], rows["prediction"]
    expected = 1 - ((y - f) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert got['{"estimator__alpha": 0.1}', 1] == pytest.approx(expected)
    assert result.best_params == {"estimator__alpha": 0.1}
    assert result.best_score == result.summary.agg(F.max("mean_test_score")).first()[0]
    assert result.model is not None
    save_tuning(result, config, str(tmp_path / "tuning"))
    saved = train.sparkSession.read.json(str(tmp_path / "tuning"))
    assert saved.count() == 4 and saved.filter("is_best").count() == 2
    assert json.loads(saved.first().param_grid) == config.param_grid


def test_competition(splits):
    candidates = [
        Candidate("flat", "ridge", {"alpha": 1e12}),
        Candidate("line", "linear_regression"),
        Candidate.from_mapping({"name": "tuned", "estimator": "ridge", "tuning": {
            "param_grid": {"estimator__alpha": [0.5, 1.0]}, "n_splits": 2}}),
    ]
    outcome = run_competition(splits, LABEL, FeatureAssembler(**ASSEMBLER, attach_base=True), candidates)
    by_name = {r.name: r for r in outcome.results}
    assert by_name["line"].metrics_val["rmse"] < by_name["flat"].metrics_val["rmse"]
    assert by_name["tuned"].params["estimator__alpha"] in (0.5, 1.0)
    assert outcome.best.name != "flat"
    scores = [r.rmse for r in outcome.leaderboard.orderBy("place").collect()]
    assert scores == sorted(scores) and len(scores) == 3
    with pytest.raises(ValueError):
        run_competition(splits, LABEL, FeatureAssembler(), [])
    with pytest.raises(KeyError):
        run_competition(splits, LABEL, FeatureAssembler(), candidates, primary_metric="auc")
    with pytest.raises(ValueError, match="tuned"):
        Candidate.from_mapping({"name": "tuned", "tuning": {"n_splits": 2}})


def test_versions_and_runs(spark, train, tmp_path):
    base = str(tmp_path / "models")
    with pytest.raises(ValueError):
        load_latest(spark, base, "m")
    model = Pipeline(stages=[FillMissing()]).fit(train)
    versions = [register_model(spark, base, model, "m", run_id=f"r{i}", tags={"a": "b"}) for i in range(2)]
    assert versions == ["1", "2"]
    loaded = load_latest(spark, base, "m")
    assert (loaded.version, loaded.run_id) == ("2", "r1")
    table = spark.createDataFrame([("m", "9", "u9", "r9"), ("m", "10", "u10", "r10")],
                                  "name string, version string, uri string, run_id string")
    assert latest_versions(table).first().uri == "u10"

    path = str(tmp_path / "runs")
    parent = RunLog(spark, path, "parent")
    child = parent.nested("child")
    child.log_params({"lags": 20})
    child.log_metrics({"rmse": 1.5, "r2": None})
    child.end()
    parent.set_tags({"t": "x"})
    parent.log_dict({"a": [1]}, "file.json")
    parent.end()
    runs = read_runs(spark, path)
    assert runs.count() == 5
    assert run_values(runs, child.run_id) == {"lags": "20"}
    row = metrics_report(runs, ["rmse", "r2"]).first()
    assert (row.name, row.rmse, row.r2) == ("child", 1.5, None)
    assert runs.filter("parent_run_id is not null").select("parent_run_id").distinct().first()[0] == parent.run_id


def test_parallel_writers_and_a_broken_save(spark, train, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    base, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    model = Pipeline(stages=[FillMissing()]).fit(train)

    class Broken:
        def write(self):
            raise OSError("no space")

    def write(i):
        log = RunLog(spark, runs, f"run{i}")
        log.log_metrics({"rmse": float(i)})
        log.end()
        return register_model(spark, base, model, "m", run_id=str(i))

    with pytest.raises(OSError):
        register_model(spark, base, Broken(), "m")
    with ThreadPoolExecutor(8) as pool:
        versions = sorted(pool.map(write, range(8)), key=int)
    assert versions == [str(v) for v in range(2, 10)]  # the broken one keeps its number
    with pytest.raises(OSError):
        register_model(spark, base, Broken(), "m")
    assert load_latest(spark, base, "m").version == "9"
    assert read_runs(spark, runs).count() == 8


CONFIG = {
    "target_column": "Close",
    "horizon": 5,
    "split": {"train_size": 0.7, "val_size": 0.15, "test_size": 0.15, "gap": 1},
    "assembler": {**ASSEMBLER, "attach_base": True, "scaler": "standard"},
    "feature_selection": {"estimator": "lasso", "params": {"alpha": 1e-4}, "n_splits": 2,
                          "min_features_to_select": 3, "gap": 1, "correlation_threshold": 0.9},
    "candidates": [{"name": "linear_regression"},
                   {"name": "knn", "params": {"n_neighbors": 3}, "extra_steps": [{"type": "standard_scaler"}]}],
    "primary_metric": "mape",
    "model_registry": {"model_name": "prices", "tags": {"stage": "test"}},
}


def test_training_then_forecast(spark, bars, tmp_path):
    base, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    config = {**CONFIG, "feature_selection": {**CONFIG["feature_selection"], "artifact_dir": str(tmp_path)}}
    # A repeated bar: the later one counts.
    twice = bars.unionByName(bars.filter("ordinal = 3").withColumn("ordinal", F.lit(-1).cast("long")))
    result = run_training(twice, config, models_path=base, runs_path=runs)
    assert result.version == "1" and result.best_name in ("linear_regression", "knn")
    assert load_selected_features(spark, result.artifact_path) == result.selected_features
    log = read_runs(spark, runs)
    assert {r.name for r in log.select("name").distinct().collect()} == {"training", "linear_regression", "knn"}
    entry = spark.read.parquet(f"{base}/models").first()
    assert "Close_target_h5" not in entry.input_schema and entry.tags == {"stage": "test"}

    loaded = load_latest(spark, base, "prices")
    assert required_history(loaded.model) == 4
    assert required_history(loaded.model, run_values(log, result.run_id)) == 4
    end = "2024-03-02"  # a Saturday, after 61 days of bars
    got = {r.series_id: r for r in forecast_from_registry(
        bars, config, models_path=base, runs_path=runs, prediction_date=end).collect()}
    assert set(got) == {"big", "mid", "small"}
    row = got["mid"]
    assert (row.lookback_start, row.lookback_end) == ("2024-02-27T00:00:00", "2024-03-02T00:00:00")
    assert str(row.prediction_date) == "2024-03-08" and row.date_was_read
    recent = bars.filter("ts >= '2024-02-27' and ts < '2024-03-02'")
    by_hand = loaded.model.transform(recent).filter("series_id = 'mid'").orderBy(F.desc("ts")).first()
    assert row.prediction_value == pytest.approx(by_hand.prediction)
    assert (row.model_version, row.model_name) == ("1", "prices")
    only = forecast_from_registry(bars, config, models_path=base, prediction_date=end, ticker=" mid ")
    assert only.count() == 1
    # Without a date that can be read it is now: the bars are old, but each series has enough of them.
    late = forecast_from_registry(bars, config, models_path=base, prediction_date="no date").collect()
    assert len(late) == 3 and all(r.complete and not r.date_was_read for r in late)
    with pytest.raises(ValueError):
        forecast_from_registry(bars, config, models_path=base, ticker="absent")


def test_history_rules():
    assert required_history(None) == 60
    assert required_history(None, {"max_LAG": "1..20", "other": "99"}) == 20
    assert FeatureAssembler(lags=[2], returns=[5], rolling_windows=[9]).required_history() == 9


def lagged_model(spark, bars, lags, **more):
    assembler = FeatureAssembler(target_column="Close", lags=lags, returns=[], rolling_windows=[],
                                 high_column=None, low_column=None, volume_column=None, **more)
    splits = temporal_split(bars, "Close", horizon=5, train_size=0.7, val_size=0.15, gap=1)
    return run_competition(splits, "Close_target_h5", assembler,
                           [Candidate("linear_regression", "linear_regression")], primary_metric="mae").best.model


def test_forecast_over_gaps_and_short_series(spark, bars):
    """A holiday before the date costs no lag; a short series has no forecast, but a row."""
    model = lagged_model(spark, bars, [1, 6])
    holiday = bars.filter("not (ts between '2024-02-20' and '2024-02-28')")
    short = bars.filter("series_id = 'mid' and ts between '2024-02-26' and '2024-02-29'").withColumn(
        "series_id", F.lit("new"))
    broken = bars.filter("series_id = 'mid' and ts < '2024-03-01'").withColumns(
        {"series_id": F.lit("holes"), "Close": F.when(F.col("ts") < "2024-02-27", F.col("Close"))})
    data = holiday.unionByName(short).unionByName(broken)
    got = {r.series_id: r for r in forecast(data, model, horizon=5, prediction_date="2024-03-02").collect()}
    assert set(got) == {"big", "mid", "small", "new", "holes"}
    assert not got["new"].complete and got["new"].prediction_value is None
    for name, source in (("big", holiday), ("holes", broken.dropna(subset=["Close"]))):
        newest = source.filter(F.col("series_id") == name).filter("ts < '2024-03-02'").orderBy(F.desc("ts")).limit(7)
        by_hand = model.transform(newest).orderBy(F.desc("ts")).first().prediction
        assert got[name].complete and got[name].prediction_value == pytest.approx(by_hand)


def test_forecast_of_a_series_does_not_depend_on_others(spark, bars):
    """Recent bars with holes, a stale series, and what both get alone and in company."""
    model = lagged_model(spark, bars, [20])
    end = "2024-09-01"
    holes = bars.filter("series_id = 'big' and ts < '2024-08-01'").withColumn("series_id", F.lit("holes"))
    recent = holes.filter("ts >= '2024-06-20'").withColumns(
        {"ts": F.expr("ts + interval 50 days"), "ordinal": F.col("ordinal") + 1000,
         "Close": F.when(F.col("ordinal") % 2 == 0, F.col("Close"))}).filter(f"ts < '{end}'")
    holes = holes.filter("ts < '2024-06-20'").unionByName(recent)
    assert 0 < recent.dropna().count() < 21 < recent.count()
    stale = bars.filter("series_id = 'mid'")
    fresh = bars.filter("series_id = 'big'").withColumn("ts", F.expr("ts - interval 16 days"))
    together = holes.unionByName(stale).unionByName(fresh)
    got = {r.series_id: r for r in forecast(together, model, horizon=5, prediction_date=end).collect()}
    for name, source in (("holes", holes), ("mid", stale), ("big", fresh)):
        newest = source.dropna(subset=["Close"]).filter(f"ts < '{end}'").orderBy(F.desc("ts")).limit(21)
        by_hand = model.transform(newest).orderBy(F.desc("ts")).first().prediction
        assert got[name].complete and got[name].prediction_value == pytest.approx(by_hand)
        (alone,) = forecast(source, model, horizon=5, prediction_date=end).collect()
        assert alone == got[name]


def test_forecast_with_macro(spark, bars, tmp_path):
    """The model's macro column is attached for the days looked at; without it there is an error."""
    days = bars.filter("series_id = 'big'").select("ts").distinct()
    macro = days.filter("dayofweek(ts) = 4").select(
        F.lit("RATE").alias("macro_id"), "ts", (F.dayofyear("ts") * 1.5).alias("value"))
    config = {**CONFIG, "assembler": {**CONFIG["assembler"], "base_columns": ["rate"]},
              "feature_selection": {"enabled": False}, "candidates": [{"name": "linear_regression"}],
              "macro": {"series": {"RATE": "rate"}}}
    dataset = fetch_market_data(bars, ticker=None, start="2024-01-01", end="2025-01-01", macro=macro,
                                macro_series={"RATE": "rate"})
    base = str(tmp_path / "models")
    run_training(dataset, config, models_path=base)
    end = "2024-03-02"
    got = forecast_from_registry(bars, config, models_path=base, prediction_date=end, macro=macro)
    model = load_latest(spark, base, "prices").model
    recent = dataset.filter("series_id = 'mid' and ts < '2024-03-02' and ts >= '2024-02-20'")
    by_hand = model.transform(recent).orderBy(F.desc("ts")).first().prediction
    row = got.filter("series_id = 'mid'").first()
    assert row.complete and row.prediction_value == pytest.approx(by_hand)
    with pytest.raises(ValueError, match="rate"):
        forecast_from_registry(bars, config, models_path=base, prediction_date=end)


def test_elimination_scores_far_from_zero(spark):
    draw = random.Random(3)
    rows = [("s", START + timedelta(days=i), i, *(draw.gauss(0, 1) for _ in range(4))) for i in range(200)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, ordinal long, a double, b double, c double, e double")
    near = df.withColumn(LABEL, F.expr("2 * a - b + 0.5 * e")).drop("e")
    config = SelectionConfig("linear_regression", n_splits=2)
    scores = [select_features(d, LABEL, config).validation_scores
              for d in (near, near.withColumn(LABEL, F.col(LABEL) + 1e9))]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6) and min(scores[0]) > 0


def test_search_without_refit_keeps_tuned_steps(spark, bars):
    splits = temporal_split(bars, "Close", horizon=5, train_size=0.7, val_size=0.15, gap=1)
    tuning = TuningConfig(param_grid={"feature_assembler__lags": [[3]], "estimator__alpha": [0.5]},
                          n_splits=2, refit=False)
    outcome = run_competition(splits, "Close_target_h5", FeatureAssembler(target_column="Close", **ASSEMBLER),
                              [Candidate("ridge", "ridge", tuning=tuning)])
    assert "Close_lag_3" in outcome.best.model.stages[0].feature_columns()
    assert "Close_lag_1" not in outcome.best.model.stages[0].feature_columns()


def test_training_from_selected_file_saves_search(spark, bars, tmp_path):
    path = tmp_path / "selected.json"
    path.write_text('{"selected_features": ["Close_lag_1", "Volume"]}')
    config = {**CONFIG, "feature_selection": {"selected_features_path": str(path)},
              "candidates": [{"name": "ridge", "tuning": {
                  "param_grid": {"estimator__alpha": [0.1, 1.0]}, "n_splits": 2, "artifact_dir": str(tmp_path / "hyper")}}]}
    result = run_training(bars, config, runs_path=str(tmp_path / "runs"))
    assert result.selected_features == ["Close_lag_1", "Volume"]
    saved = spark.read.json(str(tmp_path / "hyper/ridge/tuning_results.json"))
    assert saved.count() == 4 and saved.filter("is_best").count() == 2


def test_shipped_competition_is_whole(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemark.queries import models

    seen = []

    def record(splits, label, assembler, candidates, selection, metric):
        seen.extend(candidates)
        return SimpleNamespace(leaderboard=spark.createDataFrame([("a", 1)], "candidate string, position int"))

    monkeypatch.setattr(models, "run_competition", record)
    monkeypatch.setattr(models, "_shipped_splits", lambda *_: None)
    models.competition_shipped(spark, "")
    boosting = next(c for c in seen if c.name == "gradient_boosting")
    assert boosting.params == {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6, "random_state": 42}
    assert boosting.tuning.n_splits == 3 and boosting.tuning.gap == 1
    sets = {tuple(p.values()) for p in parameter_sets(boosting.tuning)}
    assert sets == set(itertools.product((0.05, 0.1), (2, 3), (100, 200, 300)))
    assert [(c.name, c.extra_steps) for c in seen if c.tuning is None] == [
        ("linear_regression", []), ("knn", ["standard_scaler"]),
    ]
