"""Searches from shared rows against fits one by one, paths of penalties, and draws without a grid."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_models import ASSEMBLER, LABEL
from tidemark.ml import linear, tuning
from tidemark.ml.competition import feature_stages
from tidemark.ml.folded import FoldedRows, supports
from tidemark.ml.stages import FeatureAssembler
from tidemark.ml.tuning import TuningConfig, parameter_sets, search
from tidemark.operators.split import temporal_split


@pytest.fixture(scope="module")
def train(bars):
    """Train rows with a column that has gaps, one that begins late and one without a value."""
    splits = temporal_split(bars, "Close", horizon=5, train_size=0.7, val_size=0.15, gap=1)
    rows = splits.filter("split = 'train'").withColumns(
        {
            "gaps": F.when(F.col("ordinal") % 7 != 3, F.col("Open") * 2),
            "late": F.when(F.col("ordinal") > 30, F.col("High") - F.col("Low")),
            "never": F.lit(None).cast("double"),
            "flat": F.lit(3.0),
        }
    )
    return rows.cache()


def both(train, stages, estimator, params, config, monkeypatch):
    shared = search(stages, estimator, params, train, LABEL, config)
    monkeypatch.setattr(tuning, "_from_shared_rows", lambda *_: False)
    single = search(stages, estimator, params, train, LABEL, config)
    cells = lambda r: {(x.params, x.fold): x.score for x in r.scores.collect()}
    return cells(shared), cells(single), shared, single


COLUMNS = ["Open", "Volume", "gaps", "late"]
BASE = {**ASSEMBLER, "attach_base": True, "base_columns": COLUMNS}


@pytest.mark.parametrize(
    "scaler, extra, estimator, grid, scoring",
    [
        (None, (), "ridge", [0.1, 1e3, 1e6], "r2"),
        ("standard", (), "ridge", [0.1, 10.0, 100.0], "neg_mean_absolute_percentage_error"),
        ("minmax", ("standard_scaler",), "ridge", [0.1, 10.0], "neg_root_mean_squared_error"),
        (None, ("standard_scaler", "minmax_scaler"), "ridge", [0.5, 10.0], "neg_mean_absolute_error"),
        ("standard", (), "lasso", [0.01, 0.3, 2.0], "neg_mean_squared_error"),
    ],
)
def test_linear_search_equals_single_fits(train, monkeypatch, scaler, extra, estimator, grid, scoring):
    stages = feature_stages(FeatureAssembler(**BASE, scaler=scaler), None, extra)
    config = TuningConfig(param_grid={"estimator__alpha": grid}, n_splits=3, gap=1, scoring=scoring, refit=False)
    params = {"tol": 1e-12, "max_iter": 5000} if estimator == "lasso" else {}
    shared, single, *_ = both(train, stages, estimator, params, config, monkeypatch)
    assert len(shared) == 3 * len(grid) and set(shared) == set(single)
    for key, value in single.items():
        assert shared[key] == pytest.approx(value, rel=2e-5), key


def test_constant_and_empty_columns_change_nothing(train):
    """Single fits leave the exact solver on such columns, so these are compared with themselves."""
    cells = []
    for columns in (COLUMNS, [*COLUMNS, "never", "flat"]):
        assembler = FeatureAssembler(**{**BASE, "base_columns": columns}, scaler="standard")
        config = TuningConfig(param_grid={"estimator__alpha": [0.1, 50.0]}, n_splits=3, refit=False)
        result = search(feature_stages(assembler, None), "ridge", {}, train, LABEL, config)
        cells.append({(r.params, r.fold): r.score for r in result.scores.collect()})
    assert cells[0] == pytest.approx(cells[1])


def test_steps_and_subset(train, monkeypatch):
    chosen = ["Close_lag_2", "late", "unknown", "gaps"]
    stages = feature_stages(FeatureAssembler(**BASE, scaler="standard"), chosen)
    grid = {"estimator__alpha": [1.0, 50.0], "feature_assembler__lags": [[2], [2, 9]]}
    config = TuningConfig(param_grid=grid, n_splits=2, refit=False)
    shared, single, one, other = both(train, stages, "ridge", {}, config, monkeypatch)
    assert shared == pytest.approx(single, rel=1e-6) and len(shared) == 8
    assert one.best_params == other.best_params


@pytest.mark.parametrize(
    "estimator, params, grid",
    [
        ("decision_tree", {"random_state": 1}, {"estimator__max_depth": [1, 3]}),
        ("gradient_boosting", {"max_depth": 2}, {"estimator__n_estimators": [2, 5], "estimator__learning_rate": [0.1, 0.4]}),
        ("random_forest", {"bootstrap": False, "max_depth": 3}, {"estimator__n_estimators": [1, 2]}),
    ],
)
def test_tree_search_equals_single_fits(train, monkeypatch, estimator, params, grid):
    """Every fold sees the same few values, so that the borders of bins, which folds share, are its own."""
    noise = F.pmod(F.xxhash64("ordinal", "series_id"), F.lit(100)) / 50
    few = train.withColumns(
        {"Close": 10.0 + F.col("ordinal") * 5 % 7, "Open": 1.0 + F.col("ordinal") * 3 % 4}
    ).withColumn(LABEL, F.col("Close") ** 2 - F.col("Open") * 3 + noise)
    assembler = FeatureAssembler(
        target_column="Close", lags=[1, 3], returns=[], rolling_windows=[], attach_base=True, base_columns=["Open"],
        high_column=None, low_column=None, volume_column=None, scaler="standard",
    )
    config = TuningConfig(param_grid=grid, n_splits=2, gap=1, scoring="neg_mean_absolute_error", refit=False)
    shared, single, *_ = both(few, feature_stages(assembler, None), estimator, params, config, monkeypatch)
    assert set(shared) == set(single) and shared == pytest.approx(single, rel=1e-6)


def test_number_of_trees_is_a_prefix(train):
    stages = feature_stages(FeatureAssembler(**ASSEMBLER), None)
    config = lambda *n: TuningConfig(
        param_grid={"estimator__n_estimators": list(n)}, n_splits=2, scoring="r2", refit=False
    )
    for estimator in ("gradient_boosting", "random_forest"):
        cells = {}
        for found in (config(2, 6), config(2), config(6)):
            result = search(stages, estimator, {"max_depth": 2}, train, LABEL, found)
            for r in result.scores.collect():
                cells.setdefault((r.params, r.fold), []).append(r.score)
        assert len(cells) == 4 and all(a == pytest.approx(b) for a, b in cells.values())


def test_rows_stand_once(train):
    rows = FoldedRows(train, feature_stages(FeatureAssembler(**ASSEMBLER), None), LABEL, 3, 1)
    assert rows.rows.count() == train.filter(F.col(LABEL).isNotNull()).count()
    assert rows.view(None).rows == rows.rows.count()


def test_what_is_shared(train):
    robust = FeatureAssembler(**{**ASSEMBLER, "scaler": "robust"})
    assert not supports(feature_stages(robust, None))
    assert supports(feature_stages(FeatureAssembler(**ASSEMBLER), ["a"], ["standard_scaler"]))
    config = TuningConfig(param_grid={"estimator__n_neighbors": [2, 3]}, n_splits=2, refit=False)
    result = search(feature_stages(FeatureAssembler(**ASSEMBLER), None), "knn", {}, train, LABEL, config)
    assert result.scores.count() == 4


def test_lasso_path_equals_single_solutions():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(120, 9)) @ draw.normal(size=(9, 9))
    y = x @ np.where(draw.random(9) < 0.5, 0, 2.0) + draw.normal(size=120)
    total = np.column_stack([np.ones(120), x, y])
    prepared = linear.Prepared(total.T @ total)
    alphas = [0.01, 5.0, 0.3, 80.0, 1.0]
    path = prepared.solve_all("lasso", [{"alpha": a, "max_iter": 100_000} for a in alphas])
    for alpha, (weights, intercept) in zip(alphas, path):
        assert weights == pytest.approx(linear.lasso(prepared.xx, prepared.xy, alpha), abs=1e-6)
        assert intercept == pytest.approx(y.mean() - x.mean(0) @ weights)
    x[:, 1] = x[:, 0]  # dependent features
    total = np.column_stack([np.ones(120), x, y])
    again = linear.Prepared(total.T @ total)
    for alpha, (weights, _) in zip(alphas, again.solve_all("lasso", [{"alpha": a} for a in alphas])):
        slope = again.xx @ weights - again.xy
        assert np.abs(slope).max() <= alpha * 1.01 + 1e-9


def test_draws_from_a_grid_that_cannot_be_built():
    grid = {f"estimator__p{i}": list(range(100)) for i in range(6)}
    draws = parameter_sets(TuningConfig("random", grid, n_iter=10, random_state=5))
    assert len({json.dumps(d) for d in draws}) == 10 and list(draws[0]) == sorted(grid)
    grid = {f"estimator__p{i}": list(range(100)) for i in range(40)}
    assert len(parameter_sets(TuningConfig("random", grid, n_iter=7))) == 7
    small = {"estimator__a": [1, 2, 3], "estimator__b": ["x", "y"]}
    every = parameter_sets(TuningConfig(param_grid=small))
    drawn = parameter_sets(TuningConfig("random", small, n_iter=6, random_state=3))
    assert sorted(map(json.dumps, drawn)) == sorted(map(json.dumps, every))
    import random

    assert drawn == random.Random(3).sample(every, 6)
