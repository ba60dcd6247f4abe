"""Trees from shared histograms: against Spark's trees, plain growth, and one way against the other."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tidemark.ml import trees
from tidemark.ml.estimators import create_estimator

COLUMNS = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    """Few values in a feature, so that all have the same bins; labels far from zero."""
    draw = np.random.default_rng(3)
    x = draw.integers(0, 25, (700, 5)) / 4
    y = x[:, 0] ** 2 + 3 * (x[:, 1] > 2) * x[:, 2] + draw.normal(size=700) + 1e4
    df = spark.createDataFrame(
        [(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{c} double" for c in COLUMNS) + ", label double"
    )
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df).repartition(3).cache()


def predictions(model, df):
    rows = model.transform(df).orderBy(*COLUMNS, "label").select("prediction").collect()
    return np.array([r[0] for r in rows])


@pytest.fixture(params=["in tasks", "over rows"])
def way(request, spark, monkeypatch):
    if request.param == "over rows":
        spark.conf.set(trees.TREE_CELLS, "0")
        monkeypatch.setattr(trees, "ROUNDS", 3)
    yield request.param
    spark.conf.unset(trees.TREE_CELLS)


@pytest.mark.parametrize("depth, least", [(1, 1), (4, 1), (6, 9)])
def test_one_tree_equals_sparks(data, way, depth, least):
    ours = create_estimator("decision_tree", {"max_depth": depth, "min_samples_leaf": least}).fit(data)
    theirs = DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=least).fit(data)
    assert predictions(ours, data) == pytest.approx(predictions(theirs, data), abs=1e-6)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)


def test_boosting_equals_sparks(data, way):
    ours = create_estimator("gradient_boosting", {"n_estimators": 7, "max_depth": 3, "learning_rate": 0.2}).fit(data)
    theirs = GBTRegressor(maxIter=7, maxDepth=3, stepSize=0.2).fit(data)
    assert predictions(ours, data) == pytest.approx(predictions(theirs, data), abs=1e-5)


def test_forest_without_draws_equals_sparks(data, way):
    params = {"n_estimators": 2, "max_depth": 4, "bootstrap": False}
    ours = create_estimator("random_forest", params).fit(data)
    theirs = RandomForestRegressor(
        numTrees=2, maxDepth=4, bootstrap=False, featureSubsetStrategy="all"
    ).fit(data)
    assert predictions(ours, data) == pytest.approx(predictions(theirs, data), abs=1e-6)


SETS = [
    ("random_forest", {"n_estimators": 6, "max_depth": 5, "random_state": 2, "max_features": "sqrt"}),
    ("random_forest", {"n_estimators": 3, "max_depth": None, "random_state": 2, "min_samples_leaf": 4}),
    ("gradient_boosting", {"n_estimators": 8, "max_depth": 2, "subsample": 0.6, "random_state": 5}),
    ("gradient_boosting", {"n_estimators": 8, "max_depth": 2, "start": "mean"}),
]


@pytest.mark.parametrize("name, params", SETS)
def test_both_ways_agree_and_partitions_do_not_matter(spark, data, monkeypatch, name, params):
    wanted = predictions(create_estimator(name, params).fit(data), data)
    again = predictions(create_estimator(name, params).fit(data.repartition(7)), data)
    assert again == pytest.approx(wanted, abs=1e-6)
    spark.conf.set(trees.TREE_CELLS, "10")
    monkeypatch.setattr(trees, "CELLS", 5 * 32 * 7)  # seven nodes a pass
    monkeypatch.setattr(trees, "ROUNDS", 3)
    try:
        over_rows = predictions(create_estimator(name, params).fit(data), data)
    finally:
        spark.conf.unset(trees.TREE_CELLS)
    assert over_rows == pytest.approx(wanted, abs=1e-6)
    assert len(set(np.round(wanted, 6))) > 20


def test_draws_have_mean_one_and_differ_between_trees():
    names = np.arange(20_000, dtype=np.uint64)
    fit = trees.Fit(trees.TreeSettings("forest", trees=2))
    one, two = (trees.draw_weights(fit, k, names) for k in (0, 1))
    assert abs(one.mean() - 1) < 0.03 and abs(one.var() - 1) < 0.06
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.03
    half = trees.draw_weights(trees.Fit(trees.TreeSettings("boosting", sample=0.5)), 3, names)
    assert abs(half.mean() - 0.5) < 0.02


def test_boosting_from_the_mean_by_hand(data):
    """One tree of depth one: mean plus a shrunk stump on the errors."""
    model = create_estimator(
        "gradient_boosting", {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "start": "mean"}
    ).fit(data)
    stump = predictions(create_estimator("decision_tree", {"max_depth": 1}).fit(data), data)
    mean = data.agg(F.avg("label")).first()[0]
    assert predictions(model, data) == pytest.approx(mean + 0.3 * (stump - mean))


def test_folds_fills_and_columns(spark, data):
    """Rows of a fold, missing values and hidden features, against tables cut down by hand."""
    rows = data.withColumn("fold", (F.col("f3") * 4 % 3).cast("int"))
    holes = F.array(*[F.when(F.col("f1") != 1.0, F.col("f1")), "f0", "f2", "f3"])
    settings = trees.TreeSettings("tree", depth=3)
    for cells in ("4000000", "0"):
        spark.conf.set(trees.TREE_CELLS, cells)
        table = trees.BinnedTable(rows, holes, "label", F.col("fold"))
        fits = [trees.Fit(settings, k, (1.0, 0.0, 0.0, 0.0), (0, 2)) for k in (0, 1, None)]
        found = table.fit(fits)
        for fit, ensemble in zip(fits, found):
            part = rows if fit.fold is None else rows.filter(F.col("fold") <= fit.fold)
            own = trees.BinnedTable(part, F.array("f1", "f2"), "label")
            (plain,) = own.fit([trees.Fit(settings)])
            assert sorted(ensemble.trees[0].value) == pytest.approx(sorted(plain.trees[0].value), abs=1e-6)
            assert set(ensemble.trees[0].feature) <= {0, 2}
    spark.conf.unset(trees.TREE_CELLS)


def test_first_trees_of_a_longer_fit(data):
    table = trees.BinnedTable(data, F.array(*COLUMNS), "label")
    for kind in ("boosting", "forest"):
        short, long = table.fit([trees.Fit(trees.TreeSettings(kind, n, 3, seed=4)) for n in (3, 9)])
        cut = long.first(3) if kind == "boosting" else trees.Ensemble(0, [], long.trees[:3]).averaged()
        assert trees.pack_ensemble(cut).split('"weights"')[1] == trees.pack_ensemble(short).split('"weights"')[1]


def test_constant_labels_and_saved_models(spark, data, tmp_path):
    flat = data.withColumn("label", F.lit(0.1))
    model = create_estimator("random_forest", {"n_estimators": 3}).fit(flat)
    assert predictions(model, flat) == pytest.approx(0.1) and model.featureImportances.toArray().sum() == 0
    fitted = Pipeline(stages=[create_estimator(*SETS[0])]).fit(data)
    fitted.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert (predictions(again, data) == predictions(fitted, data)).all()


def test_errors(data):
    with pytest.raises(ValueError, match="no rows"):
        create_estimator("decision_tree").fit(data.limit(0))
    with pytest.raises(ValueError, match="max_bins"):
        create_estimator("decision_tree", {"max_bins": 300}).fit(data)
