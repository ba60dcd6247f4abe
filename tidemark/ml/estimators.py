"""Regressors by name, with the usual parameter names mapped to Spark's."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.ml.knn import NearestNeighbours
from tidemark.ml.stages import VECTOR
from tidemark.ml.trees import BinnedTrees

# Deepest tree that is grown; the usual default is unlimited.
_DEEPEST = 30

_TREE_PARAMS = {
    "max_depth": "depth",
    "min_samples_leaf": "least_rows",
    "random_state": "seed",
    "max_bins": "max_bins",
}
_LINEAR_PARAMS = {"max_iter": "maxIter", "tol": "tol", "fit_intercept": "fitIntercept"}


class RidgeRegression(
    Estimator,
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Least squares with penalty alpha * |w|^2 on the sum of squared errors.

    Spark divides the squared error by the rows and scales labels by their deviation,
    so its penalty depends on both; they are read at fit. The fitted model is
    Spark's own linear model.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    fitIntercept = Param(Params._dummy(), "fitIntercept", "intercept", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, featuresCol=VECTOR, labelCol="label", alpha=1.0, fitIntercept=True):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(alpha=1.0, fitIntercept=True, featuresCol=VECTOR, labelCol="label")

    def _fit(self, dataset: DataFrame):
        label = self.getLabelCol()
        row = dataset.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
        penalty = self.getOrDefault(self.alpha) * (row["s"] or 0.0) / max(row["n"], 1)
        return LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol=label,
            predictionCol=self.getPredictionCol(),
            regParam=penalty,
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
            fitIntercept=self.getOrDefault(self.fitIntercept),
        ).fit(dataset)


def _ols(label: str, params: dict) -> Estimator:
    return _build(LinearRegression, label, params, _LINEAR_PARAMS, regParam=0.0, solver="normal")


def _lasso(label: str, params: dict) -> Estimator:
    return _build(
        LinearRegression,
        label,
        {"alpha": 1.0, "max_iter": 1000, **params},
        {**_LINEAR_PARAMS, "alpha": "regParam"},
        elasticNetParam=1.0,
        standardization=False,
        solver="normal",
    )


def _ridge(label: str, params: dict) -> Estimator:
    return _build(
        RidgeRegression, label, params, {"alpha": "alpha", "fit_intercept": "fitIntercept"}
    )


def _forest(label: str, params: dict) -> Estimator:
    renamed = {
        **_TREE_PARAMS,
        "n_estimators": "trees",
        "bootstrap": "bootstrap",
        "max_features": "features",
    }
    return _trees("forest", label, {"n_estimators": 100, "max_depth": None, **params}, renamed)


def _boosting(label: str, params: dict) -> Estimator:
    renamed = {
        **_TREE_PARAMS,
        "n_estimators": "trees",
        "learning_rate": "learning_rate",
        "subsample": "sample",
        "start": "start",
    }
    defaults = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}
    return _trees("boosting", label, {**defaults, **params}, renamed)


def _tree(label: str, params: dict) -> Estimator:
    return _trees("tree", label, {"max_depth": None, **params}, _TREE_PARAMS)


def _neighbours(label: str, params: dict) -> Estimator:
    return _build(NearestNeighbours, label, params, {"n_neighbors": "k"})


ESTIMATORS: dict[str, Callable[[str, dict], Estimator]] = {
    "linear_regression": _ols,
    "lasso": _lasso,
    "ridge": _ridge,
    "random_forest": _forest,
    "gradient_boosting": _boosting,
    "decision_tree": _tree,
    "knn": _neighbours,
}


def create_estimator(
    name: str, params: Mapping[str, object] | None = None, label: str = "label"
) -> Estimator:
    if name not in ESTIMATORS:
        raise KeyError(f"Unknown estimator {name!r}. Options: {list(ESTIMATORS)}")
    return ESTIMATORS[name](label, dict(params or {}))


def _trees(kind: str, label: str, params: dict, renamed: dict[str, str]) -> Estimator:
    given = _renamed(params, renamed)
    bins = given.pop("max_bins", 32)
    if params["max_depth"] is None:
        given["depth"] = _DEEPEST
    if "features" in given:
        given["features"] = str(given["features"])
    return BinnedTrees(
        featuresCol=VECTOR, labelCol=label, settings={"kind": kind, **given}, maxBins=bins
    )


def _build(cls, label: str, params: dict, renamed: dict[str, str], **fixed) -> Estimator:
    given = _renamed(params, renamed)
    return cls(featuresCol=VECTOR, labelCol=label, **given, **fixed)


def _renamed(params: dict, renamed: dict[str, str]) -> dict:
    unknown = set(params) - set(renamed)
    if unknown:
        raise ValueError(f"Unknown parameters {sorted(unknown)}. Options: {list(renamed)}")
    return {renamed[key]: value for key, value in params.items() if value is not None}
