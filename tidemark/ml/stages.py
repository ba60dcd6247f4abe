"""pyspark.ml stages from bars to a feature vector.

Every stage passes the carried columns through: the keys, the slice a row belongs to
(split, fold and role) and labels. All other numeric columns are features. Windows
never reach over the border of a slice.

The configuration and the fitted state of a stage are params with JSON values, so the
stages are saved and loaded like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tidemark.functions import names
from tidemark.operators.clean import (
    HELPERS,
    base_columns,
    double_or_null,
    fill_missing,
    impose_columns,
)
from tidemark.operators.features import add_features, feature_names
from tidemark.operators.ordered import KEYS
from tidemark.operators.scaling import apply_scaler, fit_columns, scaler_kind

SLICES = ("split", "fold", "role")
VECTOR = "features"

_LABEL = re.compile(r"_target_h\d+$")


def carried_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in HELPERS or c in SLICES or _LABEL.search(c)]


def feature_columns(df: DataFrame) -> list[str]:
    carried = set(carried_columns(df))
    return [c for c in names.numeric_columns(df) if c not in carried]


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps its configuration in one param, a mapping."""

    settings = Param(Params._dummy(), "settings", "configuration of the stage")
    defaults: dict = {}

    def __init__(self, **settings):
        super().__init__()
        unknown = set(settings) - set(self.defaults)
        if unknown:
            raise TypeError(f"Unknown settings {sorted(unknown)}. Options: {list(self.defaults)}")
        self._set(settings={**self.defaults, **settings})

    def setting(self, name: str):
        return self.getOrDefault(self.settings)[name]

    def with_settings(self, **changes):
        changed = self.copy()
        changed._set(settings={**self.getOrDefault(self.settings), **changes})
        return changed


class FeatureAssembler(_Stage, Estimator):
    """Builds the feature bundle, attaches base columns, and fits a scaler on the result.

    ``scaler`` is a name or a ``ColumnScaler``.
    """

    defaults = {
        "target_column": "Close",
        "lags": (1, 5, 10),
        "returns": (1,),
        "rolling_windows": (5, 20),
        "high_column": "High",
        "low_column": "Low",
        "volume_column": "Volume",
        "price_for_nominal": None,
        "attach_base": False,
        "base_columns": None,
        "scaler": None,
    }

    def __init__(self, **settings):
        for name in ("lags", "returns", "rolling_windows", "base_columns"):
            if isinstance(settings.get(name), Iterable) and not isinstance(settings[name], str):
                settings[name] = list(settings[name])
        if isinstance(settings.get("scaler"), ColumnScaler):
            settings["scaler"] = settings["scaler"].setting("kind")
        super().__init__(**settings)
        names.expand_lags(self.setting("lags"))
        for name in ("returns", "rolling_windows"):
            for n in self.setting(name):
                names.positive(name, n)
        if self.setting("scaler") is not None:
            scaler_kind(self.setting("scaler"))

    def required_history(self) -> int:
        """Bars needed for one complete row of features."""
        return required_history(self.getOrDefault(self.settings))

    def _fit(self, dataset: DataFrame) -> FeatureAssemblerModel:
        settings = self.getOrDefault(self.settings)
        matrix, base, built = build_matrix(dataset, settings)
        statistics, empty = fit_columns(matrix, [*base, *built], settings["scaler"])
        # Only features vanish when they have no value; base columns stay.
        columns = base + [c for c in built if c not in empty]
        model = FeatureAssemblerModel(**settings)
        model._set(
            columns=columns, statistics={c: statistics[c] for c in columns if c in statistics}
        )
        return model


class FeatureAssemblerModel(_Stage, Model):
    columns = Param(Params._dummy(), "columns", "fitted feature columns, in order")
    statistics = Param(Params._dummy(), "statistics", "centre and scale of each column")
    defaults = FeatureAssembler.defaults

    def required_history(self) -> int:
        return required_history(self.getOrDefault(self.settings))

    def feature_columns(self) -> list[str]:
        return list(self.getOrDefault(self.columns))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        matrix, _, _ = build_matrix(dataset, self.getOrDefault(self.settings))
        fitted = impose_columns(matrix, self.feature_columns(), carried_columns(dataset))
        statistics = self.getOrDefault(self.statistics)
        return apply_scaler(fitted, {c: tuple(s) for c, s in statistics.items()})


def bundle_columns(df: DataFrame, settings: dict) -> tuple[list[str], list[str], dict]:
    """Names of base and feature columns, and the settings of the feature bundle."""
    target = settings["target_column"]
    listed = settings["base_columns"] if settings["attach_base"] else None
    names.require_columns(df, [target])
    names.require_columns(
        df,
        [settings[c] for c in ("high_column", "low_column", "volume_column", "price_for_nominal")],
    )
    names.require_columns(df, listed or [])

    base: list[str] = []
    if settings["attach_base"]:
        candidates = listed or feature_columns(df)
        base = base_columns(candidates, target, listed)
    bundle = {
        key: settings[key]
        for key in ("lags", "returns", "rolling_windows", "high_column", "low_column", "volume_column")
    }
    return base, [c for c in feature_names(target, **bundle) if c not in base], bundle


def build_matrix(df: DataFrame, settings: dict) -> tuple[DataFrame, list[str], list[str]]:
    """Carried, base and feature columns, and the names of the latter two."""
    base, built, bundle = bundle_columns(df, settings)
    target, carried = settings["target_column"], carried_columns(df)
    slices = [c for c in SLICES if c in df.columns]
    wide = add_features(
        df, target, **bundle, price_for_nominal=settings["price_for_nominal"], keys=(*KEYS, *slices)
    )
    numbers = [double_or_null(c) for c in (*base, *built)]
    return wide.selectExpr(*[f"`{c}`" for c in carried], *numbers), base, built


def required_history(settings: dict) -> int:
    lags = names.expand_lags(settings["lags"])
    windows = [n - 1 for n in settings["rolling_windows"]]
    return 1 + max([*lags, *settings["returns"], *windows])


class FillMissing(_Stage, Transformer):
    """NULL and NaN in feature columns to a constant."""

    defaults = {"value": 0.0}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fill_missing(dataset, self.setting("value"), feature_columns(dataset))


class FeatureSubset(_Stage, Transformer):
    """The listed features in their order; absent ones are an error, or 0.0."""

    defaults = {"features": (), "fail_on_missing": True}

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.setting("features") if c not in df.columns]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.setting("fail_on_missing"):
            names.require_columns(dataset, self.setting("features"))
        return impose_columns(dataset, list(self.setting("features")), carried_columns(dataset))


class ColumnScaler(_Stage, Estimator):
    """Scales every feature column: standard, minmax or robust."""

    defaults = {"kind": "standard"}

    def __init__(self, **settings):
        super().__init__(**settings)
        scaler_kind(self.setting("kind"))

    def _fit(self, dataset: DataFrame) -> ColumnScalerModel:
        statistics, _ = fit_columns(dataset, feature_columns(dataset), self.setting("kind"))
        model = ColumnScalerModel()
        model._set(statistics=statistics)
        return model


class ColumnScalerModel(_Stage, Model):
    statistics = Param(Params._dummy(), "statistics", "centre and scale of each column")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        statistics = self.getOrDefault(self.statistics)
        return apply_scaler(dataset, {c: tuple(s) for c, s in statistics.items()})


class FeatureVector(_Stage, Transformer):
    """All feature columns as one vector; only the carried columns stay beside it."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = feature_columns(dataset)
        assembled = VectorAssembler(inputCols=columns, outputCol=VECTOR).transform(dataset)
        return assembled.select(*carried_columns(dataset), VECTOR)


def extra_stage(kind: str) -> ColumnScaler:
    """A configured step between the features and the estimator."""
    if kind not in ("standard_scaler", "minmax_scaler"):
        raise ValueError(f"Unknown step {kind!r}. Options: ['standard_scaler', 'minmax_scaler']")
    return ColumnScaler(kind=kind)
