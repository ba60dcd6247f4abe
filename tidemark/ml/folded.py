"""Expanding folds without copies: every row once, with what any fold needs of it.

A row carries the first fold that trains on it, the fold that tests it, its features inside a train
slice and its features inside the test slice. Train slices all begin at the start of a series and
features look back only, so one train version serves all folds; test slices do not overlap. Null and
NaN are missing values. Scalers, empty columns and fills depend on a fold's train rows; they follow
from sums per fold, gathered once, and never touch the rows: linear models are solved from matrices of
sums of products, trees get the value that stands for a missing entry.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.ml.linear import Prepared
from tidemark.ml.stages import (
    SLICES,
    ColumnScaler,
    FeatureAssembler,
    FeatureSubset,
    FeatureVector,
    FillMissing,
    bundle_columns,
)
from tidemark.ml.trees import BinnedTable, Ensemble, Fit, Scorer
from tidemark.operators.clean import double_or_null
from tidemark.operators.features import add_features
from tidemark.operators.metrics import SCORER_LEAST, SCORERS
from tidemark.operators.ordered import KEYS, ORDER, with_position
from tidemark.operators.scaling import scaler_kind
from tidemark.operators.split import fold_ranges
from tidemark.session import freeze

ERRORS = ("n", "y", "yy", "squared", "absolute", "relative")


def with_folds(matrix: DataFrame, splits: int, gap: int) -> DataFrame:
    """Adds the first fold that trains on a row, and the fold that tests it.

    Train ranges grow from fold to fold, so a row trains in all folds from its first on;
    ``splits`` means in none. Tests do not overlap; -1 means in none.
    """
    placed = with_position(matrix, keys=KEYS, order=ORDER)
    position = F.col("position")
    first, test = F.lit(splits), F.lit(-1)
    for fold, ranges in reversed(list(enumerate(fold_ranges(F.col("rows"), splits, gap)))):
        first = F.when(position < ranges["train"][1], F.lit(fold)).otherwise(first)
        start, end = ranges["test"]
        test = F.when((position >= start) & (position < end), F.lit(fold)).otherwise(test)
    return placed.select("*", first.alias("_train_from"), test.alias("_test_fold")).drop(
        "position", "rows"
    )


def score_of(scoring: str | None, sums) -> float:
    """The score, more is better, from the sums of ERRORS."""
    name = scoring or "r2"
    if name != "r2" and name not in SCORERS:
        raise ValueError(f"Unknown scoring {scoring!r}. Options: {list(SCORERS)}")
    if not sums.n:
        return math.nan
    if name == "r2":
        spread = sums.yy - sums.y**2 / sums.n
        return 1 - sums.squared / spread if spread > 0 else math.nan
    if name == "neg_mean_absolute_percentage_error":
        return -sums.relative / sums.n
    if name == "neg_mean_absolute_error":
        return -sums.absolute / sums.n
    mse = sums.squared / sums.n
    return -mse if name == "neg_mean_squared_error" else -math.sqrt(mse)


def error_sums(y: np.ndarray, predicted: np.ndarray, centre: float) -> np.ndarray:
    """Sums of ERRORS for each column of predictions; labels are centred."""
    error = y[:, None] - predicted
    relative = np.abs(error) / np.maximum(np.abs(y), SCORER_LEAST)[:, None]
    away = np.broadcast_to((y - centre)[:, None], error.shape)
    pieces = (np.ones_like(error), away, away**2, error**2, np.abs(error), relative)
    return np.stack([p.sum(axis=0) for p in pieces], axis=1)


def supports(steps: Sequence) -> bool:
    """Whether the steps follow from sums: robust scaling and unknown steps do not."""
    if len(steps) < 3 or not isinstance(steps[0], FeatureAssembler) or not isinstance(steps[1], FillMissing):
        return False
    kind = steps[0].setting("scaler")
    if kind is not None and scaler_kind(kind) == "robust":
        return False
    middle = steps[2:-1]
    if middle and isinstance(middle[0], FeatureSubset):
        middle = middle[1:]
    return isinstance(steps[-1], FeatureVector) and all(
        isinstance(s, ColumnScaler) and scaler_kind(s.setting("kind")) != "robust" for s in middle
    )


@dataclass
class FoldView:
    """A fold's columns: which are used, what stands for a missing value, how they are scaled."""

    used: list[int]
    fills: np.ndarray
    scale: np.ndarray
    #: Sums of products of [1, used columns (filled, scaled), label], all centred.
    sums: np.ndarray
    rows: float


class FoldedRows:
    """The rows of a search for one setting of the assembler."""

    def __init__(self, train: DataFrame, steps: Sequence, label: str, splits: int, gap: int):
        self.steps, self.label, self.splits = steps, label, splits
        settings = steps[0].getOrDefault(steps[0].settings)
        rows = with_folds(train, splits, gap)
        base, built, bundle = bundle_columns(train, settings)
        self.columns, self.base = [*base, *built], set(base)
        slices = [c for c in SLICES if c in train.columns]
        listed = ", ".join(double_or_null(c).rsplit(" as ", 1)[0] for c in self.columns)
        price = settings["price_for_nominal"]
        target = settings["target_column"]
        for name, keys in (("_x", (*KEYS, *slices)), ("_t", (*KEYS, *slices, "_test_fold"))):
            built_rows = add_features(rows, target, **bundle, price_for_nominal=price, keys=keys)
            kept = [f"`{c}`" for c in rows.columns]
            rows = built_rows.selectExpr(*kept, f"array({listed}) as {name}")
        wanted = rows.selectExpr(
            "_x as x", "_t as t", f"cast(`{label}` as double) as y", "_train_from", "_test_fold"
        ).filter("y is not null")
        means = [F.avg(F.get("x", F.lit(i))).alias(f"c{i}") for i in range(len(self.columns))]
        # The means are taken while the rows are written; they only keep sums accurate.
        seen = Observation()
        self.rows = freeze(wanted.observe(seen, F.avg("y").alias("y"), *means))
        self.centres = np.array([seen.get[f"c{i}"] or 0.0 for i in range(len(self.columns))])
        self.centre = float(seen.get["y"] or 0.0)
        self._views: dict[int | None, FoldView] = {}
        self._tables: dict[int, BinnedTable] = {}
        self._parts = None

    def _sums(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each first fold the sums of products of [1, values, missing, label], least, most."""
        width, centres, centre = len(self.columns), self.centres, self.centre
        many = 2 * width + 2

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list[np.ndarray]] = {}
            for batch in batches:
                values = _matrix(batch.column(0), width)
                y, first = batch.column(1).to_numpy() - centre, batch.column(2).to_numpy()
                for fold in np.unique(first).tolist():
                    here = first == fold
                    x = values[here]
                    gone = np.isnan(x)
                    z = np.column_stack(
                        [np.ones(len(x)), np.where(gone, 0.0, x - centres), gone, y[here]]
                    )
                    low = np.where(gone, np.inf, x).min(axis=0)
                    high = np.where(gone, -np.inf, x).max(axis=0)
                    if fold in found:
                        total, least, most = found[fold]
                        found[fold] = [total + z.T @ z, np.minimum(least, low), np.maximum(most, high)]
                    else:
                        found[fold] = [z.T @ z, low, high]
            for fold, (total, least, most) in found.items():
                i, j = np.triu_indices(many)
                ends = [np.full(len(i), np.nan), np.full(len(i), np.nan)]
                diagonal = np.flatnonzero((i == j) & (i >= 1) & (i <= width))
                ends[0][diagonal], ends[1][diagonal] = least, most
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), fold)), pa.array(i), pa.array(j), pa.array(total[i, j]),
                     *[pa.array(e, from_pandas=True) for e in ends]],
                    ["fold", "i", "j", "total", "least", "most"],
                )

        schema = "fold long, i long, j long, total double, least double, most double"
        summed = (
            self.rows.select("x", "y", "_train_from")
            .mapInArrow(run, schema)
            .groupBy("fold", "i", "j")
            .agg(F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
            .toPandas()
        )
        parts = {}
        for fold, cells in summed.groupby("fold"):
            total = np.zeros((many, many))
            total[cells["i"], cells["j"]] = cells["total"]
            total = np.triu(total) + np.triu(total, 1).T
            ends = cells[(cells["i"] == cells["j"]) & cells["i"].between(1, width)].sort_values("i")
            parts[int(fold)] = (total, ends["least"].to_numpy(float), ends["most"].to_numpy(float))
        return parts

    def view(self, fold: int | None) -> FoldView:
        """Columns, fills, scales and sums of the train rows of a fold, or of all rows."""
        if fold not in self._views:
            if self._parts is None:
                self._parts = self._sums()
            inside = [p for k, p in self._parts.items() if fold is None or k <= fold]
            if not inside:
                raise ValueError("A fold has no training rows.")
            total = sum(p[0] for p in inside)
            least = np.min([p[1] for p in inside], axis=0)
            most = np.max([p[2] for p in inside], axis=0)
            self._views[fold] = self._view(total, least, most)
        return self._views[fold]

    def _view(self, total: np.ndarray, least: np.ndarray, most: np.ndarray) -> FoldView:
        width = len(self.columns)
        n = total[0, 0]
        sums, squares = total[0, 1 : width + 1], np.diag(total)[1 : width + 1]
        gone = total[0, width + 1 : 2 * width + 1]
        here = n - gone
        mean = sums / np.maximum(here, 1)
        spread = np.where(least < most, np.maximum(squares - sums * mean, 0.0), 0.0)
        centre, scale = np.zeros(width), np.ones(width)
        kind = self.steps[0].setting("scaler")
        kind = None if kind is None else scaler_kind(kind)
        some = here > 0
        if kind == "standard":
            centre = np.where(some, self.centres + mean, 0.0)
            scale = np.where(some, np.sqrt(spread / n), 0.0)
        elif kind == "minmax":
            centre, scale = np.where(some, least, 0.0), np.where(some, most - least, 0.0)
        scale = np.where(scale == 0, 1.0, scale)
        fills = centre + self.steps[1].setting("value") * scale

        used = [i for i, c in enumerate(self.columns) if some[i] or c in self.base]
        middle = list(self.steps[2:-1])
        if middle and isinstance(middle[0], FeatureSubset):
            subset = middle.pop(0)
            missing = [c for c in subset.setting("features") if c not in {self.columns[i] for i in used}]
            if missing and subset.setting("fail_on_missing"):
                raise KeyError(f"Missing columns: {missing}")
            # Absent features are 0 everywhere and change no model.
            place = {self.columns[i]: i for i in used}
            used = [place[c] for c in subset.setting("features") if c in place]

        lift = np.zeros((width + 2, 2 * width + 2))
        lift[0, 0] = lift[-1, -1] = 1.0
        at = np.arange(width)
        lift[at + 1, at + 1] = 1.0
        lift[at + 1, at + 1 + width] = fills - self.centres
        filled = lift @ total @ lift.T
        low = np.where(gone > 0, np.fmin(least, fills), least)
        high = np.where(gone > 0, np.fmax(most, fills), most)
        for step in middle:
            if scaler_kind(step.setting("kind")) == "standard":
                about = filled[0, 1:-1] / n
                own = np.sqrt(np.maximum(np.diag(filled)[1:-1] / n - about**2, 0.0))
            else:
                own = high - low
            scale = np.where((low < high) & (own > 0), own, scale)
        take = [0, *[i + 1 for i in used], width + 1]
        shrink = np.concatenate([[1.0], 1 / scale[used], [1.0]])
        return FoldView(used, fills, scale, filled[np.ix_(take, take)] * np.outer(shrink, shrink), n)

    def linear_models(self, name: str, params: Sequence[dict], fold: int | None) -> list[LinearModel]:
        """A model for each set of parameters, all from the same sums."""
        view = self.view(fold)
        start = time.time()
        # Predictions are made from the values themselves, not from scaled ones.
        middle = self.centres[view.used]
        models = []
        for weights, intercept in Prepared(view.sums).solve_all(name, params):
            raw = weights / view.scale[view.used]
            models.append(LinearModel(view, raw, intercept + self.centre - float(raw @ middle)))
        for model in models:
            model.seconds = (time.time() - start) / len(models)
        return models

    def trees(self, bins: int) -> BinnedTable:
        if bins not in self._tables:
            self._tables[bins] = BinnedTable(self.rows, F.col("x"), "y", F.col("_train_from"), bins)
        return self._tables[bins]

    def tree_fit(self, settings, fold: int | None) -> Fit:
        view = self.view(fold)
        return Fit(settings, fold, tuple(view.fills.tolist()), tuple(view.used))

    def score(self, models: Sequence[tuple[int, object]], scoring: str | None) -> list[float]:
        """The scores of models on the test rows of their folds, all in one pass."""
        width, centre = len(self.columns), self.centre
        models = list(models)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros((len(models), len(ERRORS)))
            for batch in batches:
                values = _matrix(batch.column(0), width)
                y, folds = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                for fold in np.unique(folds).tolist():
                    mine = [k for k, (own, _) in enumerate(models) if own == fold]
                    if not mine:
                        continue
                    x, truth = values[folds == fold], y[folds == fold]
                    predicted = np.column_stack([models[k][1].predict(x) for k in mine])
                    found[mine] += error_sums(truth, predicted, centre)
            cells = [pa.array(found[:, k]) for k in range(len(ERRORS))]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(models))), *cells], ["model", *ERRORS])

        schema = "model long, " + ", ".join(f"{e} double" for e in ERRORS)
        summed = (
            self.rows.filter("_test_fold >= 0")
            .select("t", "y", "_test_fold")
            .mapInArrow(run, schema)
            .groupBy("model")
            .agg(*[F.sum(e).alias(e) for e in ERRORS])
            .collect()
        )
        scores = [math.nan] * len(models)
        for row in summed:
            scores[row.model] = score_of(scoring, row)
        return scores


class LinearModel:
    """Weights for the values as they are; missing ones are filled."""

    def __init__(self, view: FoldView, weights: np.ndarray, intercept: float):
        self.used, self.fills = view.used, view.fills[view.used]
        self.weights, self.intercept, self.seconds = weights, intercept, 0.0

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = x[:, self.used]
        return np.where(np.isnan(x), self.fills, x) @ self.weights + self.intercept


class TreeModel:
    def __init__(self, view: FoldView, ensemble: Ensemble, table: BinnedTable):
        self.fills, self.seconds = view.fills, ensemble.seconds
        self.scorer = Scorer(ensemble, [table.threshold(t) for t in ensemble.trees])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.scorer(np.where(np.isnan(x), self.fills, x))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(-1, width)
