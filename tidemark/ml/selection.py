"""Recursive feature elimination over expanding folds, and the result's JSON file."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml.estimators import create_estimator
from tidemark.ml.folded import ERRORS, error_sums, score_of, with_folds
from tidemark.ml.linear import LINEAR, solve
from tidemark.ml.stages import feature_columns
from tidemark.ml.trees import BinnedTable, Fit, Scorer
from tidemark.operators.moments import products
from tidemark.operators.scaling import column_means
from tidemark.session import freeze

TREES = ("random_forest", "gradient_boosting", "decision_tree")

ARTIFACT_SCHEMA = """
  selected_features array<string>, ranking array<int>, support array<boolean>,
  validation_scores array<double>, estimator_name string, n_splits int, step double,
  min_features_to_select int, scoring string, gap int, dropped_features array<string>"""


@dataclass
class SelectionConfig:
    estimator: str = "lasso"
    params: dict | None = None
    n_splits: int = 5
    min_features_to_select: int = 1
    step: float = 1
    scoring: str | None = None
    gap: int = 0
    min_samples_required: int | None = None
    correlation_threshold: float | None = None


@dataclass
class SelectionResult:
    columns: list[str]
    support: list[bool]
    ranking: list[int]
    validation_scores: list[float]
    estimator_name: str
    dropped_features: list[str]

    @property
    def selected_features(self) -> list[str]:
        return [c for c, kept in zip(self.columns, self.support) if kept]


def keep_all(columns: Sequence[str], config: SelectionConfig, dropped=()) -> SelectionResult:
    """The result when there are too few rows to select on."""
    n = len(columns)
    return SelectionResult(list(columns), [True] * n, [1] * n, [], config.estimator, list(dropped))


def select_features(
    matrix: DataFrame, label: str, config: SelectionConfig, dropped: Sequence[str] = ()
) -> SelectionResult:
    """Recursive elimination, or every feature if there are too few rows."""
    columns = feature_columns(matrix)
    if not columns:
        raise ValueError("There are no features to select from.")
    if config.n_splits < 2:
        raise ValueError("At least 2 folds are needed.")
    rows = matrix.count()
    needed = config.min_samples_required or config.n_splits + 1
    if rows <= config.n_splits or rows < needed:
        return keep_all(columns, config, dropped)
    if config.estimator in LINEAR:
        backend = _LinearElimination(matrix, label, columns, config)
    elif config.estimator in TREES:
        backend = _TreeElimination(matrix, label, columns, config)
    else:
        raise ValueError(
            f"{config.estimator!r} has no feature weights. Options: {[*LINEAR, *TREES]}"
        )

    least = min(config.min_features_to_select, len(columns))
    step = config.step if config.step >= 1 else max(1, config.step * len(columns))
    sizes = elimination_sizes(len(columns), least, int(step))
    paths = backend.eliminate_all(list(range(config.n_splits)), sizes)
    scores = backend.score(paths)  # (fold, size)

    # Ascending sizes, so that the fewest features win a tie.
    means = scores.mean(axis=0)[::-1]
    ascending = sizes[::-1]
    best = ascending[int(np.argmax(np.where(np.isnan(means), -np.inf, means)))]
    final = backend.eliminate(None, elimination_sizes(len(columns), best, int(step)))
    kept = final[-1]
    # A feature eliminated in the last step ranks 2, in the one before 3, and so on.
    ranking = [1 + sum(i not in s for s in final) for i in range(len(columns))]
    return SelectionResult(
        columns,
        [i in kept for i in range(len(columns))],
        ranking,
        [float(v) for v in means],
        config.estimator,
        list(dropped),
    )


def elimination_sizes(total: int, least: int, step: int) -> list[int]:
    """Feature counts from all down to the least; the last step may be a smaller one."""
    sizes = [total]
    while sizes[-1] > least:
        sizes.append(max(least, sizes[-1] - step))
    return sizes


def weakest_removed(kept: list[int], weights: np.ndarray, size: int) -> list[int]:
    """The features with the largest weights, in column order."""
    order = np.argsort(weights, kind="stable")
    gone = {kept[i] for i in order[: len(kept) - size]}
    return [i for i in kept if i not in gone]


class _LinearElimination:
    """One pass gathers the sums of products per fold; each fit is then a small system.

    A second pass scores the models of all folds and sizes.
    """

    def __init__(self, matrix, label, columns, config):
        self.columns, self.label, self.config = columns, label, config
        # Numbered once; the sums and the scores both read it.
        self.rows = freeze(
            with_folds(matrix, config.n_splits, config.gap).select(
                *columns, label, "_train_from", "_test_fold"
            )
        )
        means = column_means(matrix, [*columns, label])
        self.centres = np.array([means[c] for c in (*columns, label)])
        parts = products(self.rows, [*columns, label], "_train_from", self.centres)
        empty = np.zeros((len(columns) + 2,) * 2)
        self.totals, total = [], empty
        for fold in range(config.n_splits + 1):
            total = total + parts.get(fold, empty)
            self.totals.append(total)
        self.models: dict[tuple[int, int], np.ndarray] = {}

    def eliminate(self, fold: int | None, sizes: list[int]) -> list[list[int]]:
        total = self.totals[-1 if fold is None else fold]
        kept, path, weights = list(range(len(self.columns))), [], None
        for size in sizes:
            if len(kept) > size:
                kept = weakest_removed(kept, weights**2, size)
            weights, intercept = solve(total, kept, self.config.estimator, self.config.params or {})
            if fold is not None:
                model = np.zeros(len(self.columns) + 1)
                # The sums are of centred values; the model is for the values themselves.
                model[0] = intercept + self.centres[-1] - weights @ self.centres[kept]
                model[[i + 1 for i in kept]] = weights
                self.models[fold, size] = model
            path.append(kept)
        return path

    def eliminate_all(self, folds: Sequence[int], sizes: list[int]) -> list[list[list[int]]]:
        return [self.eliminate(fold, sizes) for fold in folds]

    def score(self, paths: list[list[list[int]]]) -> np.ndarray:
        sizes = [len(kept) for kept in paths[0]]
        folds = self.config.n_splits
        models = np.stack(
            [np.column_stack([self.models[fold, size] for size in sizes]) for fold in range(folds)]
        )
        columns, label, centre = self.columns, self.label, float(self.centres[-1])

        def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((folds, len(sizes), len(ERRORS)))
            for batch in batches:
                for fold, rows in batch.groupby("_test_fold"):
                    model = models[fold]
                    predicted = rows[columns].to_numpy(float) @ model[1:] + model[0]
                    sums[fold] += error_sums(rows[label].to_numpy(float), predicted, centre)
            fold, size = np.indices(sums.shape[:2])
            cells = {name: sums[:, :, i].ravel() for i, name in enumerate(ERRORS)}
            yield pd.DataFrame({"fold": fold.ravel(), "size": size.ravel(), **cells})

        tested = self.rows.filter(F.col("_test_fold") >= 0).drop("_train_from")
        return _scores(tested.mapInPandas(per_task, _SUMS), folds, len(sizes), self.config.scoring)


class _TreeElimination:
    """All folds drop their weakest features together: one set of fits a size, on one binned table."""

    def __init__(self, matrix, label, columns, config):
        self.columns, self.config = columns, config
        estimator = create_estimator(config.estimator, config.params, label)
        self.settings = estimator.tree_settings()
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
        self.rows = freeze(
            with_folds(matrix, config.n_splits, config.gap).select(
                values.alias("x"), F.col(label).alias("y"), "_train_from", "_test_fold"
            )
        )
        self.table = BinnedTable(
            self.rows, F.col("x"), "y", F.col("_train_from"), estimator.getOrDefault("maxBins")
        )
        self.models: dict[tuple[int, int], Scorer] = {}

    def eliminate(self, fold: int | None, sizes: list[int]) -> list[list[int]]:
        return self.eliminate_all([fold], sizes)[0]

    def eliminate_all(self, folds: Sequence[int | None], sizes: list[int]) -> list[list[list[int]]]:
        kept = [list(range(len(self.columns))) for _ in folds]
        paths: list[list[list[int]]] = [[] for _ in folds]
        weights: list[np.ndarray] = []
        for size in sizes:
            if len(kept[0]) > size:
                kept = [weakest_removed(k, w[k], size) for k, w in zip(kept, weights)]
            for path, own in zip(paths, kept):
                path.append(own)
            if folds == [None] and size == sizes[-1]:
                break
            fits = [Fit(self.settings, fold, None, tuple(own)) for fold, own in zip(folds, kept)]
            grown = self.table.fit(fits)
            weights = [model.importances(len(self.columns)) for model in grown]
            for fold, model in zip(folds, grown):
                if fold is not None:
                    self.models[fold, size] = Scorer(model, [self.table.threshold(t) for t in model.trees])
        return paths

    def score(self, paths: list[list[list[int]]]) -> np.ndarray:
        sizes = [len(kept) for kept in paths[0]]
        folds, width, models = self.config.n_splits, len(self.columns), self.models
        centre = self.table.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((folds, len(sizes), len(ERRORS)))
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                y, tested = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                for fold in np.unique(tested).tolist():
                    here = tested == fold
                    predicted = np.column_stack([models[fold, size](x[here]) for size in sizes])
                    sums[fold] += error_sums(y[here], predicted, centre)
            fold, size = np.indices(sums.shape[:2])
            cells = [pa.array(sums[:, :, i].ravel()) for i in range(len(ERRORS))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(fold.ravel()), pa.array(size.ravel()), *cells], ["fold", "size", *ERRORS]
            )

        rows = self.rows.filter("_test_fold >= 0").select("x", F.col("y").cast("double"), "_test_fold")
        return _scores(rows.mapInArrow(run, _SUMS), folds, len(sizes), self.config.scoring)


_SUMS = "fold long, size long, " + ", ".join(f"{name} double" for name in ERRORS)


def _scores(parts: DataFrame, folds: int, sizes: int, scoring: str | None) -> np.ndarray:
    """Scores by fold and size, from the sums of errors of every task."""
    summed = parts.groupBy("fold", "size").agg(*[F.sum(name).alias(name) for name in ERRORS])
    scores = np.full((folds, sizes), math.nan)
    for row in summed.toPandas().itertuples():
        scores[row.fold, row.size] = score_of(scoring, row)
    return scores


def save_selection(
    spark: SparkSession, result: SelectionResult, config: SelectionConfig, path: str
) -> None:
    row = (
        result.selected_features,
        result.ranking,
        result.support,
        result.validation_scores,
        result.estimator_name,
        config.n_splits,
        float(config.step),
        config.min_features_to_select,
        config.scoring,
        config.gap,
        result.dropped_features,
    )
    spark.createDataFrame([row], ARTIFACT_SCHEMA).write.mode("overwrite").json(path)


def load_selected_features(spark: SparkSession, path: str) -> list[str]:
    """The list of names, from what ``save_selection`` wrote or any JSON file like it."""
    text = spark.read.text(path, wholetext=True).first()
    data = json.loads(text[0]) if text else {}
    names = data.get("selected_features")
    if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
        raise ValueError(f"{path} holds no list 'selected_features'.")
    return names
