"""Grid and random search over expanding folds."""

from __future__ import annotations

import itertools
import json
import math
import random
import sys
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml.estimators import create_estimator
from tidemark.ml.folded import FoldedRows, TreeModel, supports
from tidemark.ml.linear import LINEAR
from tidemark.ml.trees import BinnedTrees
from tidemark.operators.metrics import score_column, summarize_folds
from tidemark.operators.ordered import measure
from tidemark.operators.split import expanding_folds
from tidemark.session import freeze

_PARALLEL_FITS = 6
_STEP = "feature_assembler__"
_MODEL = "estimator__"


@dataclass
class TuningConfig:
    strategy: str = "grid"
    param_grid: Mapping[str, Sequence] | None = None
    n_iter: int | None = None
    scoring: str | None = None
    n_splits: int = 3
    gap: int = 0
    refit: bool = True
    random_state: int | None = None
    artifact_dir: str | None = None
    artifact_name: str = "tuning_results.json"

    @classmethod
    def from_mapping(cls, data: Mapping) -> TuningConfig:
        known = {k: v for k, v in data.items() if k in cls.__dataclass_fields__ and v is not None}
        if "strategy" in known:
            known["strategy"] = str(known["strategy"]).lower()
        return cls(**known)


@dataclass
class TuningResult:
    best_params: dict
    best_score: float
    scores: DataFrame  # params, fold, score, fit_seconds
    summary: DataFrame  # params, mean_test_score, std_test_score, rank_test_score
    model: PipelineModel | None = field(default=None)


def parameter_sets(config: TuningConfig) -> list[dict]:
    """All combinations, or seeded draws from them without repetition."""
    if not config.param_grid or any(len(v) == 0 for v in config.param_grid.values()):
        raise ValueError("Tuning needs a 'param_grid' with at least one value per key.")
    if config.strategy not in ("grid", "random"):
        raise ValueError(f"Unknown strategy {config.strategy!r}. Options: ['grid', 'random']")
    names = sorted(config.param_grid)
    unknown = [n for n in names if not n.startswith((_STEP, _MODEL))]
    if unknown:
        raise ValueError(f"Unknown parameters {unknown}: use '{_MODEL}' or '{_STEP}' names.")
    if config.strategy == "grid":
        values = itertools.product(*(config.param_grid[n] for n in names))
        return [dict(zip(names, v)) for v in values]
    total = math.prod(len(config.param_grid[n]) for n in names)
    drawn = _draws(random.Random(config.random_state), total, min(config.n_iter or 10, total))
    return [_numbered_set(config.param_grid, names, number) for number in drawn]


def _draws(draw: random.Random, total: int, many: int) -> list[int]:
    """Distinct numbers below ``total``; ranges may be longer than what ``sample`` takes."""
    if total <= sys.maxsize:
        return draw.sample(range(total), many)
    found: dict[int, None] = {}
    while len(found) < many:
        found[draw.randrange(total)] = None
    return list(found)


def _numbered_set(grid: Mapping[str, Sequence], names: Sequence[str], number: int) -> dict:
    """The set at a place of the grid, whose last name turns fastest, without building the grid."""
    chosen = {}
    for name in reversed(names):
        number, at = divmod(number, len(grid[name]))
        chosen[name] = grid[name][at]
    return {name: chosen[name] for name in names}


def search(
    steps: Sequence,
    estimator: str,
    params: Mapping | None,
    train: DataFrame,
    label: str,
    config: TuningConfig,
) -> TuningResult:
    """Scores every parameter set on every fold and fits the best one on all rows.

    ``steps`` are the stages before the estimator, the assembler first. Linear models and trees share
    one table for each setting of the assembler, in which every row stands once; the others are
    fitted one by one.
    """
    grid = parameter_sets(config)
    sets = [_Set(k, chosen, _model_params(params, chosen)) for k, chosen in enumerate(grid)]
    for each in sets:
        each.stage = create_estimator(estimator, each.params, label)
    shared: dict[str, list[_Set]] = {}
    for each in sets:
        changes = {k: v for k, v in each.chosen.items() if k.startswith(_STEP)}
        shared.setdefault(json.dumps(changes, sort_keys=True), []).append(each)
    groups = list(shared.values())
    train = measure(train)
    changed = [_changed(steps, group[0].chosen) for group in groups]
    if _from_shared_rows(estimator, sets, changed):
        function = _search_shared
    else:
        function = _search_by_fits
    tasks = [(train, c, estimator, group, label, config) for c, group in zip(changed, groups)]
    results = [r for part in _in_parallel(train.sparkSession, function, tasks) for r in part]

    scores = train.sparkSession.createDataFrame(
        [(json.dumps(s.chosen, sort_keys=True), fold, score, seconds) for s, fold, score, seconds in results],
        "params string, fold int, score double, fit_seconds double",
    )
    order = {json.dumps(chosen, sort_keys=True): i for i, chosen in enumerate(grid)}
    summary = summarize_folds(scores)
    ranked = sorted(summary.collect(), key=lambda r: (r.rank_test_score, order[r.params]))
    best = json.loads(ranked[0].params)
    model = None
    if config.refit:
        model = fit_chosen(steps, estimator, params, best, train, label)
    return TuningResult(best, ranked[0].mean_test_score, scores, summary, model)


@dataclass
class _Set:
    place: int
    chosen: dict
    params: dict
    stage: object = None


Scored = tuple[_Set, int, float | None, float]


def _from_shared_rows(estimator: str, sets: Sequence[_Set], changed: Sequence[list]) -> bool:
    if not all(supports(steps) for steps in changed):
        return False
    if estimator in LINEAR:
        return all(s.params.get("fit_intercept") in (None, True) for s in sets)
    return isinstance(sets[0].stage, BinnedTrees)


def _search_shared(
    train: DataFrame, steps: Sequence, estimator: str, sets: list[_Set], label: str, config: TuningConfig
) -> list[Scored]:
    """All sets and folds from one table: one pass for sums, one for scores, trees in between."""
    rows = FoldedRows(train, steps, label, config.n_splits, config.gap)
    folds = range(config.n_splits)
    if estimator in LINEAR:
        named: list[tuple[_Set, int, object]] = [
            (one, fold, model)
            for fold in folds
            for one, model in zip(sets, rows.linear_models(estimator, [s.params for s in sets], fold))
        ]
    else:
        named = _shared_trees(rows, sets, folds)
    scores = rows.score([(fold, model) for _, fold, model in named], config.scoring)
    return [
        (one, fold, None if math.isnan(score) else score, model.seconds)
        for (one, fold, model), score in zip(named, scores)
    ]


def _shared_trees(rows: FoldedRows, sets: list[_Set], folds: range) -> list[tuple[_Set, int, object]]:
    """Trees for all sets and folds; sets that differ in the number of trees share the longest fit."""
    alike: dict[tuple, list[_Set]] = {}
    for one in sets:
        settings = one.stage.tree_settings()
        bins = one.stage.getOrDefault("maxBins")
        alike.setdefault((bins, replace(settings, trees=0)), []).append(one)
    out = []
    for bins in sorted({bins for bins, _ in alike}):
        kinds = [(settings, group) for (own, settings), group in alike.items() if own == bins]
        longest = [
            replace(settings, trees=max(s.stage.tree_settings().trees for s in group))
            for settings, group in kinds
        ]
        table = rows.trees(bins)
        grown = iter(table.fit([rows.tree_fit(s, fold) for fold in folds for s in longest]))
        for fold in folds:
            for settings, group in kinds:
                ensemble = next(grown)
                for one in group:
                    many = one.stage.tree_settings().trees
                    part = ensemble.first(many)
                    part.seconds *= many / max(1, len(ensemble.trees))
                    if settings.kind != "boosting":
                        part = replace(part.averaged(), seconds=part.seconds)
                    out.append((one, fold, TreeModel(rows.view(fold), part, table)))
    return out


def _search_by_fits(
    train: DataFrame, steps: Sequence, estimator: str, sets: list[_Set], label: str, config: TuningConfig
) -> list[Scored]:
    """Each set on each fold as a fit of its own, on features that the sets share."""
    members = freeze(expanding_folds(train, config.n_splits, config.gap))

    def prepare(fold: int) -> tuple[DataFrame, DataFrame]:
        rows = members.filter(F.col("fold") == fold)
        before = Pipeline(stages=list(steps)).fit(rows.filter(F.col("role") == "train"))
        ready = freeze(before.transform(rows))
        return ready.filter(F.col("role") == "train"), ready.filter(F.col("role") == "test")

    def run(fold: int, frames: tuple[DataFrame, DataFrame], one: _Set) -> Scored:
        start = time.time()
        model = one.stage.fit(frames[0])
        seconds = time.time() - start
        score = score_column(config.scoring, label, "prediction")
        value = model.transform(frames[1]).agg(score.alias("s")).first()[0]
        return one, fold, value, seconds

    session = train.sparkSession
    frames = _in_parallel(session, prepare, [(fold,) for fold in range(config.n_splits)])
    tasks = [(fold, frame, one) for fold, frame in enumerate(frames) for one in sets]
    return _in_parallel(session, run, tasks)


def _in_parallel(session: SparkSession, function, tasks: list[tuple]) -> list:
    # A wrapper copies the job properties when it is made. Each task needs its own:
    # threads that share one copy overwrite each other's.
    if len(tasks) == 1:
        return [function(*tasks[0])]
    with ThreadPoolExecutor(_PARALLEL_FITS) as pool:
        futures = [pool.submit(inheritable_thread_target(session)(function), *t) for t in tasks]
        return [future.result() for future in futures]


def fit_chosen(
    steps: Sequence, estimator: str, params: Mapping | None, chosen: Mapping, train: DataFrame, label: str
) -> PipelineModel:
    """One parameter set, for the steps as well as the estimator, fitted on all rows."""
    final = create_estimator(estimator, _model_params(params, chosen), label)
    return Pipeline(stages=[*_changed(steps, chosen), final]).fit(train)


def save_tuning(result: TuningResult, config: TuningConfig, path: str) -> None:
    """One row per parameter set and fold, with the set's summary and the search's settings."""
    best = json.dumps(result.best_params, sort_keys=True)
    settings = {
        "strategy": config.strategy,
        "param_grid": json.dumps({k: list(v) for k, v in config.param_grid.items()}),
        "n_splits": config.n_splits,
        "gap": config.gap,
        "scoring": config.scoring,
        "refit": config.refit,
        "best_params": best,
        "best_score": result.best_score,
    }
    rows = result.scores.join(result.summary, "params").withColumns(
        {
            "is_best": F.col("params") == F.lit(best),
            **{name: F.lit(value) for name, value in settings.items()},
        }
    )
    rows.write.mode("overwrite").json(path)


def _changed(steps: Sequence, chosen: Mapping) -> list:
    changes = {k[len(_STEP) :]: v for k, v in chosen.items() if k.startswith(_STEP)}
    return [steps[0].with_settings(**changes), *steps[1:]] if changes else list(steps)


def _model_params(params: Mapping | None, chosen: Mapping) -> dict:
    tuned = {k[len(_MODEL) :]: v for k, v in chosen.items() if k.startswith(_MODEL)}
    return {**(params or {}), **tuned}
