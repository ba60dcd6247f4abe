"""Several candidate models on the same splits: shared features, one scoring pass, a winner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.ml.estimators import create_estimator
from tidemark.ml.selection import (
    SelectionConfig,
    SelectionResult,
    keep_all,
    select_features,
)
from tidemark.ml.stages import (
    FeatureAssembler,
    FeatureSubset,
    FeatureVector,
    FillMissing,
    extra_stage,
    feature_columns,
)
from tidemark.ml.tuning import TuningConfig, TuningResult, fit_chosen, search
from tidemark.operators.metrics import METRICS, check_metric, evaluate, leaderboard
from tidemark.operators.moments import correlated_columns
from tidemark.operators.ordered import KEYS, ORDER, measure
from tidemark.operators.split import TRAIN
from tidemark.session import freeze


@dataclass
class Candidate:
    name: str
    estimator: str
    params: dict = field(default_factory=dict)
    extra_steps: list[str] = field(default_factory=list)
    tags: dict = field(default_factory=dict)
    tuning: TuningConfig | None = None

    @classmethod
    def from_mapping(cls, data: Mapping) -> Candidate:
        tuning = None
        if data.get("tuning"):
            tuning = TuningConfig.from_mapping(data["tuning"])
            if not tuning.param_grid:
                raise ValueError(f"Candidate {data['name']!r} has tuning without 'param_grid'.")
        return cls(
            name=str(data["name"]),
            estimator=data.get("estimator", data["name"]),
            params=dict(data.get("params") or {}),
            extra_steps=[step["type"] for step in data.get("extra_steps") or []],
            tags=dict(data.get("tags") or {}),
            tuning=tuning,
        )


@dataclass
class CandidateResult:
    name: str
    model: PipelineModel
    params: dict
    tuning_score: float | None
    tuning: TuningResult | None
    metrics_val: dict[str, float | None]
    metrics_test: dict[str, float | None]


@dataclass
class Outcome:
    selection: SelectionResult
    results: list[CandidateResult]
    leaderboard: DataFrame
    best: CandidateResult


def feature_stages(
    assembler: FeatureAssembler, selected: Sequence[str] | None, extra: Sequence[str] = ()
) -> list:
    """The stages before the estimator."""
    stages = [assembler, FillMissing()]
    if selected is not None:
        stages.append(FeatureSubset(features=list(selected), fail_on_missing=False))
    return [*stages, *[extra_stage(kind) for kind in extra], FeatureVector()]


def complete_rows(
    train: DataFrame, assembler: FeatureAssembler
) -> tuple[DataFrame, DataFrame]:
    """The feature rows without a null, and the original rows they stem from."""
    matrix = freeze(assembler.fit(train).transform(train).dropna())
    keys = [*KEYS, *ORDER]
    return matrix, measure(freeze(train.join(matrix.select(*keys), keys, "left_semi")))


def choose_features(
    matrix: DataFrame, original: DataFrame, label: str, config: SelectionConfig | None, name: str
) -> SelectionResult:
    """Drops correlated base columns, then eliminates; without a config all features stay."""
    if config is None:
        return keep_all(feature_columns(matrix), SelectionConfig(estimator=name))
    dropped: list[str] = []
    if config.correlation_threshold is not None:
        base = [c for c in feature_columns(matrix) if c in original.columns]
        dropped = correlated_columns(matrix, base, config.correlation_threshold)
    return select_features(matrix.drop(*dropped), label, config, dropped)


def run_competition(
    splits: DataFrame,
    label: str,
    assembler: FeatureAssembler,
    candidates: Sequence[Candidate],
    selection: SelectionConfig | None = None,
    primary_metric: str = "rmse",
    extra_steps: Sequence[str] = (),
    tracker=None,
    selected: Sequence[str] | None = None,
) -> Outcome:
    """Selects features on the train rows, fits every candidate, scores val and test.

    With ``selected`` (say, read back from a file) those features are used as they are.
    Features of val and test rows are built inside their own slice.
    """
    if not candidates:
        raise ValueError("Name at least one candidate.")
    check_metric(primary_metric)
    splits = measure(freeze(splits))
    train = splits.filter(F.col("split") == TRAIN)
    matrix, train_rows = complete_rows(train, assembler)
    if selected is not None:
        chosen = keep_all(list(selected), SelectionConfig(estimator=candidates[0].estimator))
    else:
        chosen = choose_features(matrix, train_rows, label, selection, candidates[0].estimator)
    held_out = splits.filter(F.col("split") != TRAIN)

    # Candidates with the same extra steps share the fitted features.
    prepared: dict[tuple, tuple[PipelineModel, DataFrame, DataFrame]] = {}
    fitted, predictions = [], []
    for position, candidate in enumerate(candidates):
        extra = tuple([*extra_steps, *candidate.extra_steps])
        stages = feature_stages(assembler, chosen.selected_features, extra)
        params, tuning_score, model, tuned = candidate.params, None, None, None
        if candidate.tuning is not None:
            tuned = search(
                stages, candidate.estimator, candidate.params, train_rows, label, candidate.tuning
            )
            params, tuning_score, model = tuned.best_params, tuned.best_score, tuned.model
            if model is None:  # the search itself was told not to refit
                model = fit_chosen(
                    stages, candidate.estimator, candidate.params, params, train_rows, label
                )
        if model is None:
            if extra not in prepared:
                before = Pipeline(stages=stages).fit(train_rows)
                prepared[extra] = (
                    before,
                    freeze(before.transform(train_rows)),
                    freeze(before.transform(held_out)),
                )
            before, ready, held = prepared[extra]
            last = create_estimator(candidate.estimator, candidate.params, label).fit(ready)
            model = PipelineModel([*before.stages, last])
            predicted = last.transform(held)
        else:
            predicted = model.transform(held_out)
        fitted.append((candidate, model, params, tuning_score, tuned))
        predictions.append(
            predicted.select(
                F.lit(candidate.name).alias("candidate"),
                F.lit(position).alias("position"),
                "split",
                F.col(label).alias("label"),
                "prediction",
            )
        )

    union = reduce(DataFrame.unionByName, predictions)
    scored = freeze(evaluate(union, "label", "prediction", ["candidate", "position", "split"]))
    rows = {(r.candidate, r.split): r for r in scored.collect()}
    results = []
    for candidate, model, params, tuning_score, tuned in fitted:
        both = []
        for split in ("val", "test"):
            row = rows.get((candidate.name, split))
            if row is None or not row.n:
                raise ValueError(f"No valid {split} rows to score {candidate.name!r} on.")
            both.append({m: row[m] for m in METRICS})
        results.append(CandidateResult(candidate.name, model, params, tuning_score, tuned, *both))
        if tracker is not None:
            _report(tracker.nested(candidate.name), candidate, results[-1], chosen, selection, label)

    board = leaderboard(scored.filter(F.col("split") == "val"), primary_metric)
    winner = board.orderBy("place").first().candidate
    best = next(r for r in results if r.name == winner)
    return Outcome(chosen, results, board, best)


def _report(run, candidate, result, chosen, selection, label) -> None:
    run.set_tags(
        {
            "candidate": candidate.name,
            "estimator": candidate.estimator,
            "label_column": label,
            **candidate.tags,
        }
    )
    run.log_params(
        {
            **candidate.params,
            "feature_selection_estimator": selection.estimator if selection else None,
            "selected_features_count": len(chosen.selected_features),
        }
    )
    if result.tuning_score is not None:
        run.log_metrics({"tuning_best_score": result.tuning_score})
        run.log_params({f"tuning__{k}": v for k, v in result.params.items()})
    run.log_metrics({f"val_{k}": v for k, v in result.metrics_val.items()})
    run.log_metrics({f"test_{k}": v for k, v in result.metrics_test.items()})
    run.end()
