"""The training job: dataset, splits, competition, run log, registered winner."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import label_name
from tidemark.ml.competition import Candidate, Outcome, run_competition
from tidemark.ml.selection import SelectionConfig, load_selected_features, save_selection
from tidemark.ml.stages import FeatureAssembler
from tidemark.ml.tuning import save_tuning
from tidemark.operators.clean import keep_one_per_key, numbers_to_double
from tidemark.operators.profile import first_rows, last_rows
from tidemark.operators.split import TRAIN, temporal_split
from tidemark.sources.models import register_model
from tidemark.sources.runs import RunLog

DEFAULT_CANDIDATES = ({"name": "linear_regression", "estimator": "linear_regression"},)


@dataclass
class TrainingResult:
    outcome: Outcome
    best_name: str
    metrics_val: dict[str, float | None]
    metrics_test: dict[str, float | None]
    selected_features: list[str]
    version: str | None
    run_id: str | None
    artifact_path: str | None


def run_training(
    dataset: DataFrame,
    config: Mapping,
    *,
    models_path: str | None = None,
    runs_path: str | None = None,
) -> TrainingResult:
    """Trains on every series of ``dataset`` at once; paths are optional outputs.

    ``config`` has the keys target_column, horizon, split, assembler,
    feature_selection, candidates, extra_steps, primary_metric and model_registry.
    ``feature_selection.selected_features_path`` names a file whose features are used as they are.
    """
    spark = dataset.sparkSession
    target = config.get("target_column", "Close")
    horizon = int(config.get("horizon", 1))
    split = dict(config.get("split") or {})
    split.pop("test_size", None)  # what train and val leave over is the test split
    label = label_name(target, horizon)

    chosen = dict(config.get("feature_selection") or {})
    given = chosen.get("selected_features_path")
    selected = load_selected_features(spark, given) if given else None
    wanted = chosen.pop("enabled", True) and selected is None
    selection = selection_from(chosen, split) if wanted else None
    assembler = FeatureAssembler(**{"target_column": target, **(config.get("assembler") or {})})
    candidates = [
        Candidate.from_mapping(c) for c in config.get("candidates") or DEFAULT_CANDIDATES
    ]

    rows = keep_one_per_key(numbers_to_double(dataset), "last")
    splits = temporal_split(rows, target, horizon=horizon, **split)

    run = RunLog(spark, runs_path, "training") if runs_path else None
    if run:
        run.set_tags({"target": target, "label_column": label})
        run.log_params({**split, "horizon": horizon})
    outcome = run_competition(
        splits,
        label,
        assembler,
        candidates,
        selection,
        config.get("primary_metric", "rmse"),
        [step["type"] for step in config.get("extra_steps") or []],
        run,
        selected,
    )
    best = outcome.best
    artifact = None
    if selection is not None and chosen.get("artifact_dir"):
        artifact = f"{chosen['artifact_dir']}/{chosen.get('artifact_name', 'selected_features.json')}"
        save_selection(spark, outcome.selection, selection, artifact)
    saved = save_searches(candidates, outcome)
    if run:
        for name, path in saved.items():
            run.log_dict({"path": path, "best_params": tuned_params(outcome, name)}, f"hyperparameters/{name}")
        run.set_tags({"best_candidate": best.name})
        run.log_params(
            {
                "best_candidate": best.name,
                "prediction_horizon": horizon,
                "required_history_lag": assembler.required_history(),
                "selected_features_count": len(outcome.selection.selected_features),
            }
        )
        run.log_metrics({f"best_val_{k}": v for k, v in best.metrics_val.items()})
        run.log_metrics({f"best_test_{k}": v for k, v in best.metrics_test.items()})
        run.log_dict(
            {
                "selected_features": outcome.selection.selected_features,
                "ranking": list(outcome.selection.ranking),
                "support": [bool(s) for s in outcome.selection.support],
                "validation_scores": list(outcome.selection.validation_scores),
                "dropped_features": list(outcome.selection.dropped_features),
            },
            "feature_selection/selected_features.json",
        )
        run.end()

    version = None
    registry = config.get("model_registry") or {}
    if models_path and registry.get("model_name"):
        version = register_model(
            spark,
            models_path,
            best.model,
            registry["model_name"],
            run_id=run.run_id if run else None,
            tags=registry.get("tags"),
            example=signature_sample(splits, label),
        )
    return TrainingResult(
        outcome,
        best.name,
        best.metrics_val,
        best.metrics_test,
        outcome.selection.selected_features,
        version,
        run.run_id if run else None,
        artifact,
    )


def save_searches(candidates: list[Candidate], outcome: Outcome) -> dict[str, str]:
    """Writes the search of each candidate whose tuning names an ``artifact_dir``."""
    paths = {}
    for candidate, result in zip(candidates, outcome.results):
        if result.tuning is not None and candidate.tuning.artifact_dir:
            tuning = candidate.tuning
            paths[candidate.name] = f"{tuning.artifact_dir}/{candidate.name}/{tuning.artifact_name}"
            save_tuning(result.tuning, tuning, paths[candidate.name])
    return paths


def tuned_params(outcome: Outcome, name: str) -> dict:
    return next(r.params for r in outcome.results if r.name == name)


def selection_from(chosen: Mapping, split: Mapping) -> SelectionConfig:
    known = {
        k: v
        for k, v in chosen.items()
        if k in SelectionConfig.__dataclass_fields__ and v is not None
    }
    known.setdefault("min_features_to_select", 5)
    known.setdefault("gap", int(split.get("gap", 0)))
    return SelectionConfig(**known)


def signature_sample(splits: DataFrame, label: str) -> DataFrame:
    """The first five of the last fifty train rows, without the label."""
    train = splits.filter(F.col("split") == TRAIN).drop(label, "split")
    return first_rows(last_rows(train, 50), 5)
