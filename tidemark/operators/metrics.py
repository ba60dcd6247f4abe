"""Regression metrics, scorers, and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import ratio

METRICS = ("rmse", "mae", "mape", "mse", "r2")

# Added to the signed target in mape; least divisor of the scorer.
MAPE_SHIFT = 1e-8
SCORER_LEAST = 2.220446049250313e-16

SCORERS = (
    "neg_mean_absolute_percentage_error",
    "neg_mean_absolute_error",
    "neg_mean_squared_error",
    "neg_root_mean_squared_error",
    "r2",
)


def metric_columns(label: str, prediction: str) -> list[Column]:
    """Aggregates over the rows that have a label; r2 is NULL for a constant label."""
    y = F.when(F.col(prediction).isNotNull(), F.col(label))
    error = F.col(label) - F.col(prediction)
    mse = F.avg(error * error)
    return [
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(ratio(error, F.col(label) + MAPE_SHIFT))) * 100).alias("mape"),
        mse.alias("mse"),
        (1 - ratio(mse, F.var_pop(y))).alias("r2"),
    ]


def evaluate(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row of metrics per group, all groups in one aggregate."""
    return df.groupBy(*by).agg(
        F.count(F.col(label) - F.col(prediction)).alias("n"), *metric_columns(label, prediction)
    )


def evaluate_one(df: DataFrame, label: str, prediction: str) -> dict[str, float | None]:
    row = evaluate(df, label, prediction).first()
    if not row["n"]:
        raise ValueError("No rows with a label and a prediction.")
    return {name: row[name] for name in METRICS}


def score_column(scoring: str | None, label: str, prediction: str) -> Column:
    """Aggregate where more is better; without a name, r2."""
    error = F.col(label) - F.col(prediction)
    name = scoring or "r2"
    if name == "neg_mean_absolute_percentage_error":
        return -F.avg(F.abs(error) / F.greatest(F.abs(F.col(label)), F.lit(SCORER_LEAST)))
    if name == "neg_mean_absolute_error":
        return -F.avg(F.abs(error))
    if name == "neg_mean_squared_error":
        return -F.avg(error * error)
    if name == "neg_root_mean_squared_error":
        return -F.sqrt(F.avg(error * error))
    if name == "r2":
        y = F.when(F.col(prediction).isNotNull(), F.col(label))
        return 1 - ratio(F.avg(error * error), F.var_pop(y))
    raise ValueError(f"Unknown scoring {scoring!r}. Options: {list(SCORERS)}")


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise KeyError(f"Unknown metric {metric!r}. Options: {list(METRICS)}")
    return metric


def leaderboard(results: DataFrame, metric: str, position: str = "position") -> DataFrame:
    """Adds ``place``: best metric first, earlier position on ties. One row per candidate.

    Smaller is better, except for r2.
    """
    value = -F.col(metric) if check_metric(metric) == "r2" else F.col(metric)
    ranked = Window.orderBy(value.asc_nulls_last(), position)
    return results.withColumn("place", F.row_number().over(ranked).cast("long"))


def summarize_folds(scores: DataFrame, params: str = "params") -> DataFrame:
    """Mean, deviation and rank of the fold scores of each parameter set."""
    summary = scores.groupBy(params).agg(
        F.avg("score").alias("mean_test_score"),
        F.stddev_pop("score").alias("std_test_score"),
    )
    ranked = Window.orderBy(F.desc_nulls_last("mean_test_score"))
    return summary.withColumn("rank_test_score", F.rank().over(ranked).cast("long"))
