"""Chronological splits and folds by position, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import label_name, positive, require_columns
from tidemark.operators.ordered import KEYS, ORDER, is_long, measure, over_rows, with_position
from tidemark.session import freeze

TRAIN, VAL, TEST = "train", "val", "test"


def add_label(
    df: DataFrame,
    target: str,
    horizon: int,
    *,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The target ``horizon`` rows ahead; rows without one are dropped."""
    require_columns(df, [target])
    horizon = positive("horizon", horizon)
    name = label_name(target, horizon)
    labelled = over_rows(
        df,
        lambda window: [F.lead(target, horizon).over(window).alias(name)],
        after=horizon,
        keys=keys,
        order=order,
    )
    return labelled.filter(F.col(name).isNotNull())


def temporal_split(
    df: DataFrame,
    target: str,
    *,
    train_size: float = 0.7,
    val_size: float = 0.15,
    gap: int = 0,
    horizon: int = 1,
    purge: int = 0,
    short_series: str = "error",
) -> DataFrame:
    """Labels the rows and names the split of each; rows in a gap are dropped.

    ``gap`` rows are left out on both sides of the train/val border and after the
    val/test border. ``purge`` leaves out that many more rows at the end of train
    and val; set it to the horizon to keep labels inside their split. A series too
    short for three non-empty splits is an error, or dropped with
    ``short_series='drop'``.
    """
    if short_series not in ("error", "drop"):
        raise ValueError(f"short_series must be 'error' or 'drop', not {short_series!r}.")
    measured = measure(df)
    labelled = add_label(measured, target, horizon)
    if is_long(measured, KEYS):
        # Long series are counted, sampled and written to be numbered: label them once.
        labelled = freeze(labelled)
    placed = with_position(labelled)
    rules = _split_rules(F.col("rows"), train_size, val_size, gap, purge)
    if short_series == "error":
        sizes = labelled.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"))
        worst = sizes.agg(
            F.count(F.lit(1)).alias("series"), F.min(F.struct(_usable(rules), *KEYS)).alias("low")
        ).first()
        if not worst["series"] or not worst["low"][0]:
            raise ValueError(f"Too few rows for three splits, for one in series {worst['low']}")
    position = F.col("position")
    split = F.lit(None).cast("string")
    for name, (start, end) in reversed(rules.items()):
        split = F.when((position >= start) & (position < end), F.lit(name)).otherwise(split)
    return (
        placed.filter(_usable(rules))
        .withColumn("split", split)
        .filter(F.col("split").isNotNull())
        .drop("position", "rows")
    )


def _split_rules(
    n: Column, train_size: float, val_size: float, gap: int, purge: int
) -> dict[str, tuple[Column, Column]]:
    """Half-open position ranges of the three splits."""
    train_end = F.floor(n * F.lit(float(train_size)))
    val_end = train_end + F.floor(n * F.lit(float(val_size)))
    return {
        TRAIN: (F.lit(0), F.greatest(train_end - gap - purge, F.lit(0))),
        VAL: (train_end + gap, val_end - purge),
        TEST: (val_end + gap, n),
    }


def _usable(rules: dict[str, tuple[Column, Column]]) -> Column:
    condition = F.lit(True)
    for start, end in rules.values():
        condition = condition & (end > start)
    return condition


def fold_ranges(rows: Column, splits: int, gap: int) -> list[dict[str, tuple[Column, Column]]]:
    """Half-open ranges of the expanding folds: equal tests at the end, all before is train."""
    if splits < 2:
        raise ValueError("At least 2 folds are needed.")
    size = F.floor(rows / (splits + 1))
    folds = []
    for i in range(splits):
        start = rows - (splits - i) * size
        folds.append(
            {
                "train": (F.lit(0), F.greatest(start - gap, F.lit(0))),
                "test": (start, start + size),
            }
        )
    return folds


def expanding_folds(
    df: DataFrame,
    splits: int,
    gap: int = 0,
    *,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per original row, fold and role; a row in no fold disappears."""
    placed = with_position(df, keys=keys, order=order)
    position = F.col("position")
    roles = []
    for fold, ranges in enumerate(fold_ranges(F.col("rows"), splits, gap)):
        for role, (start, end) in ranges.items():
            member = F.struct(F.lit(fold).alias("fold"), F.lit(role).alias("role"))
            roles.append(F.when((position >= start) & (position < end), member))
    return (
        placed.withColumn("_member", F.explode(F.array_compact(F.array(*roles))))
        .select(*df.columns, "_member.fold", "_member.role")
    )
