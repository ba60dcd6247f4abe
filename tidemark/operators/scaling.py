"""Standard, min-max and robust scaling with statistics from distributed aggregates.

Statistics describe the mean-imputed column: a missing value counts as the mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quantiles
from tidemark.session import compiled

SCALERS = {
    "standard": "standard",
    "standard_scaler": "standard",
    "minmax": "minmax",
    "minmax_scaler": "minmax",
    "robust": "robust",
    "robust_scaler": "robust",
}


def scaler_kind(name: str) -> str:
    kind = SCALERS.get(name.lower()) if isinstance(name, str) else None
    if kind is None:
        raise ValueError(f"Unknown scaler {name!r}. Options: {list(SCALERS)}")
    return kind


Statistics = dict[str, tuple[float, float]]


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean per column, 0.0 for a column without values."""
    with compiled(df.sparkSession):
        row = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    return {c: float(row[c]) for c in columns}


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str) -> Statistics:
    """(centre, scale) per column; a column without spread has the scale 1."""
    statistics, _ = fit_columns(df, columns, kind)
    return statistics


def fit_columns(
    df: DataFrame, columns: Sequence[str], kind: str | None
) -> tuple[Statistics, list[str]]:
    """The scaler's statistics and the columns without any value, from one aggregate.

    Robust scaling needs the quartiles as well, which take another pass.
    """
    kind = scaler_kind(kind) if kind is not None else None
    if not columns:
        return {}, []
    if kind == "robust":
        return _fit_robust(df, columns)
    pieces = []
    for i, c in enumerate(columns):
        mean, least, most = f"coalesce(avg(`{c}`), 0D)", f"min(`{c}`)", f"max(`{c}`)"
        if kind == "standard":
            share = f"try_divide(count(`{c}`), count(1))"
            centre, scale = mean, f"sqrt(var_pop(`{c}`) * {share})"
        elif kind == "minmax":
            centre, scale = least, f"{most} - {least}"
        else:
            centre, scale = mean, "1D"
        pieces += [f"count(`{c}`) as n{i}", f"{centre} as c{i}", f"{scale} as s{i}"]
    with compiled(df.sparkSession):
        row = df.selectExpr(*pieces).first()
    empty = [c for i, c in enumerate(columns) if row[f"n{i}"] == 0]
    if kind is None:
        return {}, empty
    statistics = {
        c: (float(row[f"c{i}"] or 0.0), float(row[f"s{i}"] or 0.0) or 1.0)
        for i, c in enumerate(columns)
    }
    return statistics, empty


def _fit_robust(df: DataFrame, columns: Sequence[str]) -> tuple[Statistics, list[str]]:
    """Median and distance of the quartiles; the pass for the means sums up the values as well."""
    statistics: Statistics = {}
    empty: list[str] = []
    for a in range(0, len(columns), quantiles.COLUMNS):
        some = columns[a : a + quantiles.COLUMNS]
        pieces, read = ["count(1) as rows"], ["rows", *quantiles.sketch_values(len(some))]
        for i, c in enumerate(some):
            pieces += [f"count(`{c}`) as n{i}", f"coalesce(avg(`{c}`), 0D) as c{i}", quantiles.sketch(i, c)]
            read += [f"n{i}", f"c{i}"]
        with compiled(df.sparkSession):
            row = df.selectExpr(*pieces).select(*read).first()
        means = [float(row[f"c{i}"]) for i in range(len(some))]
        empty += [c for i, c in enumerate(some) if row[f"n{i}"] == 0]
        known = [quantiles.sketched(row, i, row.rows - row[f"n{i}"], mean) for i, mean in enumerate(means)]
        quartiles = quantiles.quantiles_of(df, some, known, (0.25, 0.5, 0.75))
        for c, mean in zip(some, means):
            low, mid, high = quartiles[c]
            statistics[c] = (mean, 1.0) if mid is None else (mid, (high - low) or 1.0)
    return statistics, empty


def apply_scaler(df: DataFrame, statistics: Statistics) -> DataFrame:
    """(value - centre) / scale; a missing value stays missing."""
    def scaled(c: str) -> str:
        centre, scale = statistics[c]
        return f"(`{c}` - ({centre!r}D)) / {scale!r}D as `{c}`"

    return df.selectExpr(*[scaled(c) if c in statistics else f"`{c}`" for c in df.columns])
