"""Sums of products over many columns, gathered in one distributed pass.

Each task multiplies its Arrow batches with numpy and returns one small matrix per
group; the matrices are added by a shuffle on (group, row, column). What reaches the
driver grows with the square of the column count and not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def products(
    df: DataFrame,
    columns: Sequence[str],
    group: str | None = None,
    centres: Sequence[float] | None = None,
) -> dict[int, np.ndarray]:
    """Per group, the matrix of sums of products of [1, columns]; rows must be complete.

    With ``centres`` these are subtracted first, which keeps the differences of large
    sums accurate.
    """
    names = list(columns)
    width = len(names) + 1
    shift = np.zeros(len(names)) if centres is None else np.asarray(centres, dtype=float)

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, rows in batch.groupby("_group", sort=False):
                centred = rows[names].to_numpy(float) - shift
                values = np.column_stack([np.ones(len(rows)), centred])
                totals[key] = totals.get(key, 0.0) + values.T @ values
        for key, total in totals.items():
            i, j = np.triu_indices(width)
            yield pd.DataFrame({"g": key, "i": i, "j": j, "total": total[i, j]})

    key = F.col(group).cast("int") if group else F.lit(0)
    parts = df.select(key.alias("_group"), *[F.col(c).cast("double") for c in names]).mapInPandas(
        per_task, "g int, i int, j int, total double"
    )
    summed = parts.groupBy("g", "i", "j").agg(F.sum("total").alias("total")).toPandas()
    matrices: dict[int, np.ndarray] = {}
    for key, cells in summed.groupby("g"):
        matrix = np.zeros((width, width))
        matrix[cells["i"], cells["j"]] = cells["total"]
        matrices[int(key)] = np.triu(matrix) + np.triu(matrix, 1).T
    return matrices


def pairwise_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, corr) for each pair a before b, over the rows where both have a value.

    A constant side gives NULL. Columns are centred by their means first, which keeps
    the differences of large sums accurate. Many columns are taken tile by tile: a task
    reads the columns of two tiles only, so its memory does not grow with their number.
    """
    names = list(columns)
    if len(names) < 2:
        raise ValueError("Correlation needs at least two columns.")
    centres = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in names]).first()
    shift = np.array([centres[c] for c in names], dtype=float)
    tiles = [range(i, min(i + _TILE, len(names))) for i in range(0, len(names), _TILE)]
    parts = [
        _tile_sums(df, names, shift, left, right)
        for k, left in enumerate(tiles)
        for right in tiles[k:]
    ]
    sums = reduce(DataFrame.unionByName, parts)
    sums = sums.groupBy("i", "j").agg(*[F.sum(name).alias(name) for name in _SUMS])
    n, covariance = F.col("n"), F.col("xy") * F.col("n") - F.col("x") * F.col("y")
    spread_x = F.col("xx") * n - F.col("x") * F.col("x")
    spread_y = F.col("yy") * n - F.col("y") * F.col("y")
    # What rounding leaves of a constant column is far below this share of its square sum.
    varies = (spread_x > F.col("xx") * n * 1e-12) & (spread_y > F.col("yy") * n * 1e-12)
    label = F.array(*[F.lit(c) for c in names])
    return sums.select(
        label[F.col("i")].alias("a"),
        label[F.col("j")].alias("b"),
        F.col("i"),
        F.col("j"),
        n.cast("long").alias("n"),
        F.when(varies, covariance / F.sqrt(spread_x * spread_y)).alias("corr"),
    )


_SUMS = ("n", "xy", "x", "y", "xx", "yy")
#: Columns of a tile: a task reads two tiles and holds six matrices of this width.
_TILE = 512


def _tile_sums(
    df: DataFrame, names: Sequence[str], shift: np.ndarray, left: range, right: range
) -> DataFrame:
    """i, j and _SUMS of the pairs between two tiles of columns, a row per pair and task."""
    used = sorted({*left, *right})
    rows, columns = [used.index(i) for i in left], [used.index(j) for j in right]
    centres = shift[used]
    wanted = [(a, b) for a, i in enumerate(left) for b, j in enumerate(right) if i < j]

    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(_SUMS), len(left), len(right)))
        for batch in batches:
            values = batch.to_numpy(float) - centres
            here = ~np.isnan(values)
            x, m = np.where(here, values, 0.0), here.astype(float)
            xa, xb, ma, mb = x[:, rows], x[:, columns], m[:, rows], m[:, columns]
            products_ = ((ma, mb), (xa, xb), (xa, mb), (ma, xb), (xa * xa, mb), (ma, xb * xb))
            for k, (a, b) in enumerate(products_):
                totals[k] += a.T @ b
        if wanted:
            a, b = np.array(wanted).T
            cells = {name: totals[k, a, b] for k, name in enumerate(_SUMS)}
            yield pd.DataFrame({"i": left.start + a, "j": right.start + b, **cells})

    schema = "i int, j int, " + ", ".join(f"{name} double" for name in _SUMS)
    return df.select(*[F.col(names[k]).cast("double") for k in used]).mapInPandas(per_task, schema)


def correlated_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> list[str]:
    """Columns whose absolute correlation with an earlier column exceeds the threshold.

    A column counts as earlier even if it is dropped itself. A threshold of zero or
    less drops nothing.
    """
    names = [c for c in columns if c in df.columns]
    if threshold <= 0 or len(names) < 2:
        return []
    pairs = pairwise_correlation(df, names).filter(F.abs("corr") > threshold)
    drop = {row.b for row in pairs.select("b").distinct().collect()}
    return [c for c in names if c in drop]
