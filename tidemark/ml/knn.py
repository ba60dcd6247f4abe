"""Exact nearest-neighbour regression without comparing every row with every other.

Features are rotated to their principal axes, which keeps distances. A bounded sample of the
training rows grows a tree of median splits, each along the axis of greatest spread; every training
row belongs to one leaf, a block, and the true bounds of its rows are the block's box. A query first
meets its own block. The distance of its k-th neighbour there is a radius that no farther box can
beat, and it shrinks: the few nearest boxes within it come next, then those that are still within
what is left of it. Every round groups queries by block, splits the queries of a much visited block
over several tasks, and keeps the k best of a query in each of them.

Blocks of one table are about equal, at most 4,096; a block with more than ``_BLOCK_ROWS`` rows is
kept in pieces that are visited one by one, so the memory of a task is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.moments import products
from tidemark.session import freeze, write_shared

_BLOCK_ROWS = 20_000
#: Fewer rows are not worth a block of their own.
_LEAST_ROWS = 500
_MOST_BLOCKS = 4096
#: Rows that the tree is grown from, for each block.
_SAMPLED = 40
#: Boxes that a query visits after its own before the radius is looked at again.
_NEXT = 8
_QUERIES_PER_TASK = 50_000
_PAIRS_AT_ONCE = 1_000_000

_FOUND = "qid long, distance double, tid long, label double"


class _Neighbours(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "number of neighbours", TypeConverters.toInt)
    rotation = Param(Params._dummy(), "rotation", "principal axes, row by row", TypeConverters.toListFloat)
    tree = Param(Params._dummy(), "tree", "axis, border and left child of each node", TypeConverters.toListFloat)
    data = Param(Params._dummy(), "data", "training table", TypeConverters.toString)

    def blocks_of(self):
        """A function from an array of rows to their blocks and their rotated places."""
        return _placer(self.getOrDefault(self.rotation), self.getOrDefault(self.tree))


class NearestNeighbours(_Neighbours, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", k=5):
        super().__init__()
        self._setDefault(k=5, featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        k = self.getOrDefault(self.k)
        if k < 1:
            raise ValueError("k must be a positive integer.")
        rows = dataset.select(
            vector_to_array(self.getFeaturesCol()).alias("x"),
            F.col(self.getLabelCol()).cast("double").alias("label"),
        ).filter(F.col("label").isNotNull())
        # Equal rows are at equal distance, so no query needs more than k of them; what is
        # over is dropped before the shuffle. The hash keeps the choice free of the label.
        rows = rows.withColumn("mix", F.xxhash64("label", "x"))
        rotation, count = _axes(rows)
        if count < k:
            raise ValueError(f"{count} training rows are fewer than k={k}.")
        copies = Window.partitionBy("x").orderBy("mix", "label")
        rows = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k)
        rows = freeze(rows.withColumn("tid", F.xxhash64("mix", "copy", "x")))

        cores = dataset.sparkSession.sparkContext.defaultParallelism
        wanted = max(-(-count // _block_rows(dataset.sparkSession)), min(2 * cores, count // _LEAST_ROWS))
        leaves = min(_MOST_BLOCKS, 1 << max(0, (wanted - 1).bit_length()))
        sample = rows.orderBy("tid").limit(_SAMPLED * leaves).select("x").toPandas()["x"]
        turned = np.stack(sample.to_numpy()) @ np.array(rotation).reshape(len(sample[0]), -1)
        model = NearestNeighboursModel()
        self._copyValues(model)
        model._set(rotation=rotation, tree=_grow(turned, leaves))
        place = model.blocks_of()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                blocks = place(_matrix(batch.column(1)))[0]
                yield pa.RecordBatch.from_arrays([pa.array(blocks), *batch.columns], ["block", *batch.schema.names])

        named = rows.select("tid", "x", "label").mapInArrow(run, _TABLE)
        return model._set(data=write_shared(named))


_TABLE = "block long, tid long, x array<double>, label double"


class _WithTable(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table(self.sparkSession).write.parquet(f"{path}/data")


class _ReadsTable(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model._set(data=f"{path}/data")
        return model


class NearestNeighboursModel(_Neighbours, Model, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the mean label of the k nearest training rows."""

    def write(self):
        return _WithTable(self)

    @classmethod
    def read(cls):
        return _ReadsTable(cls)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_TABLE).parquet(self.getOrDefault(self.data))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows, found, _ = self._search(dataset)
        predicted = _k_best(found, self.getOrDefault(self.k)).groupBy("qid").agg(
            F.avg("label").alias(self.getPredictionCol())
        )
        return rows.join(predicted, "qid", "left").drop("qid")

    def visited_share(self, dataset: DataFrame) -> float:
        """Of all pairs of a query and a block the share that a prediction visits."""
        rows, _, visits = self._search(dataset)
        blocks = self.table(dataset.sparkSession).select("block").distinct().count()
        return sum(v.count() for v in visits) / max(1, rows.count() * blocks)

    def _search(self, dataset: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
        """The numbered queries, their candidates, and the (query, block) pairs of every round."""
        k, spark = self.getOrDefault(self.k), dataset.sparkSession
        train = self.table(spark)
        boxes = self._boxes(train)
        rows = freeze(dataset.withColumn("qid", F.monotonically_increasing_id()))
        queries = rows.select("qid", vector_to_array(self.getFeaturesCol()).alias("x"))
        place = self.blocks_of()

        def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A leaf that holds no training row has no box: the nearest box is home then.
            for batch in batches:
                x = _matrix(batch.column(1))
                blocks, turned = place(x)
                empty = np.flatnonzero(~np.isin(blocks, boxes.names))
                if len(empty):
                    blocks[empty] = boxes.names[boxes.distances(turned[empty]).argmin(axis=1)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks)], ["qid", "x", "block"])

        visits = [freeze(queries.mapInArrow(homes, "qid long, x array<double>, block long"))]
        found = freeze(_visit(visits[0], train, k))
        seen = visits[0].select("qid", F.array("block").alias("seen"))
        for most in (_NEXT, None):
            reach = _k_best(found, k).groupBy("qid").agg(
                F.max("distance").alias("radius"), F.count(F.lit(1)).alias("held")
            )
            radius = F.when(F.col("held") >= k, F.sqrt("radius") * (1 + 1e-9)).otherwise(F.lit(float("inf")))
            asked = queries.join(reach, "qid").join(seen, "qid").select("qid", "x", radius.alias("radius"), "seen")
            listed = freeze(asked.mapInArrow(boxes.within(place, most), "qid long, x array<double>, next array<long>"))
            pairs = listed.select("qid", "x", F.explode("next").alias("block"))
            visits.append(pairs)
            found = freeze(found.unionByName(_visit(pairs, train, k)))
            seen = seen.join(listed.select("qid", "next"), "qid", "left").select(
                "qid", F.concat("seen", F.coalesce("next", F.array().cast("array<long>"))).alias("seen")
            )
        return rows, found, visits

    def _boxes(self, train: DataFrame) -> _Boxes:
        place = self.blocks_of()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                turned = place(_matrix(batch.column(1)))[1]
                blocks = batch.column(0).to_numpy()
                for block in np.unique(blocks).tolist():
                    mine = turned[blocks == block]
                    width = mine.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(width, block)), pa.array(np.arange(width)),
                         pa.array(mine.min(axis=0)), pa.array(mine.max(axis=0))],
                        ["block", "axis", "low", "high"],
                    )

        sides = train.select("block", "x").mapInArrow(run, "block long, axis long, low double, high double")
        # At most 4,096 blocks.
        found = sides.groupBy("block", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        table = found.toPandas().sort_values(["block", "axis"])
        names = table["block"].unique()
        shape = (len(names), -1)
        return _Boxes(names, table["low"].to_numpy().reshape(shape), table["high"].to_numpy().reshape(shape))


class _Boxes:
    """The blocks that hold rows, and the bounds of their rows along the rotated axes."""

    def __init__(self, names: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.names, self.low, self.high = names, low, high

    def distances(self, turned: np.ndarray) -> np.ndarray:
        """Least distance of each place to each box; rounding is left a little room."""
        total = np.zeros((len(turned), len(self.names)))
        for axis in range(turned.shape[1]):
            at = turned[:, axis, None]
            outside = np.maximum(np.maximum(self.low[:, axis] - at, at - self.high[:, axis]), 0.0)
            total += outside * outside
        return np.sqrt(total) * (1 - 1e-9)

    def within(self, place, most: int | None):
        """A function that lists the unseen boxes in reach of each query, the nearest first."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    apart = self.distances(place(_matrix(part.column(1)))[1])
                    apart[apart > part.column(2).to_numpy()[:, None]] = np.inf
                    for i, seen in enumerate(part.column(3).to_pylist()):
                        apart[i, np.isin(self.names, seen)] = np.inf
                    order = np.argsort(apart, axis=1, kind="stable")[:, :most]
                    listed = [
                        self.names[row[np.isfinite(apart[i, row])]].tolist() for i, row in enumerate(order)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(listed, pa.list_(pa.int64()))], ["qid", "x", "next"]
                    )

        return run


def _block_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.tidemark.neighbourRows", str(_BLOCK_ROWS)))


def _matrix(values: pa.Array) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 0)


def _axes(rows: DataFrame) -> tuple[list[float], int]:
    """The principal axes as columns of a matrix, row by row, and the row count, from one pass."""
    width = rows.select(F.size("x")).first()
    if width is None:
        raise ValueError("No training rows.")
    columns = [f"x{i}" for i in range(width[0])]
    spread = rows.select(*[F.col("x")[i].alias(c) for i, c in enumerate(columns)])
    total = products(spread, columns)[0]
    n = total[0, 0]
    mean = total[0, 1:] / n
    covariance = total[1:, 1:] / n - np.outer(mean, mean)
    return [float(v) for v in np.linalg.eigh(covariance)[1].ravel()], int(n)


def _grow(turned: np.ndarray, leaves: int) -> list[float]:
    """Median splits along the axis of greatest spread: axis, border, left child; a leaf has axis -1."""
    nodes: list[list[float]] = [[-1.0, 0.0, 0.0]]
    level = [(0, np.arange(len(turned)))]
    while len(level) < leaves:
        following = []
        for node, rows in level:
            part = turned[rows]
            axis = int(np.argmax(part.var(axis=0))) if len(rows) else 0
            border = float(np.median(part[:, axis])) if len(rows) else 0.0
            if len(rows) < 2 or border >= part[:, axis].max():
                continue  # equal places cannot be parted
            nodes[node] = [float(axis), border, float(len(nodes))]
            for side in (part[:, axis] <= border, part[:, axis] > border):
                following.append((len(nodes), rows[side]))
                nodes.append([-1.0, 0.0, 0.0])
        if not following:
            break
        level = following
    return [v for node in nodes for v in node]


def _placer(rotation: list[float], tree: list[float]):
    nodes = np.array(tree).reshape(-1, 3)
    axis, border, left = nodes[:, 0].astype(np.int64), nodes[:, 1], nodes[:, 2].astype(np.int64)

    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(x):
            return np.zeros(0, np.int64), x
        turned = x @ np.array(rotation).reshape(x.shape[1], -1)
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(axis[node] >= 0)
            if not len(inner):
                return node, turned
            at = node[inner]
            node[inner] = left[at] + (turned[inner, axis[at]] > border[at])

    return place


def _k_best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest candidates of each query; what a task holds is cut to k before the shuffle."""
    nearest = Window.partitionBy("qid").orderBy("distance", "tid", "label")
    return found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k).drop("place")


def _visit(queries: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of its block for every (query, block).

    A block with many queries is copied to several tasks, each with a share of them.
    """
    # At most _MOST_BLOCKS rows each, so they can be broadcast.
    load = queries.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    shares = load.select("block", F.ceil(F.col("n") / _QUERIES_PER_TASK).alias("shares"))
    sizes = train.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / _block_rows(train.sparkSession)).alias("pieces"))
    every = lambda c: F.explode(F.sequence(F.lit(0), (F.col(c) - 1).cast("int")))
    some = lambda name, c: F.pmod(F.xxhash64(name), F.col(c)).cast("int")
    left = (
        queries.join(F.broadcast(shares), "block").join(F.broadcast(sizes), "block")
        .withColumn("share", some("qid", "shares")).withColumn("piece", every("pieces"))
    )
    right = (
        train.join(F.broadcast(shares), "block").join(F.broadcast(sizes), "block")
        .withColumn("piece", some("tid", "pieces")).withColumn("share", every("shares"))
    )

    def nearest(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": [], "distance": [], "tid": [], "label": []})
        if asked.empty or known.empty:
            return empty
        parts = list(_nearest(asked, known, k))
        return pd.concat(parts) if parts else empty

    return (
        left.select("block", "share", "piece", "qid", "x")
        .groupBy("block", "share", "piece")
        .cogroup(
            right.select("block", "share", "piece", "tid", "x", "label").groupBy("block", "share", "piece")
        )
        .applyInPandas(nearest, _FOUND)
    )


def _nearest(asked: pd.DataFrame, known: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    """Candidates by a matrix product, then exact distances of the candidates."""
    there = np.stack(known["x"].to_numpy())
    centre = there.mean(axis=0)
    shifted = there - centre
    norms = (shifted**2).sum(axis=1)
    tids, labels = known["tid"].to_numpy(), known["label"].to_numpy()
    step = max(1, _PAIRS_AT_ONCE // len(known))
    for start in range(0, len(asked), step):
        part = asked.iloc[start : start + step]
        here = np.stack(part["x"].to_numpy())
        moved = here - centre
        own = (moved**2).sum(axis=1)[:, None]
        rough = own - 2 * moved @ shifted.T + norms
        if len(known) > k:
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
            slack = 1e-10 * (own + norms.max())
            i, j = np.nonzero(rough <= limit + slack)
        else:
            i, j = (a.ravel() for a in np.indices(rough.shape))
        distance = ((here[i] - there[j]) ** 2).sum(axis=1)
        order = np.lexsort((tids[j], distance, i))
        i, j, distance = i[order], j[order], distance[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        yield pd.DataFrame(
            {
                "qid": part["qid"].to_numpy()[i[keep]],
                "distance": distance[keep],
                "tid": tids[j[keep]],
                "label": labels[j[keep]],
            }
        )
