"""Regression trees of many models, folds and parameter sets, grown together from histograms.

The rows are binned once: each feature value becomes the number of its bin, and rows, label and
first training fold are kept beside it. All fits share this table. A tree needs, for each open
node, the rows and the sum of labels per (feature, bin); the best border between bins is the split.

* A table of at most ``spark.tidemark.treeCells`` (4,000,000) rows times features is broadcast, and
  tasks grow the trees: a task for each boosted model or single tree, several for a forest.
* A larger table stays where it is. Each pass over it fills the histograms of the open nodes of all
  fits at once, combined in every task, then added by a shuffle on (fit, node, feature, bin). What
  the driver gets grows with nodes, features and bins, not with rows; passes take so many nodes that
  a histogram stays within ``CELLS``.

Both ways give the same trees, but for the order in which sums are rounded. Rows are drawn by a hash
of the row and the seed, so neither partitions nor repeated tasks change a model. Equal rows draw
the same.

Boosting comes in two forms. ``start="first_tree"`` fits a first tree to the label, takes it whole,
and fits the others to twice the error; ``start="mean"`` starts at the mean of the label and shrinks
all trees, which are fitted to the error, as single-machine libraries do.
"""

from __future__ import annotations

import base64
import json
import time
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import freeze

#: Cells (rows times features) of a table that is broadcast.
TREE_CELLS = "spark.tidemark.treeCells"
#: Cells of the histograms that one pass fills.
CELLS = 2_000_000
#: Rows from which the borders of bins are taken if the table is not broadcast.
EDGE_ROWS = 20_000
#: Boosting rounds after which the predictions so far are written down.
ROUNDS = 16
MOST_BINS = 255
#: Stands for a missing value in the binned table.
MISSING = 255

KINDS = ("tree", "forest", "boosting")
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]))


@dataclass(frozen=True)
class TreeSettings:
    kind: str = "tree"
    trees: int = 1
    depth: int = 5
    learning_rate: float = 0.1
    least_rows: int = 1
    seed: int = 0
    bootstrap: bool = True
    features: str = "all"
    sample: float = 1.0
    start: str = "first_tree"


@dataclass(frozen=True)
class Fit:
    """One model to grow: on the rows that fold ``fold`` trains on, or on all rows.

    ``fills`` are the values of missing entries, ``columns`` the features that may be used.
    """

    settings: TreeSettings
    fold: int | None = None
    fills: tuple[float, ...] | None = None
    columns: tuple[int, ...] | None = None


@dataclass
class Tree:
    """Nodes in the order in which they were opened; ``left`` is -1 in a leaf, right is left + 1."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])
    depth: int = 0

    def place(self, binned: np.ndarray) -> np.ndarray:
        """The node that each row is in."""
        node = np.zeros(len(binned), np.int64)
        feature, border, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            down = left[node]
            here = rows if (down >= 0).all() else np.flatnonzero(down >= 0)
            if not len(here):
                break
            at = node[here]
            node[here] = down[here] + (binned[here, feature[at]] > border[at])
        return node

    def split(self, n: np.ndarray, s: np.ndarray, fit: Fit, number: int, floor: float) -> None:
        """Closes the open nodes, from counts and sums (node, feature, bin), and opens the next.

        A split that gains no more than ``floor``, what rounding may leave, is none.
        """
        settings = fit.settings
        count, total = n[:, 0].sum(axis=1), s[:, 0].sum(axis=1)
        mean = total / np.maximum(count, 1e-300)
        left_n, left_s = np.cumsum(n[:, :, :-1], axis=2), np.cumsum(s[:, :, :-1], axis=2)
        right_n, right_s = count[:, None, None] - left_n, total[:, None, None] - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s**2 / left_n + right_s**2 / right_n - (total * mean)[:, None, None]
        least = max(settings.least_rows, 1e-9)
        gain[(left_n < least) | (right_n < least) | np.isnan(gain)] = -np.inf
        gain[~_allowed(fit, number, self.open, n.shape[1])] = -np.inf
        flat = gain.reshape(len(self.open), -1)
        best = flat.argmax(axis=1)
        opened = []
        for i, node in enumerate(self.open):
            self.value[node] = float(mean[i])
            if self.depth >= settings.depth or not flat[i, best[i]] > floor:
                continue
            self.gain[node] = float(flat[i, best[i]])
            self.feature[node], self.bin[node] = divmod(int(best[i]), gain.shape[2])
            self.left[node] = len(self.left)
            opened += [len(self.left), len(self.left) + 1]
            for column, empty in ((self.feature, 0), (self.bin, 0), (self.left, -1), (self.value, 0.0), (self.gain, 0.0)):
                column += [empty, empty]
        self.open = opened
        self.depth += bool(opened)


def _allowed(fit: Fit, number: int, nodes: Sequence[int], width: int) -> np.ndarray:
    """Which features each node may use: a drawn part of the fit's columns."""
    columns = np.arange(width) if fit.columns is None else np.array(fit.columns)
    many = _how_many(fit.settings.features, len(columns))
    allowed = np.zeros((len(nodes), width), bool)
    if many >= len(columns):
        allowed[:, columns] = True
        return allowed
    drawn = _mix(
        _mix(np.array(nodes, np.uint64) + _key(fit.settings.seed, number))[:, None]
        + columns.astype(np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    )
    first = np.argsort(drawn, axis=1, kind="stable")[:, :many]
    allowed[np.arange(len(nodes))[:, None], columns[first]] = True
    return allowed


def _how_many(features: str, width: int) -> int:
    named = {"all": width, "auto": width, "sqrt": np.ceil(np.sqrt(width)),
             "log2": np.ceil(np.log2(max(width, 2))), "onethird": np.ceil(width / 3)}
    text = str(features).lower()
    if text in named:
        return max(1, int(named[text]))
    number = float(text)
    return int(min(width, max(1, number if "." not in text else np.ceil(number * width))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(seed: int, number: int) -> np.uint64:
    return _mix(np.array([(seed * 1_000_003 + number * 2 + 1) % 2**64], np.uint64))[0]


def draw_weights(fit: Fit, number: int, names: np.ndarray) -> np.ndarray | None:
    """How often tree ``number`` takes each row; None for once each."""
    settings = fit.settings
    bootstrap = settings.kind == "forest" and settings.bootstrap
    if not bootstrap and settings.sample >= 1:
        return None
    share = _mix(names ^ _key(settings.seed, number)) / 2.0**64
    if bootstrap:
        return np.searchsorted(_POISSON, share, side="right").astype(float)
    return (share < settings.sample).astype(float)


def bin_borders(values: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each column the borders between its bins, halfway between values that occur."""
    out = []
    for column in values.T:
        distinct, counts = np.unique(column[~np.isnan(column)], return_counts=True)
        middle = (distinct[1:] + distinct[:-1]) / 2
        if len(distinct) > bins:
            share = np.arange(1, bins) * (counts.sum() / bins)
            at = np.unique(np.searchsorted(np.cumsum(counts), share))
            middle = middle[at[at < len(middle)]]
        out.append(middle)
    return out


def to_bins(values: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(values.shape, np.uint8)
    for k, border in enumerate(borders):
        out[:, k] = np.searchsorted(border, values[:, k], side="left")
    out[np.isnan(values)] = MISSING
    return out


@dataclass
class Ensemble:
    """A fitted model: ``start`` and weighted trees; a forest averages them."""

    start: float
    weights: list[float]
    trees: list[Tree]
    seconds: float = 0.0

    def first(self, trees: int) -> Ensemble:
        """The model after so many trees."""
        return Ensemble(self.start, self.weights[:trees], self.trees[:trees], self.seconds)

    def averaged(self) -> Ensemble:
        return Ensemble(0.0, [1.0 / len(self.trees)] * len(self.trees), self.trees, self.seconds)

    def predict_binned(self, binned: np.ndarray) -> np.ndarray:
        out = np.full(len(binned), self.start)
        for weight, tree in zip(self.weights, self.trees):
            out += weight * np.array(tree.value)[tree.place(binned)]
        return out

    def importances(self, width: int) -> np.ndarray:
        """Shares of the features in the gains, each tree counted alike."""
        total = np.zeros(width)
        for tree in self.trees:
            own = np.zeros(width)
            np.add.at(own, tree.feature, tree.gain)
            if own.sum() > 0:
                total += own / own.sum()
        return total / total.sum() if total.sum() > 0 else total


class BinnedTable:
    """Rows of features, label and first training fold, ready for any number of fits.

    ``values`` is an array column, in which null and NaN are missing; ``train_from`` is the first
    fold that trains on a row. Rows without a label are left out.
    """

    def __init__(
        self, df: DataFrame, values: Column, label: str, train_from: Column | None = None, bins: int = 32
    ):
        if not 2 <= bins <= MOST_BINS:
            raise ValueError(f"max_bins must lie between 2 and {MOST_BINS}, not {bins}.")
        spark = df.sparkSession
        rows = df.select(
            values.alias("x"), F.col(f"`{label}`").cast("double").alias("y"),
            (F.lit(0) if train_from is None else train_from).cast("int").alias("fold"),
        ).filter("y is not null")
        self.spark, self.bins = spark, bins
        # Only numbers that both agree on name a row, so that equal rows draw the same.
        self.raw = freeze(rows.withColumn("name", F.xxhash64("x", "y")))
        head = self.raw.agg(F.count(F.lit(1)), F.max(F.size("x")), F.avg("y")).first()
        self.rows, self.width = head[0], head[1] or 0
        if not self.rows or not self.width:
            raise ValueError("There are no rows, or no features, to grow trees on.")
        self.centre = float(head[2])
        self.local = self.rows * self.width <= int(spark.conf.get(TREE_CELLS, "4000000"))
        if self.local:
            x, y, fold, name = _columns(self.raw.toArrow(), self.width)
            self.borders = bin_borders(x, bins)
            self.arrays = (to_bins(x, self.borders), y - self.centre, fold, name)
        else:
            sample = self.raw.orderBy("name").limit(EDGE_ROWS).select("x", "y", "fold", "name")
            self.borders = bin_borders(_columns(sample.toArrow(), self.width)[0], bins)
            self.binned = freeze(self._bin())

    def _bin(self) -> DataFrame:
        width, borders, centre = self.width, self.borders, self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y, fold, name = _columns(batch, width)
                raw = [r.tobytes() for r in to_bins(x, borders)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(raw, pa.binary()), pa.array(y - centre), pa.array(fold), pa.array(name.view(np.int64))],
                    ["x", "y", "fold", "name"],
                )

        return self.raw.select("x", "y", "fold", "name").mapInArrow(
            run, "x binary, y double, fold int, name long"
        )

    def fill_bins(self, fit: Fit) -> np.ndarray:
        """The bin that a missing value of each feature counts as; without fills the last one."""
        if fit.fills is None:
            return np.array([len(b) for b in self.borders], np.uint8)
        return np.array(
            [np.searchsorted(b, v, side="left") for b, v in zip(self.borders, fit.fills)], np.uint8
        )

    def threshold(self, tree: Tree) -> list[float]:
        """The greatest value that goes left, for each node."""
        return [
            float(self.borders[f][b]) if l >= 0 else 0.0
            for f, b, l in zip(tree.feature, tree.bin, tree.left)
        ]

    def fit(self, fits: Sequence[Fit]) -> list[Ensemble]:
        """One ensemble for each fit."""
        for fit in fits:
            if fit.settings.kind not in KINDS:
                raise ValueError(f"Unknown kind {fit.settings.kind!r}. Options: {list(KINDS)}")
        grown = _grow_in_tasks(self, fits) if self.local else _grow_over_rows(self, fits)
        for ensemble, fit in zip(grown, fits):
            ensemble.start += self.centre if fit.settings.kind == "boosting" else 0.0
            if fit.settings.kind != "boosting":
                for tree in ensemble.trees:
                    tree.value = [v + self.centre for v in tree.value]
        return [
            e if f.settings.kind == "boosting" else e.averaged() for e, f in zip(grown, fits)
        ]


def _columns(table, width: int) -> tuple[np.ndarray, ...]:
    """x (rows, width) with NaN for missing, y, fold, name, of Arrow rows in this order."""
    x = table.column("x")
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    if isinstance(x, pa.ChunkedArray):
        x = pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], pa.list_(pa.float64()))
    values = x.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    rest = [table.column(c).to_numpy() if isinstance(table, pa.Table) else table.column(c).to_numpy(zero_copy_only=False)
            for c in ("y", "fold", "name")]
    return values.reshape(-1, width), rest[0].astype(float), rest[1], rest[2].astype(np.int64).view(np.uint64)


# Boosting, one round after the other; trees of a forest are numbered alike.


def _target(fit: Fit, round_: int, y: np.ndarray, so_far: np.ndarray) -> np.ndarray:
    if fit.settings.start == "first_tree":
        return y if round_ == 0 else 2 * (y - so_far)
    return y - so_far


def _weight(fit: Fit, round_: int) -> float:
    first = fit.settings.start == "first_tree" and round_ == 0
    return 1.0 if first else fit.settings.learning_rate


def _floor(target_squares: float) -> float:
    return 1e-12 * target_squares


# The table in every task


class _Grower:
    """Grows trees on rows that are all at hand."""

    def __init__(self, binned: np.ndarray, y: np.ndarray, names: np.ndarray, bins: int):
        self.binned, self.y, self.names, self.bins = binned, y, names, bins
        self.width = binned.shape[1]
        self.cells = binned.astype(np.intp) + np.arange(self.width) * bins

    def tree(self, fit: Fit, number: int, target: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The tree, and the node that each row ends in."""
        tree = Tree()
        weights = draw_weights(fit, number, self.names)
        rows = np.arange(len(target)) if weights is None else np.flatnonzero(weights)
        node = np.zeros(len(target), np.int64)
        w = None if weights is None else weights[rows]
        t = target[rows] if w is None else target[rows] * w
        floor = _floor(float((target[rows] * t).sum()))
        while tree.open:
            n, s = self._histograms(tree, rows, node, w, t)
            depth = tree.depth
            tree.split(n, s, fit, number, floor)
            if tree.depth == depth:
                break
            feature, border = np.array(tree.feature), np.array(tree.bin)
            left = np.array(tree.left)
            here = left[node[rows]] >= 0
            if not here.all():
                rows, t = rows[here], t[here]
                w = None if w is None else w[here]
            at = node[rows]
            node[rows] = left[at] + (self.binned[rows, feature[at]] > border[at])
        return tree, tree.place(self.binned) if weights is not None else node

    def _histograms(self, tree: Tree, rows, node, w, t) -> tuple[np.ndarray, np.ndarray]:
        block = self.width * self.bins
        if len(tree.open) == 1:
            cells, many = self.cells[rows], 1
        else:
            first = tree.open[0]  # open nodes are numbered without a gap
            cells, many = self.cells[rows] + ((node[rows] - first) * block)[:, None], len(tree.open)
        cells = cells.ravel()
        n = np.bincount(cells, None if w is None else np.repeat(w, self.width), many * block)
        s = np.bincount(cells, np.repeat(t, self.width), many * block)
        shape = (many, self.width, self.bins)
        return n.reshape(shape).astype(float), s.reshape(shape)

    def ensemble(self, fit: Fit, numbers: range) -> Ensemble:
        if fit.settings.kind != "boosting":
            return Ensemble(0.0, [], [self.tree(fit, k, self.y)[0] for k in numbers])
        start = 0.0 if fit.settings.start == "first_tree" else float(self.y.mean())
        so_far, out = np.full(len(self.y), start), Ensemble(start, [], [])
        for k in numbers:
            tree, node = self.tree(fit, k, _target(fit, k, self.y, so_far))
            out.weights.append(_weight(fit, k))
            out.trees.append(tree)
            so_far += out.weights[-1] * np.array(tree.value)[node]
        return out


def _grow_in_tasks(table: BinnedTable, fits: Sequence[Fit]) -> list[Ensemble]:
    spark = table.spark
    cores = spark.sparkContext.defaultParallelism
    tasks: list[tuple[int, range]] = []
    for i, fit in enumerate(fits):
        trees = fit.settings.trees if fit.settings.kind != "tree" else 1
        share = trees if fit.settings.kind != "forest" else max(1, -(-trees * len(fits) // (2 * cores)))
        tasks += [(i, range(a, min(trees, a + share))) for a in range(0, trees, share)]
    fill_bins = [table.fill_bins(fit) for fit in fits]
    shared = spark.sparkContext.broadcast(table.arrays)
    bins = table.bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                start = time.time()
                at, numbers = tasks[task]
                fit = fits[at]
                binned, y, folds, names = shared.value
                if fit.fold is not None:
                    here = folds <= fit.fold
                    binned, y, names = binned[here], y[here], names[here]
                binned = _filled(binned, fill_bins[at])
                if not len(y):
                    raise ValueError("A fold has no training rows.")
                grown = _Grower(binned, y, names, bins).ensemble(fit, numbers)
                grown.seconds = time.time() - start
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task]), pa.array([pack_ensemble(grown)])], ["task", "model"]
                )

    jobs = spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, "task long, model string")
    found = {r.task: unpack_ensemble(r.model) for r in jobs.collect()}
    shared.unpersist()
    out: list[Ensemble | None] = [None] * len(fits)
    for task, (at, _) in enumerate(tasks):
        part = found[task]
        if out[at] is None:
            out[at] = part
        else:
            out[at].trees += part.trees
            out[at].weights += part.weights
            out[at].seconds += part.seconds
    return out


def _filled(binned: np.ndarray, fill: np.ndarray) -> np.ndarray:
    missing = binned == MISSING
    return np.where(missing, fill[None, :], binned) if missing.any() else binned


# The table where it is, one pass for all fits


@dataclass
class _Open:
    """A tree that grows: tree ``number`` of fit ``fit``."""

    fit: int
    number: int
    tree: Tree
    floor: float = 0.0


def _grow_over_rows(table: BinnedTable, fits: Sequence[Fit]) -> list[Ensemble]:
    out = [Ensemble(0.0, [], []) for _ in fits]
    alone = [i for i, f in enumerate(fits) if f.settings.kind != "boosting"]
    trees = [
        _Open(i, k, Tree())
        for i in alone
        for k in range(fits[i].settings.trees if fits[i].settings.kind == "forest" else 1)
    ]
    _grow(table, table.binned, fits, trees, out)
    for growing in trees:
        out[growing.fit].trees.append(growing.tree)

    boosted = [i for i, f in enumerate(fits) if f.settings.kind == "boosting"]
    if not boosted:
        return out
    for i, mean in _fold_means(table, fits, boosted).items():
        if fits[i].settings.start == "mean":
            out[i].start = mean
    rows, written = table.binned, {i: 0 for i in boosted}
    for k in range(max(fits[i].settings.trees for i in boosted)):
        trees = [_Open(i, k, Tree()) for i in boosted if k < fits[i].settings.trees]
        _grow(table, rows, fits, trees, out, written)
        for growing in trees:
            out[growing.fit].trees.append(growing.tree)
            out[growing.fit].weights.append(_weight(fits[growing.fit], k))
        if k % ROUNDS == ROUNDS - 1:
            rows = freeze(_with_predictions(table, rows, fits, out, written))
            written = {i: len(out[i].trees) for i in boosted}
    return out


def _fold_means(table: BinnedTable, fits: Sequence[Fit], wanted: list[int]) -> dict[int, float]:
    """The mean label of the rows that a fit trains on."""
    parts = table.binned.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()
    means = {}
    for i in wanted:
        inside = [r for r in parts if fits[i].fold is None or r.fold <= fits[i].fold]
        if not inside:
            raise ValueError("A fold has no training rows.")
        means[i] = sum(r.s for r in inside) / sum(r.n for r in inside)
    return means


def _batch_rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    raw = b"".join(batch.column(0).to_pylist())
    binned = np.frombuffer(raw, np.uint8).reshape(-1, width)
    y, fold = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    return binned, y, fold, batch.column(3).to_numpy().view(np.uint64)


def _so_far(
    fit: int, ensemble: Ensemble, written: int, base: np.ndarray | None, order: dict[int, int],
    binned: np.ndarray,
) -> np.ndarray:
    """Predictions of a boosted model: what was written down and the trees since."""
    rest = Ensemble(ensemble.start if not written else 0.0, ensemble.weights[written:], ensemble.trees[written:])
    found = rest.predict_binned(binned)
    return found if not written else found + base[:, order[fit]]


def _bases(batch: pa.RecordBatch, many: int) -> np.ndarray | None:
    if batch.num_columns < 5:
        return None
    return np.frombuffer(b"".join(batch.column(4).to_pylist()), "<f8").reshape(-1, many)


def _with_predictions(
    table: BinnedTable, rows: DataFrame, fits: Sequence[Fit], out: list[Ensemble], written: dict[int, int]
) -> DataFrame:
    """The rows with the predictions of all boosted models up to now."""
    width, order = table.width, {i: k for k, i in enumerate(written)}
    fills = {i: table.fill_bins(fits[i]) for i in written}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = _batch_rows(batch, width)[0]
            base = _bases(batch, len(order))
            found = np.stack(
                [_so_far(i, out[i], written[i], base, order, _filled(binned, fills[i])) for i in order], axis=1
            ).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([r.tobytes() for r in found], pa.binary())],
                ["x", "y", "fold", "name", "base"],
            )

    return rows.mapInArrow(run, "x binary, y double, fold int, name long, base binary")


def _grow(
    table: BinnedTable, rows: DataFrame, fits: Sequence[Fit], trees: list[_Open],
    out: list[Ensemble], written: dict[int, int] | None = None,
) -> None:
    """Grows all the trees to their full depth; a pass takes a level, or part of a wide one."""
    block = table.width * table.bins
    most = max(1, CELLS // block)
    while True:
        growing = [t for t in trees if t.tree.open]
        if not growing:
            return
        level = [(t, i) for t in growing for i in range(len(t.tree.open))]
        found: dict[int, list] = {}
        for a in range(0, len(level), most):
            part = level[a : a + most]
            n, s, squares = _histograms(table, rows, fits, part, out, written)
            for k, (t, _) in enumerate(part):
                found.setdefault(id(t), []).append((n[k], s[k], squares[k]))
        for t in growing:
            pieces = found[id(t)]
            if not t.tree.depth:
                t.floor = _floor(pieces[0][2])
            n, s = np.stack([p[0] for p in pieces]), np.stack([p[1] for p in pieces])
            t.tree.split(n, s, fits[t.fit], t.number, t.floor)


def _histograms(
    table: BinnedTable, rows: DataFrame, fits: Sequence[Fit], nodes: list[tuple[_Open, int]],
    out: list[Ensemble], written: dict[int, int] | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums (node, feature, bin) and squares (node) of what lies in the given open nodes."""
    width, bins = table.width, table.bins
    block = width * bins
    # For each tree the first and last of its nodes in this pass, and where its cells begin.
    spans: dict[int, list] = {}
    for k, (t, i) in enumerate(nodes):
        node = t.tree.open[i]
        if id(t) in spans:
            spans[id(t)][2] = node
        else:
            spans[id(t)] = [t, node, node, k]
    work = [(t.fit, t.number, t.tree, low, high, k) for t, low, high, k in spans.values()]
    fills = {t: table.fill_bins(fits[t]) for t in {w[0] for w in work}}
    order = {i: k for k, i in enumerate(written or {})}
    many = len(nodes) * block
    boosted = {i: out[i] for i in order}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, squares = np.zeros(many), np.zeros(many), np.zeros(len(nodes))
        for batch in batches:
            binned, y, folds, names = _batch_rows(batch, width)
            base = _bases(batch, max(1, len(order)))
            seen: dict[int, tuple] = {}
            for at, number, tree, low, high, first in work:
                fit = fits[at]
                if at not in seen:
                    here = slice(None) if fit.fold is None else folds <= fit.fold
                    own, labels = _filled(binned[here], fills[at]), y[here]
                    if at in boosted:
                        part = None if base is None else base[here]
                        past = _so_far(at, boosted[at], written[at], part, order, own)
                        labels = _target(fit, number, labels, past)
                    seen[at] = (own, labels, names[here])
                own, labels, drawn = seen[at]
                weights = draw_weights(fit, number, drawn)
                node = tree.place(own)
                inside = (node >= low) & (node <= high)
                if weights is not None:
                    inside &= weights > 0
                inside = np.flatnonzero(inside)
                if not len(inside):
                    continue
                w = None if weights is None else weights[inside]
                t = labels[inside] if w is None else labels[inside] * w
                local = node[inside] - low
                cells = own[inside].astype(np.intp) + np.arange(width) * bins + (local * block)[:, None]
                size = (high - low + 1) * block
                span = slice(first * block, first * block + size)
                n[span] += np.bincount(cells.ravel(), None if w is None else np.repeat(w, width), size)
                s[span] += np.bincount(cells.ravel(), np.repeat(t, width), size)
                squares[first : first + high - low + 1] += np.bincount(local, t * labels[inside], high - low + 1)
        full = np.flatnonzero(n)
        for a in range(0, len(full), 100_000):
            cells = full[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(n[cells]), pa.array(s[cells])], ["cell", "n", "s"]
            )
        held = np.flatnonzero(squares)
        yield pa.RecordBatch.from_arrays(
            [pa.array(-1 - held), pa.array(squares[held]), pa.array(squares[held])], ["cell", "n", "s"]
        )

    partial = rows.mapInArrow(run, "cell long, n double, s double")
    summed = partial.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    cell, count, total = (summed.column(c).to_numpy() for c in ("cell", "n", "s"))
    n, s, squares = np.zeros(many), np.zeros(many), np.zeros(len(nodes))
    inner = cell >= 0
    n[cell[inner]], s[cell[inner]] = count[inner], total[inner]
    squares[-1 - cell[~inner]] = count[~inner]
    shape = (len(nodes), width, bins)
    return n.reshape(shape), s.reshape(shape), squares


# Models as text


def _pack(values, kind: str) -> str:
    return base64.b64encode(zlib.compress(np.array(values, kind).tobytes(), 1)).decode()


def _unpack(text: str, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(base64.b64decode(text)), kind)


def pack_ensemble(model: Ensemble) -> str:
    """All trees one after the other in a few arrays."""
    trees = model.trees
    together = lambda name: [v for t in trees for v in getattr(t, name)]
    return json.dumps(
        {
            "start": model.start, "seconds": model.seconds,
            "weights": _pack(model.weights, "<f8"), "sizes": _pack([len(t.left) for t in trees], "<i4"),
            "depths": _pack([t.depth for t in trees], "<i4"),
            "feature": _pack(together("feature"), "<i4"), "bin": _pack(together("bin"), "<i4"),
            "left": _pack(together("left"), "<i4"), "value": _pack(together("value"), "<f8"),
            "gain": _pack(together("gain"), "<f8"),
        }
    )


def unpack_ensemble(text: str) -> Ensemble:
    held = json.loads(text)
    columns = {
        n: _unpack(held[n], "<f8" if n in ("value", "gain") else "<i4").tolist()
        for n in ("feature", "bin", "left", "value", "gain")
    }
    trees, at = [], 0
    for size, depth in zip(_unpack(held["sizes"], "<i4").tolist(), _unpack(held["depths"], "<i4").tolist()):
        trees.append(Tree(**{n: c[at : at + size] for n, c in columns.items()}, open=[], depth=depth))
        at += size
    return Ensemble(held["start"], _unpack(held["weights"], "<f8").tolist(), trees, held["seconds"])


class Scorer:
    """Predictions of an ensemble for rows of features, with the borders as thresholds."""

    def __init__(self, ensemble: Ensemble, thresholds: Sequence[Sequence[float]]):
        self.start = ensemble.start
        self.trees = [
            (w, t.depth, np.array(t.feature), np.array(h), np.array(t.left), np.array(t.value))
            for w, t, h in zip(ensemble.weights, ensemble.trees, thresholds)
        ]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, flat, base = np.full(len(x), self.start), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        for weight, depth, feature, threshold, left, value in self.trees:
            node = np.zeros(len(x), np.intp)
            for _ in range(depth):
                down = left[node]
                # Missing values compare as greater, as in the binned table.
                step = down + ~(flat[base + feature[node]] <= threshold[node])
                node = np.where(down >= 0, step, node)
            out += weight * value[node]
        return out


class BinnedTrees(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """A tree, forest or boosted model; ``settings`` are those of ``TreeSettings``."""

    settings = Param(Params._dummy(), "settings", "settings of the trees")
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", settings=None, maxBins=32):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxBins=32, settings={})
        self._set(featuresCol=featuresCol, labelCol=labelCol, settings=settings or {}, maxBins=maxBins)

    def tree_settings(self) -> TreeSettings:
        return TreeSettings(**self.getOrDefault(self.settings))

    def getMaxDepth(self) -> int:
        return self.tree_settings().depth

    def _fit(self, dataset: DataFrame) -> BinnedTreesModel:
        values = vector_to_array(F.col(self.getFeaturesCol()))
        table = BinnedTable(dataset, values, self.getLabelCol(), bins=self.getOrDefault(self.maxBins))
        (ensemble,) = table.fit([Fit(self.tree_settings())])
        model = BinnedTreesModel.of(ensemble, table)
        return model._set(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
            settings=asdict(self.tree_settings()),
        )


class BinnedTreesModel(
    Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    settings = Param(Params._dummy(), "settings", "settings of the trees")
    trees = Param(Params._dummy(), "trees", "the trees as text", TypeConverters.toString)
    thresholds = Param(Params._dummy(), "thresholds", "border of each node as text", TypeConverters.toString)
    numFeatures = Param(Params._dummy(), "numFeatures", "features", TypeConverters.toInt)

    @staticmethod
    def of(ensemble: Ensemble, table: BinnedTable) -> BinnedTreesModel:
        every = [v for t in ensemble.trees for v in table.threshold(t)]
        return BinnedTreesModel()._set(
            trees=pack_ensemble(ensemble), thresholds=_pack(every, "<f8"), numFeatures=table.width
        )

    @property
    def ensemble(self) -> Ensemble:
        return unpack_ensemble(self.getOrDefault(self.trees))

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.ensemble.importances(self.getOrDefault(self.numFeatures)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text, borders = self.getOrDefault(self.trees), self.getOrDefault(self.thresholds)
        width = self.getOrDefault(self.numFeatures)

        @F.arrow_udf("double")
        def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            scorer = scorer_of(text, borders)
            for values in batches:
                x = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                yield pa.array(scorer(x))

        values = vector_to_array(F.col(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), predict(values))


def scorer_of(trees: str, thresholds: str) -> Scorer:
    ensemble, every = unpack_ensemble(trees), _unpack(thresholds, "<f8")
    ends = np.cumsum([0, *[len(t.left) for t in ensemble.trees]])
    return Scorer(ensemble, [every[a:b] for a, b in zip(ends, ends[1:])])
