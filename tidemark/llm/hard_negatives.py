"""Hard negatives: exact scores from Strassen products of tiles, kept in mergeable heaps.

Rows are cut into tiles of 1,024 vectors of one length, sorted by label, and the anchors among them
into blocks of the same kind. A block meets a tile in one task, which multiplies the two integer
matrices by Strassen's recursion: seven products of halves instead of eight, with zero rows or
columns added where a side is odd, down to small parts that are multiplied plainly. All additions are
exact, in 64-bit integers (where products of intermediate sums wrap, they wrap back) or, if a score
itself could need more bits, in Python's integers.

Two rounds. The first takes only pairs of a block and a tile with a label in common: a heap per
anchor keeps the best rows of its own label, the positives. The second takes the others: a heap per
positive keeps the best rows of other labels inside the window of scores that the positive sets. A
heap holds a few rows at most, a task keeps one per anchor or positive over all its tiles, and heaps
of several tasks are merged by sorting what they hold, so neither tasks nor shuffles see all scores.
A block of one label skips tiles that hold nothing but that label in the second round.

Cases: rows with a null id, label or vector, or with a null or non-finite component, take no part;
rows equal in id, label and vector count once, rows that share only an id are different rows and
answer apart; vectors are compared with those of their own length only; ties go to the smaller id,
then to the label and the vector's name; an anchor without another row of its label, or a positive
without a row in its window, gives no rows; scores beyond 64 bits are cut to the nearest such
number; other columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.top_k import _long as long
from tidemark.llm.top_k import _short as short
from tidemark.session import freeze

#: Vectors in a tile and anchors in a block.
TILE, BLOCK = 1024, 1024
#: Tiles and blocks whose products one task makes, one after the other.
STRIP, BAND = 16, 4
#: Sides up to which parts are multiplied plainly.
PLAIN = 64
#: Percent of the positive's score between which a hard negative's score lies.
LOW, HIGH = 50, 95


def strassen(a: np.ndarray, b: np.ndarray, plain: int = PLAIN) -> np.ndarray:
    """The product of two integer matrices, exact for the numbers of their type."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= plain:
        return _plain_product(a, b)
    a, b = _even(a), _even(b)
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, plain)
    p2 = strassen(a21 + a22, b11, plain)
    p3 = strassen(a11, b12 - b22, plain)
    p4 = strassen(a22, b21 - b11, plain)
    p5 = strassen(a11 + a12, b22, plain)
    p6 = strassen(a21 - a11, b11 + b12, plain)
    p7 = strassen(a12 - a22, b21 + b22, plain)
    out = np.empty((2 * r, 2 * t), a.dtype)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _even(x: np.ndarray) -> np.ndarray:
    """With a row and a column of zeros where a side is odd."""
    n, m = x.shape
    if n % 2 == 0 and m % 2 == 0:
        return x
    out = np.full((n + n % 2, m + m % 2), 0, x.dtype)
    out[:n, :m] = x
    return out


def _plain_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Doubles multiply faster and are exact while no sum can pass 2**53."""
    if a.dtype == np.int64 and a.size and b.size:
        most = _most(a) * _most(b) * a.shape[1]
        if most < 2**53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _most(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def scores(a: np.ndarray, b: np.ndarray, plain: int = PLAIN) -> np.ndarray:
    """Inner products of the rows of two int64 matrices, cut to 64 bits."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if _most(a) * _most(b) * a.shape[1] < 2**63:
        return strassen(a, np.ascontiguousarray(b.T), plain)
    wide = strassen(a.astype(object), b.T.astype(object), plain)
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


class Heaps:
    """For each of some keys the best few entries (-score, id, label, h1, h2), the least ones."""

    def __init__(self, many: int, size: int):
        self.size = size
        self.held: list[list[tuple]] = [[] for _ in range(many)]

    def floor(self, key: int) -> int | None:
        """The score below which nothing enters any more."""
        held = self.held[key]
        return -held[-1][0] if len(held) == self.size else None

    def merge(self, key: int, entries: list[tuple]) -> None:
        self.held[key] = heapq.nsmallest(self.size, self.held[key] + entries)


def mining_rows(vectors: DataFrame, vec_id: str, label: str, vector: str, scale: float) -> DataFrame:
    """vec_id, label, v, h1, h2, length: rows that take part, each once."""
    number, group, x = F.col(f"`{vec_id}`"), F.col(f"`{label}`"), F.col(f"`{vector}`")
    finite = F.forall(
        x,
        lambda c: c.isNotNull()
        & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) != float("inf")),
    )
    whole = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    rows = vectors.filter(number.isNotNull() & group.isNotNull() & x.isNotNull() & finite).select(
        number.cast("long").alias("vec_id"), group.cast("long").alias("label"), whole.alias("v")
    )
    names = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    return rows.select("*", *names, F.size("v").alias("length")).distinct()


_ROW = ("vec_id", "label", "h1", "h2")
_ORDER = ("length", "label", "vec_id", "h1", "h2")


def tiles(rows: DataFrame, size: int, windows: int = 0) -> DataFrame:
    """One row per tile: rows of one length, sorted by label and id, cut after ``size`` rows.

    ``low`` and ``high`` are its least and greatest label.
    With ``windows`` the rows have an array ``bounds`` of so many (low, high) pairs of scores.
    """
    names = ["tile", "length", "low", "high", "n", "rows", "vectors", "bounds"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(),
             pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            length = held[0][0]
            x = np.array([h[5] for h in held], np.int64).reshape(len(held), length)
            bounds = np.array([h[6] for h in held], "<i8") if windows else np.zeros(0, "<i8")
            row = [
                base + count, length, held[0][1], held[-1][1],
                len(held),
                np.array([h[1:5] for h in held], "<i8").tobytes(), short(x), bounds.tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if held and (row[0] != held[0][0] or len(held) == size):
                    yield flush()
                    held, count = [], count + 1
                held.append(row)
        if held:
            yield flush()

    ordered = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    chosen = ordered.select("length", "label", "vec_id", "h1", "h2", "v", *(["bounds"] if windows else []))
    return chosen.mapInArrow(
        run,
        "tile long, length int, low long, high long, n int, rows binary, "
        "vectors binary, bounds binary",
    )


def _groups(some: DataFrame, size: int) -> int:
    """How many groups of about ``size`` vectors the tiles make."""
    total = some.agg(F.sum("n")).first()[0] or 0
    return max(1, -(-total // size))


Visit = Callable[[Heaps, np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]


def visits(
    blocks: DataFrame, index: DataFrame, meet: Column, slots: int, size: int, visit: Visit, plain: int
) -> DataFrame:
    """What the heaps of all tasks hold: the anchor's row, slot, score and the found row.

    Blocks (their columns begin with ``a_``) meet tiles of their own length for which ``meet``
    holds. ``visit`` gets the heaps, which have ``slots`` keys an anchor, the scores, the rows of
    block and tile (label, id and name) and the block's bounds.
    """
    # A task gets a cell: some tiles, picked by hash, and some blocks. Each tile goes to as many
    # tasks as there are bands of blocks, each block to as many as there are strips of tiles.
    strips, bands = _groups(index, STRIP * TILE), _groups(blocks, BAND * BLOCK)
    left = blocks.select(
        *[F.col(c).alias(f"a_{c}") for c in blocks.columns],
        F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"),
        F.pmod(F.xxhash64("tile"), F.lit(bands)).cast("int").alias("band"),
    )
    right = index.select(
        "tile", "length", "low", "high", "rows", "vectors",
        F.pmod(F.xxhash64("tile"), F.lit(strips)).cast("int").alias("strip"),
        F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"),
    )
    # Merged, not broadcast: then all of a cell is in one task, and its heaps are merged there.
    cells = left.hint("merge").join(right, ["strip", "band"])
    rows = (
        cells.filter((F.col("a_length") == F.col("length")) & meet)
        .select("a_length", "a_tile", "a_rows", "a_vectors", "a_bounds", "rows", "vectors")
        .sortWithinPartitions("a_tile")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heaps, asking, vectors, bounds = None, None, None, None, None

        def answers() -> pa.RecordBatch:
            found = [
                (*asking[key // slots].tolist(), key % slots, -entry[0], *entry[1:])
                for key, entries in enumerate(heaps.held)
                for entry in entries
            ]
            columns = zip(*found) if found else [()] * 10
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FOUND)

        for batch in batches:
            for i in range(batch.num_rows):
                length, block, a_rows, a_vectors, a_bounds, b_rows, b_vectors = (
                    batch.column(k)[i].as_py() for k in range(7)
                )
                if block != at:
                    if at is not None:
                        yield answers()
                    asking = np.frombuffer(a_rows, "<i8").reshape(-1, 4)
                    vectors = long(a_vectors, len(asking), length)
                    bounds = np.frombuffer(a_bounds, "<i8").reshape(len(asking), -1, 2)
                    at, heaps = block, Heaps(slots * len(asking), size)
                there = np.frombuffer(b_rows, "<i8").reshape(-1, 4)
                products = scores(vectors, long(b_vectors, len(there), length), plain)
                visit(heaps, products, asking, there, bounds)
        if at is not None:
            yield answers()

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in FOUND))


#: Rows in a tile are (label, vec_id, h1, h2).
FOUND = [
    "a_label", "a_vec_id", "a_h1", "a_h2", "slot", "score", "vec_id", "label", "h1", "h2",
]


def _entries(products: np.ndarray, there: np.ndarray, at: np.ndarray) -> list[tuple]:
    picked = there[at].tolist()
    return [(-s, i, l, h1, h2) for s, (l, i, h1, h2) in zip(products[at].tolist(), picked)]


def _best(products: np.ndarray, there: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Of the places ``at`` the ``size`` of highest score, ties by id, label and name."""
    if len(at) > size:
        bound = np.partition(products[at], len(at) - size)[len(at) - size]
        at = at[products[at] >= bound]
    keys = there[at]
    return at[np.lexsort((keys[:, 3], keys[:, 2], keys[:, 0], keys[:, 1], -products[at]))][:size]


def visit_positives(heaps: Heaps, products, asking, there, bounds) -> None:
    """The best rows of each anchor's label, but for the anchor itself."""
    for a, own in enumerate(asking):
        good = there[:, 0] == own[0]
        floor = heaps.floor(a)
        if floor is not None:
            good &= products[a] >= floor
        good &= ~(there == own).all(axis=1)
        at = np.flatnonzero(good)
        if len(at):
            heaps.merge(a, _entries(products[a], there, _best(products[a], there, at, heaps.size)))


def visit_windows(heaps: Heaps, products, asking, there, bounds) -> None:
    """The best rows of other labels inside the window of each positive of each anchor."""
    slots = bounds.shape[1]
    for a, own in enumerate(asking):
        row = products[a]
        inside = (there[:, 0] != own[0]) & (row >= bounds[a, :, 0].min()) & (row <= bounds[a, :, 1].max())
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        mine = row[at]
        for slot in range(slots):
            low, high = bounds[a, slot].tolist()
            floor = heaps.floor(a * slots + slot)
            if floor is not None:
                low = max(low, floor)
            good = at[(mine >= low) & (mine <= high)]
            if len(good):
                heaps.merge(
                    a * slots + slot, _entries(row, there, _best(row, there, good, heaps.size))
                )


def _merged(found: DataFrame, keys: list[str], size: int, rank: str) -> DataFrame:
    """The heaps of all tasks merged: the best ``size`` rows of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "label", "h1", "h2")
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= size)


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
    low: int = LOW, high: int = HIGH, scale: float = 256.0,
    vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", tile: int = TILE,
    block: int = BLOCK, plain: int = PLAIN,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. A negative's score lies between ``low``
    and ``high`` percent of the positive's.
    """
    rows = freeze(mining_rows(vectors, vec_id, label, vector, scale))
    index = freeze(tiles(rows, tile))
    anchors = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = freeze(tiles(anchors, block))
    asks = ["a_label", "a_vec_id", "a_h1", "a_h2"]

    shared = (F.col("a_low") <= F.col("high")) & (F.col("low") <= F.col("a_high"))
    near = visits(blocks, index, shared, 1, positives, visit_positives, plain)
    chosen = freeze(_merged(near, asks, positives, "place"))

    # Percentages are taken in decimals, which hold a hundred times a 64-bit number.
    score = F.col("score").cast("decimal(20,0)")
    lowest, highest = F.ceil(score * low / 100), F.floor(score * high / 100)
    windows = chosen.select(
        *asks, "place", lowest.cast("long").alias("least"), highest.cast("long").alias("most")
    )
    # A heap per place; places that an anchor lacks have a window that holds nothing.
    listed = windows.groupBy(*asks).agg(
        F.map_from_entries(F.collect_list(F.struct("place", F.array("least", "most")))).alias("by")
    )
    none = F.array(F.lit(2**63 - 1), F.lit(-(2**63)))
    bounds = F.array(*[F.coalesce(F.try_element_at("by", F.lit(k + 1)), none) for k in range(positives)])
    joined = anchors.join(
        listed.select(*[F.col(f"a_{c}").alias(c) for c in _ROW], F.flatten(bounds).alias("bounds")),
        list(_ROW),
    )
    asking = freeze(tiles(joined, block, positives))

    other = (F.col("a_low") != F.col("a_high")) | (F.col("low") != F.col("high")) | (
        F.col("low") != F.col("a_low")
    )
    far = visits(asking, index, other, positives, negatives, visit_windows, plain)
    best = _merged(far, [*asks, "slot"], negatives, "rank")
    named = chosen.select(
        *asks, (F.col("place") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return best.join(named, [*asks, "slot"]).select(
        F.col("a_vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
