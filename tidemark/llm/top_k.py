"""Exact top-k inner products with a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it. Sorted by that key they are cut
into annuli of at most 512 vectors, one row each, which know the least and greatest distance and the
greatest norm. For a query q and a vector x in an annulus of pivot p the triangle inequality gives
|q - x| >= gap, where gap is how far d(q, p) lies outside the annulus, and so

    q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 <= (|q|^2 + max|x|^2 - gap^2) / 2.

Queries travel in blocks of 256 that lie near each other. A block first visits the annuli around
its own distance to its own pivots; that gives each query a k-th score. Then it expands to all other
annuli whose bound reaches the least of those scores, and each query in a visit is tested again by
its own bound. What no bound reaches is never read. With data that have no structure the bounds
exclude little and the work is that of all blocks against all annuli, done by matrix products.

Pivots are picked from a bounded sample (2,048 vectors, at most 256 pivots, found by hash); they
decide the speed only. Every vector is indexed. Equal vectors are one entry that carries the k + 1
smallest ids, as no query can need more.

Cases: null vectors, vectors with null or non-finite components and rows with a null id take no
part; vectors are compared with those of the same length only; equal rows count once; ties go to the
smaller id; fewer than k others give fewer rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import freeze

SAMPLE, MOST_PIVOTS = 2048, 256
ANNULUS, BLOCK = 512, 256


def quantized(vectors: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """vec_id, v (floor of scale * component as integers), h1 and h2 (a 128-bit name of v)."""
    x = F.col(f"`{vector}`")
    finite = F.forall(
        x,
        lambda c: c.isNotNull()
        & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) != float("inf")),
    )
    rows = vectors.filter(F.col(f"`{vec_id}`").isNotNull() & x.isNotNull() & finite)
    whole = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long"))
    named = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("v"))
    return named.select("vec_id", "v", *_name(F.col("v"))).distinct()


def _name(v: Column) -> list[Column]:
    return [F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2")]


def pick_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Pivots for each length of vector in a bounded sample."""
    sample = classes.select("v", "h1").orderBy("h1", "v").limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.v), []).append(row.v)
    pivots = {}
    for length, found in by_length.items():
        many = min(MOST_PIVOTS, max(1, int(np.sqrt(len(found)) * 1.5)))
        pivots[length] = np.array(found[:many], dtype=np.float64).reshape(many, length)
    return pivots


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _pivots_for(pivots: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Lengths that the sample lacks have the origin as their pivot."""
    return pivots.get(length, np.zeros((1, length)))


def _rows(values: list) -> np.ndarray:
    return np.array(values, dtype=np.int64)


def keyed(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds length, pivot and distance to the nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.names.index("v")).to_pylist()
            lengths = np.array([len(v) for v in vectors], np.int32)
            nearest, far = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                x = _rows([vectors[i] for i in at]).reshape(len(at), length).astype(np.float64)
                d = _distances(x, _pivots_for(pivots, length))
                nearest[at] = d.argmin(1)
                far[at] = d.min(1)
            extra = [pa.array(lengths), pa.array(nearest), pa.array(far)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra], [*batch.schema.names, "length", "pivot", "distance"]
            )

    types = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{types}, length int, pivot int, distance double")


def annuli(classes: DataFrame) -> DataFrame:
    """The index: one row per annulus, cut from rows sorted by (length, pivot, distance)."""
    names = ["annulus", "length", "pivot", "near", "far", "norm", "n", "vectors", "names", "counts", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(),
             pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            length, pivot = held[0][:2]
            x = _rows([h[3] for h in held]).reshape(len(held), length)
            norm = float((x.astype(np.float64) ** 2).sum(1).max())
            ids = [h[4] for h in held]
            row = [
                base + count, length, pivot, held[0][2], held[-1][2], norm, len(held),
                _short(x),
                np.array([h[5:7] for h in held], "<i8").tobytes(),
                np.array([len(i) for i in ids], "<i4").tobytes(),
                np.array([i for some in ids for i in some], "<i8").tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if held and (row[:2] != held[0][:2] or len(held) == ANNULUS):
                    yield flush()
                    held, count = [], count + 1
                held.append(row)
        if held:
            yield flush()

    ordered = classes.repartitionByRange("length", "pivot", "distance", "h1").sortWithinPartitions(
        "length", "pivot", "distance", "h1"
    )
    schema = (
        "annulus long, length int, pivot int, near double, far double, norm double, n int, "
        "vectors binary, names binary, counts binary, ids binary"
    )
    return ordered.select("length", "pivot", "distance", "v", "ids", "h1", "h2").mapInArrow(run, schema)


def query_blocks(queries: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Blocks of queries near each other, one row per block.

    For each pivot ``rings`` has the bounds of the distances to it, and whether it is the nearest
    one of some query; ``q_norm`` and ``least`` are the greatest norm and least k-th score.
    """

    names = ["block", "q_length", "q_norm", "least", "q_vectors", "q_names", "q_least", "low", "high", "own"]
    kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary(),
             pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            length = held[0][0]
            x = _rows([h[2] for h in held]).reshape(len(held), length)
            d = _distances(x.astype(np.float64), _pivots_for(pivots, length))
            own = np.isin(np.arange(d.shape[1]), [h[1] for h in held])
            least = np.array([h[5] for h in held])
            row = [
                base + count, length, float((x.astype(np.float64) ** 2).sum(1).max()),
                float(least.min()), _short(x),
                np.array([[h[3], h[4]] for h in held], "<i8").tobytes(),
                least.astype("<f8").tobytes(), d.min(0).tolist(), d.max(0).tolist(), own.tolist(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and (row[0] != held[0][0] or len(held) == BLOCK):
                    yield flush()
                    held, count = [], count + 1
                held.append(row)
        if held:
            yield flush()

    ordered = queries.repartitionByRange("length", "pivot", "distance", "h1").sortWithinPartitions(
        "length", "pivot", "distance", "h1"
    )
    return ordered.select("length", "pivot", "v", "h1", "h2", "least").mapInArrow(
        run,
        "block long, q_length int, q_norm double, least double, q_vectors binary, q_names binary, "
        "q_least binary, low array<double>, high array<double>, own array<boolean>",
    )


def visit(blocks: DataFrame, index: DataFrame, first: bool, k: int) -> DataFrame:
    """h1, h2, c1, c2, vec_id, score: the k best of each visited annulus for each query.

    The first round takes the annuli that a block's own pivots put around its distances, the second
    one all that the bound allows; what a block has seen before it may see again.
    """
    rings = index.select("annulus", "length", "pivot", "near", "far", "norm")
    gap = F.greatest(F.lit(0.0), F.col("near") - F.col("high"), F.col("low") - F.col("far"))
    # Distances are rounded, so the bound gets a little room.
    bound = (F.col("q_norm") + F.col("norm") - gap * gap) / 2 * (1 + 1e-9) + 1
    wanted = F.col("own") & (gap == 0) if first else bound >= F.col("least")
    facts = blocks.select(
        "block", "q_length", "q_norm", "least",
        F.posexplode(F.arrays_zip("low", "high", "own")).alias("q_pivot", "ring"),
    ).select("block", "q_length", "q_norm", "least", "q_pivot", "ring.*")
    pairs = facts.join(
        rings, (F.col("q_length") == F.col("length")) & (F.col("q_pivot") == F.col("pivot")) & wanted
    ).select("block", "annulus")
    rows = (
        pairs.join(index.select("annulus", "vectors", "names", "counts", "ids"), "annulus")
        .join(blocks.select("block", "q_vectors", "q_names", "q_least", "q_length"), "block")
        .select("q_length", "q_vectors", "q_names", "q_least", "vectors", "names", "counts", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                yield _compare(row, k)

    return rows.mapInArrow(run, "h1 long, h2 long, c1 long, c2 long, vec_id long, score long")


def _compare(row: tuple, k: int) -> pa.RecordBatch:
    """One block of queries against one annulus."""
    length, q, names, least, x, known, counts, ids = row
    known = np.frombuffer(known, "<i8").reshape(-1, 2)
    names = np.frombuffer(names, "<i8").reshape(-1, 2)
    least = np.frombuffer(least, "<f8")
    counts = np.frombuffer(counts, "<i4")
    ids = np.frombuffer(ids, "<i8")
    q, x = _long(q, len(names), length), _long(x, len(counts), length)
    scores = _products(q, x)
    place = np.repeat(np.arange(len(counts)), counts)
    out = []
    for i in range(len(names)):
        own = scores[i][place]
        good = np.flatnonzero(own >= least[i])
        if len(good) > k:
            good = good[np.lexsort((ids[good], -own[good]))[:k]]
        out.append((np.full(len(good), i), ids[good], own[good], known[place[good]]))
    who = np.concatenate([o[0] for o in out])
    which = np.concatenate([o[3] for o in out])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names[who, 0]), pa.array(names[who, 1]),
            pa.array(which[:, 0]), pa.array(which[:, 1]),
            pa.array(np.concatenate([o[1] for o in out])),
            pa.array(np.concatenate([o[2] for o in out]).astype(np.int64)),
        ],
        ["h1", "h2", "c1", "c2", "vec_id", "score"],
    )


def _short(x: np.ndarray) -> bytes:
    """Integers in the smallest of 2, 4 and 8 bytes that holds them all."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    size = next(s for s in (2, 4, 8) if -(2 ** (8 * s - 1)) <= low and high < 2 ** (8 * s - 1))
    return x.astype(f"<i{size}").tobytes()


def _long(data: bytes, rows: int, length: int) -> np.ndarray:
    size = len(data) // (rows * length) if rows * length else 8
    return np.frombuffer(data, f"<i{size}").reshape(rows, length).astype(np.int64)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while they hold every sum exactly."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def exact_top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    rows = freeze(quantized(vectors, vec_id, vector, scale))
    # Equal vectors are one entry; the limit by rank is applied before the shuffle as well.
    same = Window.partitionBy("h1", "h2", "v").orderBy("vec_id")
    classes = (
        rows.withColumn("r", F.row_number().over(same))
        .filter(F.col("r") <= k + 1)
        .groupBy("h1", "h2", "v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    classes = freeze(classes)
    pivots = pick_pivots(classes)
    index = freeze(annuli(keyed(classes, pivots)))
    asking = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    entries = keyed(asking.select("h1", "h2", "v").distinct(), pivots)
    entries = freeze(entries)
    need = k + 1
    blocks = freeze(query_blocks(entries.withColumn("least", F.lit(float("-inf"))), pivots))
    near = freeze(visit(blocks, index, True, need))
    order = Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), "vec_id")
    kth = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") == need)
    bounded = entries.join(kth.select("h1", "h2", F.col("score").alias("kth")), ["h1", "h2"], "left")
    least = F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))
    again = freeze(query_blocks(bounded.withColumn("least", least), pivots))
    far = visit(again, index, False, need)
    best = near.union(far).distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= need)
    # Back from entries to the rows that ask; a row itself is left out.
    answers = asking.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(best, ["h1", "h2"])
    itself = (
        (F.col("vec_id") == F.col("query_id"))
        & (F.col("c1") == F.col("h1"))
        & (F.col("c2") == F.col("h2"))
    )
    others = answers.filter(~itself)
    ranked = others.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy(F.col("score").desc(), "vec_id")),
    )
    return ranked.filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
