"""Hard negatives against all pairs, and Strassen's products against plain ones."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import hard_negatives

VECTORS = "vec_id long, label int, embedding array<double>, score string, tile int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def some_rows():
    draw = random.Random(4)
    rows = []
    for i in range(420):
        label = draw.choice([0, 0, 0, 1, 2, 7])
        vector = [draw.gauss(0.3, 0.4) for _ in range(9)]
        rows.append((i, label, vector))
    rows += [(50, 0, rows[50][2]), (50, 1, rows[50][2]), (50, 0, rows[51][2])]
    rows += [(500 + i, 0, rows[0][2]) for i in range(30)]  # ties
    rows += [(600, 0, [1.0, 2.0]), (601, 0, [1.0, 2.5]), (602, 1, [1.0, 1.0]), (650, 9, [1.0, 2.0])]
    rows += [(700, 3, []), (701, 3, []), (702, 4, []), (750, None, [1.0, 2.0])]
    rows += [(None, 0, [1.0] * 9), (800, 0, None), (850, 0, [1.0] * 8 + [None])]
    rows += [(900, 0, [float("nan")] * 9), (950, 0, [float("inf")] * 9)]
    return rows


def found(df, **options):
    out = hard_negatives.hard_negatives(df, **options)
    return sorted(tuple(r[n] for n in NAMES) for r in out.collect())


@pytest.fixture(scope="module")
def df(spark):
    rows = some_rows()
    return spark.createDataFrame([(*r, "x", 1) for r in rows + rows[:3]], VECTORS).repartition(4)


def test_against_all_pairs(df):
    want = brute.hard_negatives(some_rows())
    assert found(df) == want and len({w[0] for w in want}) >= 8
    assert found(df, tile=7, block=2, plain=2) == want
    assert found(df.limit(0)) == []


def test_other_limits(df):
    want = brute.hard_negatives(some_rows(), 30, 2, 4, 10, 80)
    assert found(df, every=30, positives=2, negatives=4, low=10, high=80, tile=64) == want


def test_scores_beyond_doubles_and_longs(spark):
    draw = random.Random(9)
    for size in (1e6, 1e12):
        rows = [(i, i % 2, [draw.uniform(-size, 3 * size) for _ in range(3)]) for i in range(60)]
        data = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
        assert found(data, every=10) == brute.hard_negatives(rows, 10)


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 9, 5), (64, 64, 64), (65, 130, 67), (200, 33, 300), (3, 0, 4)])
@pytest.mark.parametrize("most", [100, 2**30])
def test_strassen(shape, most):
    n, k, m = shape
    draw = np.random.default_rng(n)
    a, b = draw.integers(-most, most, (n, k)), draw.integers(-most, most, (m, k))
    want = a.astype(object) @ b.T.astype(object) if k else np.zeros((n, m), np.int64)
    for plain in (1, 8, 64):
        assert (hard_negatives.strassen(a, b.T, plain) == a @ b.T).all()
        assert (hard_negatives.scores(a, b, plain) == np.clip(want, -(2**63), 2**63 - 1)).all()


def test_heaps_merge_in_any_order():
    entries = [(-s, i, 0, 0, 0) for s, i in [(5, 1), (5, 0), (9, 7), (1, 3), (9, 2)]]
    one, two = hard_negatives.Heaps(1, 3), hard_negatives.Heaps(1, 3)
    one.merge(0, entries)
    for e in reversed(entries):
        two.merge(0, [e])
    assert one.held == two.held == [[(-9, 2, 0, 0, 0), (-9, 7, 0, 0, 0), (-5, 0, 0, 0, 0)]]
    assert one.floor(0) == 5
