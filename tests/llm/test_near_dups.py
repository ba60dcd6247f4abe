"""Near duplicates at several similarities, with copies in thousands and planted pairs at the border."""

from __future__ import annotations

import random

import pytest

from tests.llm import brute
from tidemark.llm import near_dups


def planted_pairs(percent, pairs, seed):
    """Pairs whose sets of shingles are as alike as the threshold asks, or a little more or less."""
    draw = random.Random(seed)
    rows = []
    for i in range(pairs):
        n = draw.randrange(60, 140)
        words = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        # A changed tail of k words changes k shingles: (n - 4 - k) / (n - 4 + k) is the similarity.
        k = round((n - 4) * (100 - percent) / (100 + percent)) + draw.randrange(-2, 3)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[: n - k], *[f"t{i}x{j}" for j in range(k)]]))]
    return rows


@pytest.mark.parametrize("percent", [50, 60, 75, 90])
def test_no_pair_is_lost(spark, percent):
    rows = planted_pairs(percent, 300, percent)
    found = near_dups.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), percent=percent
    )
    have = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    want = sorted(brute.near_duplicates(rows, percent))
    assert have == want
    linked = sum(c != d for d, _, c in want)
    assert 100 < linked < 290


def test_thresholds():
    assert near_dups.least_agreements(64, 0.75, near_dups.LOSS) == 32
    assert near_dups.fine_rounds(75) == (1786, 1721)
    assert near_dups.least_agreements(64, 1.0, near_dups.LOSS) == 64
    for percent in (20, 50, 90):
        first, last = near_dups.fine_rounds(percent)
        assert 1024 < last <= first < 2048
    with pytest.raises(ValueError):
        near_dups.near_duplicates(None, percent=0)


def test_large_class_and_large_group(spark):
    """Many exact copies, many near copies, rows that are equal in all: each row once, one stays."""
    draw = random.Random(1)
    words = [f"w{draw.randrange(500)}" for _ in range(90)]
    rows = [(i, " ".join(words)) for i in range(400)]
    for i in range(300):
        near = words[:]
        near[draw.randrange(90)] = f"n{i}"
        rows.append((1000 + i, " ".join(near)))
    rows += [(5000, "a text of its own that stays alone here")] * 3 + [(6000, None), (6000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dups.near_duplicates(df).collect()
    assert len(found) == len(rows)
    want = {d: c for d, _, c in brute.near_duplicates([*rows[:700], rows[700]])}
    assert all(r["component_id"] == want.get(r["doc_id"], 6000) for r in found)
    kept = sorted(r["doc_id"] for r in near_dups.keep_one_of_each(df).collect())
    assert kept == [0, 5000, 6000]  # null and empty are one row here
