"""Periodic runs against comparison of all places, and the query against a plain version of it."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tests.llm.test_operators import DOCS, awkward_rows
from tidemark.llm import runs
from tidemark.llm.queries import table


def some_words(draw):
    n, k = draw.randrange(0, 45), draw.choice([1, 2, 2, 3, 4])
    words = [draw.randrange(1, k + 1) for _ in range(n)]
    if n and draw.random() < 0.5:
        a, p = draw.randrange(n), draw.randrange(1, 8)
        words = [words[i] if i < a or a + p > n else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least_length, least_power", [(6, 4), (2, 2), (4, 3), (20, 2)])
def test_runs_of_short_sequences(least_length, least_power):
    draw = random.Random(least_length)
    for _ in range(1500):
        words = some_words(draw)
        want = brute.runs(words, least_length, least_power)
        assert [tuple(r) for r in runs.runs_of(words, least_length, least_power).tolist()] == want
        texts = [[b"%d" % w for w in words], [b"z"], []]
        found = runs.runs_in_texts(texts, least_length, least_power)
        assert [tuple(r) for r in found[0].tolist()] == want and not len(found[1]) + len(found[2])


def test_extensions_in_and_across_blocks():
    draw = random.Random(5)
    text = [draw.randrange(1, 3) for _ in range(300)]
    tree = runs.SuffixTree(text)
    depths, place, rank = tree.tour()
    right = runs.Extensions(depths, place)
    import numpy as np

    i, j = np.array([(draw.randrange(300), draw.randrange(300)) for _ in range(3000)]).T
    i, j = i[i != j], j[i != j]
    for a, b, found in zip(i, j, right.of(i, j)):
        want = 0
        while max(a, b) + want < 300 and text[a + want] == text[b + want]:
            want += 1
        assert found == want
    order = sorted(range(301), key=lambda p: text[p:])
    assert [order.index(p) for p in range(301)] == rank.tolist()
    turned = [3 - x for x in text]
    order = sorted(range(301), key=lambda p: turned[p:])
    assert [order.index(p) for p in range(301)] == tree.ranks_reversed().tolist()


def test_awkward_documents(spark):
    rows = awkward_rows()
    rows += [(200, "a b " * 4 + "c"), (201, "x\u00a0y\u2003 " * 9), (202, "go " * 5), (203, "go " * 6)]
    rows += [(204, " ".join(["long", "text"] * 30_000)), (205, "a b c d " * 4 + "a b c e " * 4)]
    data = [(i, t, "s", "extra", 1, 2, "c") for i, t in rows]
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    found = runs.find_runs(docs, carry=["doc_id", "row", "text"])
    have = sorted(
        ((r["row"]["doc_id"], r["row"]["text"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
         for r in found.collect()), key=repr,
    )
    want = []
    for i, text in rows:
        words = brute.words(text)
        each = [(0, 60_000, 2)] if i == 204 else brute.runs(words)
        want.append((i, text, len(words), each, brute.collapsed(words, each)))
    assert have == sorted(want, key=repr)
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_limits(spark):
    docs = spark.createDataFrame([(1, "a b a b")], "doc_id long, text string")
    assert runs.find_runs(docs, least_length=4, least_power=2).first()["collapsed"] == "a b"
    with pytest.raises(ValueError):
        runs.find_runs(docs, least_power=1)


def test_query(spark):
    rows = table(spark, entry.SMOKE, "documents").select("doc_id", "text").collect()
    want = []
    for doc_id, text in rows:
        words = brute.planted_periods(doc_id, brute.words(text))
        each = brute.runs(words)
        best = max(each, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        times = None if best[0] is None else 1000 * best[1] // best[2]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in each)
        hashes = brute.sha256(listed), brute.sha256(brute.collapsed(words, each))
        want.append((doc_id, len(each), *best, times, *hashes))
    found = [tuple(r) for r in entry.queries()["op13_runs"](spark, entry.SMOKE).collect()]
    assert sorted(found) == sorted(want)
    assert sum(w[1] > 0 for w in want) > len(want) / 20
