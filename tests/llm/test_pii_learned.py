"""What the learned part of the search for personal data adds, and what it leaves alone."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import prose
from tidemark.llm import pii


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(2)
    rows = [(i, prose(draw, draw.randrange(3, 80))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "1")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def model(docs):
    return pii.fit(docs, size=4000)


def test_precision_and_recall_on_new_passages(docs, model):
    """Planted with another seed; only candidates that the base check leaves out count."""
    found = pii.quality_of(model, docs, size=3000, seed=9)
    assert set(found) == set(pii.KINDS)
    for kind, (precision, recall) in found.items():
        assert precision >= 0.95, kind
        assert recall >= (0.9 if kind != "ip" else 0.0), kind


def test_labels_do_not_follow_the_check(docs):
    """Cards are planted with and without a right check sum; both are personal data."""
    sample = pii.labelled_sample(docs, "text", 3000).filter("kind = 2 and label = 1")
    counts = {r["luhn"]: r["count"] for r in sample.groupBy("luhn").count().collect()}
    assert counts[0.0] > 100 and counts[1.0] > 50
    look_alike = pii.labelled_sample(docs, "text", 3000).filter("label = 0")
    assert look_alike.filter("kind = 2 and luhn = 1").count() > 10


def test_spans_are_added_and_look_alikes_spared(spark, docs):
    draw = random.Random(5)
    number = lambda n: "".join(str(draw.randrange(10)) for _ in range(n))
    wanted, spared = [], []
    for _ in range(60):
        for span, before in ((number(16), ""), (number(16), "card "), (f"({number(3)}) {number(3)}-{number(4)}", "call "),
                             ("maria (at) tom.k (dot) org", "")):
            wanted.append((before, span))
        for span, before in ((number(16), "order no. "), ("20231117" + number(6), ""), (f"{number(2)}-{number(4)}-{number(4)}", "part ")):
            spared.append((before, span))
    rows, truth = [], {}
    for i, (before, span) in enumerate(wanted + spared):
        lead = prose(draw, 6) + " " + before
        rows.append((1000 + i, f"{lead}{span} {prose(draw, 6)}"))
        truth[1000 + i] = (i < len(wanted), len(lead), len(lead) + len(span))
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    found = pii.find_private(both, sample=4000).filter("row.doc_id >= 1000")
    spans = {r["d"]: [(x["s"], x["e"]) for x in r["spans"]] for r in found.select(F.col("row.doc_id").alias("d"), "spans").collect()}
    base = {r["d"] for r in found.filter(F.size("base") > 0).select(F.col("row.doc_id").alias("d")).collect()}
    caught = [(s, e) in spans[d] for d, (personal, s, e) in truth.items() if personal and d not in base]
    kept = [not spans[d] for d, (personal, s, e) in truth.items() if not personal and d not in base]
    assert len(caught) > 200 and sum(caught) >= 0.9 * len(caught)
    assert len(kept) > 100 and sum(kept) >= 0.9 * len(kept)


def test_scores_equal_sparks_own(docs, model):
    """The one expression is the fitted booster: trees times weights, on the same features."""
    sample = pii.labelled_sample(docs, "text", 500)
    rows = sample.select(*pii.FEATURES, model.margin([F.col(n) for n in pii.FEATURES]).alias("score")).collect()

    def walk(node, row):
        while node.getClass().getSimpleName() != "LeafNode":
            split = node.split()
            node = node.leftChild() if row[split.featureIndex()] <= split.threshold() else node.rightChild()
        return node.prediction()

    for row in rows[:40]:
        want = sum(w * walk(t, row) for t, w in zip(model.trees, model.weights))
        assert row["score"] == pytest.approx(want)


def test_one_document_or_none(spark):
    one = spark.createDataFrame([(1, "a card 5927243074273351 here")], "doc_id long, text string")
    assert pii.fit(one, size=1000) is not None
    assert pii.find_private(one, sample=1000).first()["spans"][0]["t"] == "5927243074273351"
    assert pii.fit(one.limit(0)) is None and pii.find_private(one.limit(0)).count() == 0
