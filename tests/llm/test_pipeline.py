"""The pipeline stage by stage, each on what the one before it kept, against plain Python."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import awkward_rows, encoder
from tidemark.llm import mixing, quality
from tidemark.session import freeze, in_written_order, setting

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def verdict(text):
    counts = brute.quality_counts(text)
    found = brute.words(text)
    counts["n_lines"] = sum(bool(brute.words(x)) for x in (text or "").split("\n"))
    counts["n_stop_words"] = sum(w.lower() in quality.STOP_WORDS for w in found)

    def holds(rule):
        count, of = counts[rule.numerator], counts[rule.denominator]
        if counts["n_words"] < rule.from_words or of == 0:
            return True
        return (rule.low is None or count >= rule.low * of) and (rule.high is None or count <= rule.high * of)

    return not counts["base_failed"] and all(holds(r) for r in quality.RULES)


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before and after every stage."""
    rows = [(i, t, "en", f"s{(i or 0) % 4}", len(t or "")) for i, t in awkward_rows()]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = freeze(stage(spark, docs, ""))
        results.append(docs)
    return [[r.asDict() for r in d.collect()] for d in results]


def texts(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_columns_stay(spark):
    docs = spark.createDataFrame([(1, "the cat " * 20, "en", "a", 160)], COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]


def test_quality(stages):
    want = Counter((r["doc_id"], r["text"]) for r in stages[0] if verdict(r["text"]))
    assert texts(stages[1]) == want and len(stages[1]) < len(stages[0])


def test_lines(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1]]
    assert texts(stages[2]) == Counter((d, t) for d, _, _, t in brute.line_dedup(rows))
    assert texts(stages[2]) != texts(stages[1])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_near_duplicates(stages):
    rows = sorted({(r["doc_id"], r["text"]) for r in stages[2]}, key=lambda x: (x[0] is None, x))
    groups = defaultdict(list)
    for (doc_id, text), (_, n, component) in zip(rows, brute.near_duplicates(rows)):
        groups[component if n else ("alone", doc_id, text)].append((doc_id, text))
    assert texts(stages[3]) == Counter(min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values())


def test_mix(stages):
    size = {(r["doc_id"], r["text"]): len(brute.words(r["text"])) for r in stages[3]}
    assert set(texts(stages[4])) <= set(size)
    assert max(texts(stages[4]).values()) <= mixing.MAX_REPEATS
    total, by_source, took = sum(size.values()), Counter(), Counter()
    for r in stages[3]:
        by_source[r["source"]] += size[r["doc_id"], r["text"]]
    for r in stages[4]:
        took[r["source"]] += size[r["doc_id"], r["text"]]
    assert all(took[s] <= 3 * by_source[s] + max(size.values()) / 2 for s in by_source)
    assert abs(sum(took.values()) - total) <= len(by_source) * max(size.values()) / 2


def test_packed(stages):
    encode = encoder("byte_bpe_50k.json")
    want = sum((len(encode(t)) + 1) * n for (_, t), n in texts(stages[4]).items())
    assert sum(p["length"] for p in stages[5]) == want
    ids = {r["doc_id"]: encode(r["text"]) + [1] for r in stages[4]}
    place = Counter()
    for p in sorted(stages[5], key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == place[p["sequence_id"]] and p["offset"] + p["length"] <= 2048
        place[p["sequence_id"]] += p["length"]
        assert brute.crc(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]) == p["ids_crc32"]
    assert len(place) == -(-want // 2048)


def test_packed_follows_the_curriculum(spark):
    # Texts of different lengths by source, and a range partition per file: the files differ in size.
    rows = [(i, f"w{i} " * (5 if i % 4 else 40 + i), "en", f"s{i % 4}", 0) for i in range(400)]
    docs = freeze(spark.createDataFrame(rows, COLUMNS))
    sized = mixing.sized(docs, "doc_id", "source", "text", carry=docs.columns)
    plan = mixing.curriculum(sized, stats=mixing.sized(docs, "doc_id", "source", "text"))
    want = sorted(
        (position, r["key"], r["row"]["doc_id"])
        for r in plan.filter("copies > 0").collect() for position in r["positions"]
    )
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        mixed = freeze(corpus_pipeline.source_mix(spark, docs, ""))
        pieces = corpus_pipeline.packed(spark, mixed, "").collect()
        order = [r["doc_id"] for r in in_written_order(mixed).collect()]
    assert len(mixed.inputFiles()) > 2
    starts = sorted((p["sequence_id"], p["offset"], p["doc_id"]) for p in pieces if p["start"] == 0)
    assert [doc for _, _, doc in starts] == [doc for _, _, doc in want] == order
    assert len({doc for _, _, doc in want}) > 100


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_run(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = freeze(stage(spark, docs, folder))
    found = corpus_pipeline.run(spark, folder)
    names = ("doc_id", "start", "length", "ids_crc32")
    # Which document follows which may differ, and with it where they are cut.
    total = lambda df: sum(r["length"] for r in df.select("length").collect())
    assert found.columns == docs.columns and total(found) == total(docs)
    assert set(names) <= set(found.columns)
