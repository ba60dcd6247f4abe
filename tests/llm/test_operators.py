"""Every operator against plain Python, on rows made to be awkward."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import (
    chat,
    licenses,
    lines,
    mixing,
    near_dups,
    packing,
    pii,
    quality,
    token_files,
    top_k,
)
from tidemark.llm.queries import tokenizer

DOCS = "doc_id long, text string, source string, row string, size int, k1 long, ck string"


def prose(draw, n):
    return " ".join(draw.choice(["the", "of", "and", "Ärger", "cat,", "Dog.", "house", "über", "x1"]) + (
        str(draw.randint(0, 400)) if draw.random() < 0.7 else "") for _ in range(n))


def awkward_rows():
    draw = random.Random(3)
    base = prose(draw, 120)
    words = base.split()
    rows = [(None, "the null id " + prose(draw, 30)), (1, None), (2, ""), (3, " \n\t "), (4, "one two three")]
    rows += [(5, "One TWO three"), (6, prose(draw, 12_000)), (7, base), (7, base), (8, base.upper()), (9, base + "\n")]
    for i in range(14):  # near copies, some of them in chains
        words = words[:]
        words[draw.randrange(len(words))] = f"w{i}"
        rows.append((20 + i, " ".join(words)))
    for i in range(15):  # a shared line, with white space and case of its own
        mark = [" Shared LINE ", "shared line\t", "SHARED line"][i % 3]
        rows.append((50 + i, f"{prose(draw, 20)}\n{mark}\n{'shared line' if i % 2 else ''}\n{prose(draw, 9)}"))
    rows.append((80, "\n".join(["same"] * 30)))
    rows.append((81, "go go go go go go go go go go go go go"))
    rows.append((82, "# * $ % & | < > " * 12))
    rows.append((83, "É Ü ß  two  spaces \x0b\x0c end   nbsp \x1c sep"))
    rows.append((84, "<|endoftext|> <|startoftext|> it's we'll \x01 \x00 end"))
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns bear names that the operators use themselves."""
    data = [(i, t, f"s{(i or 0) % 4}" if i != 6 else None, "extra", 1, 2, "c") for i, t in rows]
    return spark.createDataFrame(data, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def tuples(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# Quality rules


def test_quality_counts(docs, rows):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    found = tuples(quality.judge(docs).select("row.doc_id", *names), "doc_id", *names)
    want = [(i, *(brute.quality_counts(t)[n] for n in names)) for i, t in rows]
    assert found == sorted(want, key=repr)


def test_quality_keeps_columns_and_verdict(docs, empty):
    judged = quality.judge(docs)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == judged.filter("kept").count() < docs.count()
    assert "symbols" in judged.filter("row.doc_id = 82").first()["broken"]
    assert quality.keep_good(empty).count() == 0


def test_quality_rule_bounds(spark):
    df = spark.createDataFrame([(1, "the " + "word " * 29 + "||| |||")], "doc_id long, text string")
    rule = quality.Rule("symbols", "n_symbols", "n_words", None, 6 / 32)
    assert quality.judge(df, rules=[rule], max_repeat_percent=100).first()["kept"]
    rule = quality.Rule("symbols", "n_symbols", "n_words", None, 5.9 / 32)
    assert quality.judge(df, rules=[rule], max_repeat_percent=100).first()["broken"] == ["symbols"]


# Line dedup


def test_line_dedup(docs, rows):
    cut = lines.dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept_text")
    want = sorted(brute.line_dedup(rows), key=repr)
    assert tuples(cut, "doc_id", "n_lines", "n_dropped", "kept_text") == want
    assert any(w[2] for w in want)


def test_line_dedup_bitmaps_and_columns(docs, empty):
    cut = lines.dedup_lines(docs)
    for row in cut.filter("n_dropped > 0").collect():
        assert sum(r["length"] for r in row["keep_runs"]) == row["n_lines"] - row["n_dropped"]
    out = lines.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert out.filter("text is null").count() == 1
    assert lines.without_repeated_lines(empty).count() == 0


def test_line_dedup_keep_first(spark):
    rows = [(i, f"own {i}\nagain") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = lines.dedup_lines(df, keep_first=True)
    assert cut.filter("kept_text like '%again%'").count() == 1
    assert lines.dedup_lines(df).filter("kept_text like '%again%'").count() == 0


# Mixing


def test_mixing(docs, rows, empty):
    found = mixing.mix_plan(docs).collect()
    sizes = Counter()
    for i, t in rows:
        sizes[None if i == 6 else f"s{(i or 0) % 4}"] += len(brute.words(t))
    taken, longest = Counter(), Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    order = sorted((s for s in sizes if s), key=str.encode) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, total, left = {}, sum(sizes.values()), set(order)
    while left:  # shares by weight; whoever is above the cap stops there
        share = {s: weight[s] * (total - sum(target.values())) / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] > 3 * sizes[s]}
        target.update({s: 3 * sizes[s] if above else share[s] for s in (above or left)})
        left -= above or left
    for r in found:
        assert r["target"] == pytest.approx(target[r["source"]])
    for s in order:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1
    assert len(found) == len(rows)
    assert mixing.mix_plan(empty).count() == 0
    again = mixing.mix_plan(docs.repartition(3))
    names = ("doc_id", "size", "taken", "position")
    assert tuples(again, *names) == sorted((tuple(r[n] for n in names) for r in found), key=repr)


def test_mixing_documents(docs, empty):
    plan = {(r["doc_id"], r["size"]): r for r in mixing.mix_plan(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = Counter((r["doc_id"], len(brute.words(r["text"]))) for r in out.collect())
    for key, r in plan.items():
        copies = 2 if key[0] == 7 else 1  # the repeated row
        assert times[key] == 0 if r["taken"] == 0 else times[key] % copies in (0, 1)
    assert sum(k[1] * n for k, n in times.items()) == sum(r["taken"] for r in mixing.mix_plan(docs).collect())
    assert mixing.mixed_documents(empty).count() == 0


def test_curriculum_follows_schedule(spark):
    """The heavy source leads at first; positions invert the demand curve."""
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(df).filter("taken > 0").collect()
    early = Counter(r["source"] for r in plan if r["position"] < 0.25)
    late = Counter(r["source"] for r in plan if 0.75 <= r["position"] <= 1)
    assert early["s2"] < late["s2"]
    assert early["s0"] > late["s0"] * 1.5
    for knots in mixing.CURVES:
        amounts = spark.range(11).select((F.col("id") / 10).alias("a"))
        for r in amounts.select("a", mixing.inverse(F.col("a"), knots).alias("t")).collect():
            part = [(0, knots[0][1])] + [(r["t"], np.interp(r["t"], *zip(*knots)))]
            assert mixing.area(part) == pytest.approx(r["a"], abs=1e-9)


# Token files


def encoder(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer(name))
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def test_token_files(spark, docs, rows, empty, tmp_path):
    encode = encoder("word_bpe_49k.json")
    out = str(tmp_path / "tokens")
    token_files.write_token_files(docs, out, tokenizer("word_bpe_49k.json"), "drop", 2)
    found = token_files.read_token_files(spark, out).orderBy("start").collect()
    assert sorted(bytes(r["ids"]) for r in found) == sorted(
        np.array(encode(t) + [2], "<u4").tobytes() for _, t in rows
    )
    at, last = 0, -1
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
        number = -1 if r["doc_id"] is None else r["doc_id"]
        assert number >= last
        last = number
    text = {i: t for i, t in rows}
    for r in found:
        assert np.frombuffer(r["ids"], "<u4").tolist() == encode(text[r["doc_id"]]) + [2]
    whole = np.frombuffer(b"".join(bytes(r["ids"]) for r in found), "<u4")
    for first, end in ((0, 5), (3, 3), (127, 129), (300, 20_000), (len(whole) - 2, len(whole) + 9), (0, len(whole))):
        parts = token_files.read_ids(spark, out, first, end).orderBy("start").collect()
        assert np.frombuffer(b"".join(bytes(p["ids"]) for p in parts), "<u4").tolist() == whole[first:end].tolist()
        assert not parts or parts[0]["start"] == first
    out = str(tmp_path / "none")
    token_files.write_token_files(empty, out, tokenizer("word_bpe_49k.json"), "drop", 2)
    assert token_files.read_token_files(spark, out).count() == 0


def test_ranges_of_packed_blocks():
    """A part of a column by the index equals the part of the whole column; columns end where they say."""
    draw = np.random.default_rng(5)
    for n in (0, 1, 127, 128, 129, 1000):
        values = draw.integers(0, 50, n)
        values[draw.random(n) < 0.05] = 2**40  # exceptions
        data = b"xxxx" + token_files.pack(values) + token_files.pack(values[::-1])
        whole, end = token_files.unpack(data, 4)
        assert token_files._column_end(data, 4) == end
        for _ in range(40):
            a, b = sorted(draw.integers(0, n + 3, 2).tolist())
            assert token_files.unpack_range(data, 4, a, b).tolist() == whole[a:b].tolist()
            assert token_files.unpack_range(data, end, a, b).tolist() == whole[::-1][a:b].tolist()


def test_packed_blocks():
    draw = np.random.default_rng(1)
    for values in (
        [], [0], [5] * 300, draw.integers(0, 50_000, 1000), [2**52 - 1, 0, 3] * 50,
        np.where(draw.random(5000) < 0.05, 2**31, draw.integers(0, 9, 5000)), np.arange(129),
    ):
        data = token_files.pack(np.array(values, dtype=np.int64))
        back, end = token_files.unpack(data)
        assert back.tolist() == list(values) and end == len(data)
    # Outliers go to the exception list and do not widen the block.
    odd = np.zeros(12_800, np.int64)
    odd[::128] = 2**30
    assert len(token_files.pack(odd)) < 3_000
    ids = [np.arange(3, dtype="<u4").tobytes(), b""]
    docs, counts, stream = token_files.decode_segment(token_files.encode_segment([None, -(2**63)], ids))
    assert docs == [None, -(2**63)] and counts.tolist() == [3, 0] and stream.tolist() == [0, 1, 2]


# Packing


def test_packing(docs, rows, empty):
    encode = encoder("byte_bpe_50k.json")
    text = {i: t for i, t in rows}
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"), "lead", 1).collect()
    used = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == used[p["sequence_id"]]
        used[p["sequence_id"]] += p["length"]
        ids = encode(text[p["doc_id"]]) + [1]
        part = ids[p["start"] : p["start"] + p["length"]]
        assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == brute.crc(part)
        assert bytes(p["ids"]) == np.array(part, "<u4").tobytes()
        assert p["continues"] == (p["start"] + p["length"] < len(ids))
    assert sorted(used) == list(range(len(used)))
    assert [n for s, n in used.items() if n != 2048] in ([], [used[max(used)]])
    assert sum(used.values()) == sum(len(encode(t)) + 1 for _, t in rows)
    assert packing.pack(empty, tokenizer("byte_bpe_50k.json"), "lead", 1).count() == 0


def test_sequences(docs):
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"), "lead", 1, window=256)
    found = packing.sequences(pieces, 256).orderBy("sequence_id").collect()
    assert all(len(r["ids"]) == 1024 for r in found[:-1])
    stream = b"".join(bytes(r["ids"])[: 4 * r["n_tokens"]] for r in found)
    firsts = pieces.orderBy("sequence_id", "offset").collect()
    assert stream == b"".join(bytes(p["ids"]) for p in firsts)


# Near duplicates


def test_near_duplicates(docs, rows, empty):
    found = near_dups.near_duplicates(docs)
    names = ("doc_id", "n_shingles", "component_id")
    assert tuples(found, *names) == sorted(brute.near_duplicates(rows), key=repr)
    for r in found.collect():
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_dups.near_duplicates(empty).count() == 0


def test_near_duplicates_keep_one(docs, rows, empty):
    kept = near_dups.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {(c if n else ("alone", i)) for i, n, c in brute.near_duplicates(rows)}
    assert kept.count() == len(groups)
    assert near_dups.keep_one_of_each(empty).count() == 0


def test_near_duplicates_many_copies(spark):
    """A large group of near copies, chains, and texts that share half of their words with it."""
    draw = random.Random(9)
    words = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(300):
        copy = words[:]
        for _ in range(draw.randrange(4)):
            copy[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    for i in range(60):
        rows.append((1000 + i, " ".join(words[: 20 + 2 * i] + [f"y{draw.randrange(10**6)}" for _ in range(80)])))
    for i in range(60):
        rows.append((2000 + i, " ".join(f"z{k}" for k in range(4 * i, 4 * i + 100))))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = near_dups.near_duplicates(df)
    names = ("doc_id", "n_shingles", "component_id")
    assert tuples(found, *names) == sorted(brute.near_duplicates(rows), key=repr)


def test_finer_signatures(spark):
    """Their agreement estimates the similarity of two sets."""
    draw = np.random.default_rng(4)
    base = draw.integers(0, 2**63, 2000, dtype=np.uint64)
    other = base.copy()
    other[:250] = draw.integers(0, 2**63, 250, dtype=np.uint64)
    found = near_dups.coordinate_minima([base, other, base], 512, 11)
    assert (found[0] == found[2]).all()
    assert abs(np.mean(found[0] == found[1]) - 1750 / 2250) < 0.08
    bits = near_dups.fine_bits([base, other], near_dups.FINE)
    names = [f"{side}{i}" for side in "ab" for i in range(near_dups.FINE // 64)]
    row = [int(x) for x in bits.view(np.int64).reshape(-1)]
    df = spark.createDataFrame([row], ", ".join(f"{n} long" for n in names))
    agree = df.select(near_dups.agreements("a", "b")).first()[0]
    assert agree == int((np.unpackbits(bits[0]) == np.unpackbits(bits[1])).sum())
    assert abs(agree / near_dups.FINE - (1 + 1750 / 2250) / 2) < 0.03


def test_finer_signatures_over_many_pairs():
    """At a similarity of 0.75 the thresholds lie where their docstring says."""
    draw = np.random.default_rng(7)
    agree = []
    for _ in range(60):
        base = draw.integers(0, 2**63, 700, dtype=np.uint64)
        other = np.concatenate([base[100:], draw.integers(0, 2**63, 100, dtype=np.uint64)])
        a, b = near_dups.fine_bits([np.sort(base), np.sort(other)], near_dups.FINE)
        agree.append(int((np.unpackbits(a) == np.unpackbits(b)).sum()))
    assert abs(np.mean(agree) - 1792) < 8 and 10 < np.std(agree) < 21
    assert min(agree) >= near_dups.fine_rounds(75)[1]


# Top-k


def test_top_k(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), draw.normal(size=6).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one frequent vector
    rows += [rows[0], (50, rows[9][1]), (2000, None), (2050, [1.0, None] + [0.0] * 4), (None, rows[2][1])]
    rows += [(2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (2200, [0.5, 0.25]), (2201, [1.0, -1.0])]
    rows += [(2250, [])]
    df = spark.createDataFrame(
        [(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, pivot int, v string"
    ).repartition(6)
    found = top_k.exact_top_k(df, every=50)
    assert sorted(tuples(found, "query_id", "rank", "vec_id", "score")) == brute.top_k(rows)
    assert top_k.exact_top_k(df.limit(0)).count() == 0


def test_top_k_skips_annuli(spark, monkeypatch):
    """With clusters far apart most pairs of blocks are never compared."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(12, 8)) * 60
    rows = [(i, (centres[i % 12] + draw.normal(size=8)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(top_k, "ANNULUS", 32)
    monkeypatch.setattr(top_k, "BLOCK", 16)
    visits = []
    real = top_k.visit

    def counted(blocks, index, first, k):
        out = real(blocks, index, first, k)
        visits.append((blocks.count(), index.count(), out.select("c1", "c2").distinct().count()))
        return out

    monkeypatch.setattr(top_k, "visit", counted)
    found = top_k.exact_top_k(df, every=50)
    assert sorted(tuples(found, "query_id", "rank", "vec_id", "score")) == brute.top_k(rows)
    assert visits[1][2] < 1500


# Licenses


def test_licenses(spark, empty):
    mit = licenses.TEMPLATES[2][1]
    changed = mit.replace("hereby", "herewith").replace("merge, ", "")
    rows = [
        (1, "word " * 50 + "\nReleased under the MIT License.\n" + "word " * 30),
        (2, "a b c " + mit + " x y z"), (3, "a b c " + changed + " x y z"),
        (4, "Licensed under CC BY-NC 4.0. and more. Licensed under the Apache License, Version 2.0."),
        (5, "You need a licence to drive; the license was lost under the table"), (6, None), (7, ""),
        (8, " ".join([mit] * 60)), (None, "Licensed under CC BY 4.0."),
        (9, "Licensed under CC BY 4.0."), (9, "Licensed under CC BY 4.0."),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, license string, body int")
    found = licenses.find_licenses(df)
    count = Counter((r["doc_id"], r["license"], r["differences"]) for r in found.collect())
    assert count == {
        (1, "MIT", 0): 1, (2, "MIT", 0): 1, (3, "MIT", 2): 1, (4, "CC-BY-NC-4.0", 0): 1,
        (4, "Apache-2.0", 0): 1, (8, "MIT", 0): 60, (None, "CC-BY-4.0", 0): 1, (9, "CC-BY-4.0", 0): 2,
    }
    wording = found.filter("doc_id = 3").first()["wording"].split()
    assert set(wording) == {"-hereby", "+herewith", "-merge"}
    assert licenses.find_licenses(empty).count() == 0


def test_many_short_notices_in_one_block(spark):
    draw = random.Random(5)
    short = [(name, t) for name, t in licenses.TEMPLATES if len(t.split()) < 20][:12]
    rows, want = [], set()
    for doc, repeats in ((1, 1), (2, 2), (3, 8)):  # the last one is longer than a block
        text, at = [], 0
        for name, notice in short * repeats:
            text += [prose(draw, 45), notice]
            at += 45 + len(notice.split())
            want.add((doc, name, at - len(notice.split()), at, 0))
        rows.append((doc, " ".join(text)))
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"], r["first_word"], r["end_word"], r["differences"]) for r in found} == want
    assert len(found) == len(want) == 12 * 11


def test_stretches_are_those_of_the_whole_block():
    draw = random.Random(6)
    for _ in range(200):
        template = [draw.choice("abcdef") for _ in range(draw.randint(1, 12))]
        block = [draw.choice("abcdefgh") for _ in range(40)]
        for share in (0.1, 0.3):
            most = int(share * len(template))
            ends = licenses._ends(template, block, 0, len(block), most)
            parts = licenses.promising(template, block, most)
            assert ends == [x for low, high in parts for x in licenses._ends(template, block, low, high, most)]


def test_license_anchors_follow_from_templates(spark):
    """A template of the caller, a misspelt word that was an anchor, white space of other kinds."""
    own = "You may use this work in any way you like, provided that this sentence stays in every copy."
    bsd = next(t for n, t in licenses.TEMPLATES if n == "BSD")
    cc0 = next(t for n, t in licenses.TEMPLATES if n == "CC0-1.0")
    rows = [
        (1, f"The cat sat. {own} The dog ran."), (2, bsd.replace("Redistribution", "Re-distribution")),
        (3, cc0.replace(" ", "\u00a0").replace("public\u00a0domain", "public\u2003domain")),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.find_licenses(df, [*licenses.TEMPLATES, ("own", own)]).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == {(1, "own"), (2, "BSD"), (3, "CC0-1.0")}
    for name, text in licenses.TEMPLATES:
        words = licenses.plain_words(text)
        held = {*words} & {*licenses.anchors_of(licenses.TEMPLATES)}
        assert len(held) > int(licenses.DIFFERENCES * len(words)), name


# Personal data


def base_spans(text):
    import re

    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            check = sum(x - 9 * (x > 9) for x in twice) % 10 == 0
            good = (
                True, k != 1 or all(int(x) <= 255 for x in m[0].split(".")),
                12 <= len(digits) <= 19 and check, 9 <= len(digits) <= 15,
            )[k]
            if good:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def private_rows():
    draw = random.Random(8)
    rows = []
    for i in range(250):
        parts = [prose(draw, 5)]
        for _ in range(draw.randrange(3)):
            octet = lambda: draw.randrange(300)
            digits = "".join(str(draw.randrange(10)) for _ in range(15))
            twice = [int(c) * (2 - i % 2) for i, c in enumerate(reversed(digits))]
            card = digits + str(-sum(x - 9 * (x > 9) for x in twice) % 10)
            parts.append(draw.choice([
                f"joe.{i}@mail.example.com", f"{octet()}.{octet()}.{octet()}.{octet()}", card,
                card[:-1] + str((int(card[-1]) + 1) % 10), "-".join(card[k : k + 4] for k in range(0, 16, 4)),
                f"+1 ({draw.randrange(1000):03}) 555-{draw.randrange(10_000):04}", f"{card} {digits}7",
            ]))
            parts.append(prose(draw, 2))
        rows.append((i, " ".join(parts)))
    rows += [
        (None, "x@y.zz"), (900, None), (901, ""), (902, "a@b_c@d.com x@y@z.com a@b.com.x_y@c.de é@ü.com"),
        (903, "1.2.3.4.5.6.7.8 001.002.0003.4 1.2.3.256 1.2.3"), (904, "5" * 30_000 + " @" * 2_000 + "a" * 30_000),
        (905, "1 " * 9_000), (906, "+1 " + " " * 20_000 + "x +12345 67890 +"), (907, "a@b.co c@d.io"),
        (908, "a@b.co " * 1500), (909, "😀 a@b.co 😀 1.2.3.4"), (910, "+1+2 (555) 123-4567"), (7, rows[7][1]),
    ]
    return rows


def test_private(spark, empty):
    rows = private_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, base string").repartition(4)
    found = pii.find_private(df).select(
        "row.doc_id", pii.spelled(F.col("base")).alias("b"), pii.spelled(F.col("spans")).alias("s")
    )
    assert tuples(found, "doc_id", "b") == sorted(((i, base_spans(t)) for i, t in rows), key=repr)
    for r in found.collect():
        assert set(r["b"].split(",")) <= set(r["s"].split(",")) | {""}
    assert pii.find_private(empty).count() == 0


def test_private_adds_and_spares(spark):
    """A card inside a longer run of digits is added; texts without private data stay bare."""
    rows = private_rows()
    card = "4111111111111111"
    rows += [(5000, f"the cat {card} {card} house"), (5001, "over 2000 cats, 12 dogs and 1999.5 houses")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["s"] for r in pii.find_private(df).select("row.doc_id", pii.spelled(F.col("spans")).alias("s")).collect()}
    assert spans[5000] == "card:8:24,card:25:41"
    assert spans[5001] == ""


def test_redacted(spark):
    rows = [(1, "write a.b@c.de or +1 (555) 123-4567!"), (2, None), (3, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = dict(tuple(r) for r in pii.redacted(df).collect())
    assert out == {1: "write [EMAIL] or [PHONE]!", 2: None, 3: "nothing"}


# Chat


def test_chat(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "ho <|im_end|>"), (1, 3, "ann", "bye"),
        (2, 5, "user", "q"), (2, 5, "user", "q"), (2, None, "assistant", None), (3, 0, "system", "alone"),
        (None, 1, None, "lost"), (None, 2, "user", "found"),
    ]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, part string, position int")
    out = {(r["conv"], r["perspective"]): r for r in chat.rotate(df).collect()}
    assert set(out) == {(1, "ann"), (1, "bob"), (2, "user"), (2, "assistant"), (None, "unknown"), (None, "user")}
    ann = out[1, "ann"]
    assert ann["text"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
        "<|im_start|>user name=bob\nho < |im_end|><|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n"
    )
    assert [ann["text"][m["start"] : m["end"]] for m in ann["mask"]] == ["hi<|im_end|>", "bye<|im_end|>"]
    bob = out[1, "bob"]
    assert [bob["text"][m["start"] : m["end"]] for m in bob["mask"]] == ["ho < |im_end|><|im_end|>"]
    assert out[2, "user"]["n_trained"] == 2 and out[2, "assistant"]["n_turns"] == 3
    assert out[2, "assistant"]["text"].endswith("<|im_start|>assistant\n<|im_end|>\n")
    assert chat.rotate(df.limit(0)).count() == 0


def test_chat_long_dialogue(spark, blocks):
    """A dialogue of many turns is numbered in blocks and cut into parts."""
    df = spark.range(1000).selectExpr("1L as conv_id", "id as turn", "if(id % 2 = 0, 'a', 'b') as role", "cast(id as string) as text")
    whole = tuples(chat.rotate(df), "perspective", "part", "text")
    assert len(whole) == 2 * 4
    blocks(100)
    assert tuples(chat.rotate(df), "perspective", "part", "text") == whole


# Word encoder


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", "lead"), ("word_bpe_49k.json", "drop")])
def test_word_encoder(name, spaces):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from tidemark.llm.tokens import WordEncoder

    ours, theirs = WordEncoder(tokenizer(name), spaces), encoder(name)
    odd = st.sampled_from([" ", "  ", "\n", " \n", "\t", "a", "It's", "don't", "É", "ß", "1", "12", ".", "\x01", " ", " ", "é", "́", "<|endoftext|>", "😀", "\x1c", "İ", "Σ"])

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(odd, max_size=12).map("".join) | st.text(max_size=12), max_size=4))
    def same(texts):
        assert ours.encode(texts) == [ours.as_bytes(theirs(t)) for t in texts]

    same()
