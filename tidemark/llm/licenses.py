"""License texts in documents, by conditional compression.

Anchors, words of the templates, mark candidate blocks: the words around them, joined where they
overlap. A wording that is accepted lacks at most a tenth of a template's words, so of each template one
different word more than that is an anchor, and no accepted wording can avoid all of them. A block is compressed alone, and once with each template as a raw zstandard
dictionary; templates are ranked by how much smaller that makes it. The rank excludes none, as a
short notice saves next to nothing of a long block. Every template is confirmed by
wording: it is aligned with the best stretches of the block, word by word, and accepted if
at most a tenth of its words differ. Only places that hold enough of its words are aligned. Of overlapping accepted stretches the one with the smallest share of
different words stays, then the longer, then the better ranked.

Only texts that hold an anchor reach Python; the search for anchors is a built-in expression over
whole texts.

Cases: a null or empty text has no license; null ids pass through; equal rows give equal results,
each its own; ties between templates go to the first in the table; an empty table gives an empty
table. Work on a text is linear in its length but for blocks, which are as long as anchors follow
each other; they are cut at 2,000 words, with an overlap of the longest template, so nothing that
crosses a cut is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty, worker_memory

#: Short notices and the opening passages of common licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
)
AROUND, LONGEST_BLOCK = 16, 2000
#: Share of a template's words that may differ.
DIFFERENCES = 0.1


def plain_words(text: str) -> list[str]:
    """Words in lower case without punctuation at their ends."""
    return [w.lower().strip(".,;:!?()[]{}\"'*#") for w in text.split()]


def anchors_of(templates: Sequence[tuple[str, str]], share: float = DIFFERENCES) -> list[str]:
    """Words of which every accepted wording of every template holds one at least.

    An edit takes one word away, so a template with ``most`` edits needs ``most + 1`` different
    words. Words of many templates that are still short of them are preferred, and long words.
    """
    words = [[w for w in dict.fromkeys(plain_words(text)) if w] for _, text in templates]
    need = [min(len(w), int(share * len(plain_words(t))) + 1) for w, (_, t) in zip(words, templates)]
    chosen: list[str] = []
    while any(need):
        gain: dict[str, int] = {}
        for own, short in zip(words, need):
            left = [w for w in own if w not in chosen] if short else []
            # Short words are common ones; they serve where a template has too few others.
            for w in [w for w in left if len(w) > 5] or left:
                gain[w] = gain.get(w, 0) + 1
        best = max(gain, key=lambda w: (gain[w] + len(w) / 2, w))
        chosen.append(best)
        need = [n - (best in own) if n else 0 for own, n in zip(words, need)]
    return chosen


class Scanner:
    """Compressors and words of all templates."""

    def __init__(self, templates: Sequence[tuple[str, str]], level: int = 9):
        import zstandard

        self.names = [name for name, _ in templates]
        self.words = [plain_words(text) for _, text in templates]
        self.longest = max(map(len, self.words))
        options = zstandard.ZstdCompressionParameters.from_level(
            level, write_content_size=False, write_checksum=False, write_dict_id=False,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        self.alone = zstandard.ZstdCompressor(compression_params=options)
        self.with_template = [
            zstandard.ZstdCompressor(
                compression_params=options,
                dict_data=zstandard.ZstdCompressionDict(
                    " ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )
            for words in self.words
        ]
        self.anchors = {*anchors_of(templates)}

    def blocks(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """First and end word of the stretches around anchors."""
        at = [i for i, w in enumerate(words) if w in self.anchors]
        spans: list[list[int]] = []
        reach = max(AROUND, self.longest)
        for i in at:
            low, high = max(0, int(i) - reach), min(len(words), int(i) + reach + 1)
            if spans and low <= spans[-1][1]:
                spans[-1][1] = high
            else:
                spans.append([low, high])
        step = LONGEST_BLOCK - 2 * self.longest
        for low, high in spans:
            for cut in range(low, high, step):
                yield cut, min(high, cut + LONGEST_BLOCK)
                if cut + LONGEST_BLOCK >= high:
                    break

    def ranked(self, words: list[str]) -> list[tuple[float, int]]:
        """(share of bytes saved, template) of all templates, best first."""
        block = " ".join(words).encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(block))
        saved = [1 - len(c.compress(block)) / size for c in self.with_template]
        order = sorted(range(len(saved)), key=lambda i: (-saved[i], i))
        return [(saved[i], i) for i in order]

    def scan(self, text: str) -> list[tuple[str, int, int, float, int, str]]:
        """name, first word, end word, share saved, differences, wording of each license found."""
        words = plain_words(text)
        found = set()
        for low, high in self.blocks(words):
            block = words[low:high]
            for saved, t in self.ranked(block):
                for start, end, edits in stretches(self.words[t], block, DIFFERENCES):
                    found.add((edits / len(self.words[t]), start - end, -saved, t, low + start, low + end, edits))
        taken: list[tuple] = []
        for x in sorted(found):
            if all(x[5] <= y[4] or y[5] <= x[4] for y in taken):
                taken.append(x)
        out = []
        for _, _, saved, t, start, end, edits in sorted(taken, key=lambda x: x[4]):
            wording = wording_of(self.words[t], words[start:end])
            out.append((self.names[t], start, end, round(-saved, 4), edits, wording))
        return out


def stretches(template: list[str], block: list[str], share: float) -> list[tuple[int, int, int]]:
    """Stretches of the block (start, end, edits) that differ from the template in few words.

    The best stretch of each group of overlapping ones, by the semi-global edit distance.
    """
    m = len(template)
    most = int(share * m)
    there = {*block}
    if sum(w not in there for w in template) > most:  # each such word is a difference
        return []
    ends = [x for low, high in promising(template, block, most) for x in _ends(template, block, low, high, most)]
    kept: list[tuple[int, int, int]] = []
    for edits, a, b in sorted(ends, key=lambda x: (x[0], x[1] - x[2], x[1])):
        if all(b <= s or e <= a for s, e, _ in kept):
            kept.append((a, b, edits))
    return kept


def promising(template: list[str], block: list[str], most: int) -> list[tuple[int, int]]:
    """Parts of the block (first word, end) that hold every stretch with at most ``most`` edits.

    Such a stretch has up to ``most`` words more than the template, and all but ``most`` of its words.
    """
    m, known = len(template), {*template}
    before = np.cumsum([0] + [w in known for w in block])
    ends = np.arange(1, len(block) + 1)
    lows = np.maximum(0, ends - m - most)
    spans: list[tuple[int, int]] = []
    for j in ends[before[ends] - before[lows] >= m - most].tolist():
        low = max(0, j - m - most)
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], j)
        else:
            spans.append((low, j))
    return spans


def _ends(
    template: list[str], block: list[str], low: int, high: int, most: int
) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best stretch at every end between low and high that has one."""
    m = len(template)
    same = {w: [w == t for t in template] for w in {*block[low:high]}}
    cost, start = list(range(m + 1)), [low] * (m + 1)
    ends = []
    for j in range(low + 1, high + 1):
        old_cost, old_start = cost, start
        cost, start = [0] * (m + 1), [j] * (m + 1)
        hit = same[block[j - 1]]
        for i in range(1, m + 1):
            options = (
                (old_cost[i - 1] + (not hit[i - 1]), -old_start[i - 1]),
                (old_cost[i] + 1, -old_start[i]),
                (cost[i - 1] + 1, -start[i - 1]),
            )
            best = min(options)
            cost[i], start[i] = best[0], -best[1]
        if cost[m] <= most:
            ends.append((cost[m], start[m], j))
    return ends


def wording_of(template: list[str], found: list[str]) -> str:
    """The words that differ: ``-`` those of the template only, ``+`` those of the text only."""
    import difflib

    parts = []
    for tag, a, b, c, d in difflib.SequenceMatcher(None, template, found, False).get_opcodes():
        if tag != "equal":
            parts += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in found[c:d]]
    return " ".join(parts)


def find_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, license, first_word, end_word, reduction, differences, wording: a row per license."""
    templates = tuple(templates)
    # Without its word borders this finds more than the scanner does, and nothing less.
    anchors = "|".join(f"\\Q{w}\\E" for w in anchors_of(templates))
    body = text_or_empty(text)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("body")).filter(
        F.lower("body").rlike(anchors)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_memory(("licenses", templates), lambda: Scanner(templates))
        for batch in batches:
            found = [
                (doc, *license_)
                for doc, body in zip(*(batch.column(i).to_pylist() for i in (0, 1)))
                for license_ in scanner.scan(body)
            ]
            columns = list(zip(*found)) if found else [()] * 7
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "license", "first_word", "end_word", "reduction", "differences", "wording"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, license string, first_word int, end_word int, reduction double, "
        "differences int, wording string",
    )
