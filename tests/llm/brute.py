"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BARE = "\x20\t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def line_dedup(rows, min_docs=10):
    """(doc_id, text) to (doc_id, n_lines, n_dropped, kept text)."""
    docs = defaultdict(set)
    split = [(text or "").split("\n") for _, text in rows]
    key = lambda line: line.strip(BARE).translate(LOWER)
    for i, lines in enumerate(split):
        for line in lines:
            docs[key(line)].add(rows[i])
    out = []
    for (doc_id, _), lines in zip(rows, split):
        kept = [x for x in lines if not key(x) or len(docs[key(x)]) < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(found) < 10 or 100 * len(covered) > 20 * len(found),
    }


def shingles(text):
    found = [w.translate(LOWER) for w in words(text)]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def near_duplicates(rows, percent=75):
    """(doc_id, text) to (doc_id, n_shingles, component_id), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    post = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in post[x])
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
        for x in s:
            post[x].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [
        (d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))
    ]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def top_k(rows, every=50, k=5):
    """(vec_id, vector) to (query_id, rank, vec_id, score)."""
    good = {
        (i, tuple(np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64).tolist()))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for q, x in good:
        if q % every == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(x, y)), i)
                for i, y in good
                if (i, y) != (q, x) and len(x) == len(y)
            )
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def hard_negatives(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """(vec_id, label, vector) to the rows of hard_negatives, by all pairs."""
    good = {
        (i, l, tuple(int(np.floor(256 * float(x))) for x in v))
        for i, l, v in rows
        if i is not None and l is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a[2], c[2])))), c[0], c[1])
            for c in good
            if c != a and len(c[2]) == len(a[2])
        )
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fits = [x for x in scored if x[2] != a[1] and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a[0], p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(fits[:negatives])]
    return sorted(out)


def runs(words, least_length=6, least_power=4):
    """(start, length, period) of all runs, by comparing places one period apart."""
    n, out = len(words), []
    for q in range(1, n // least_power + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least_length, least_power * q):
                part = words[start : start + length]
                if all(part[d:] != part[:-d] for d in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted_periods(doc_id, found):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(found)
    if doc_id is None or h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]
