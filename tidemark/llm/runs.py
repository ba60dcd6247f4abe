"""Periodic runs of words, found by extending Lyndon roots with suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping q, at
least ``least_length`` long and ``least_power`` periods. For a sequence of words two Ukkonen trees
are built, of it and of its reversal. A leaf-to-leaf LCA in a tree is the longest common extension
of two places: to the right in the first tree, to the left in the second. LCAs are least depths of a
range of the Euler tour, looked up in constant time (block minima and a sparse table over blocks).
By the runs theorem every run holds, for the order of words or its reverse, a longest Lyndon word of
its own period; so each place gives two candidates (place, length of its longest Lyndon word there),
from next smaller suffixes in leaf order. Extended both ways, those of two periods are the runs.

Trees are built only where runs can lie, without loss: every four words in a row inside a run come
again one period further or before, so all of them occur twice in the run. Stretches of a document
in which no four words in a row occur once are cut out, again within each stretch until nothing
changes; a run lies whole in one of them, and its neighbours beyond it cannot extend it there.

Cases: a null or empty text has no words, no runs and an empty collapsed text; rows are independent,
so null ids, ties and equal rows need no rule and give one row each; columns of the input come back
only by ``carry``, inside ``row``, so no name clashes; an empty table gives an empty table. Time and memory of
a task grow with the longest text, not with a group: about 20 microseconds and 400 bytes per word
that lies in a stretch that repeats, a fraction of a microsecond for others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import text_or_empty

LEAST_LENGTH, LEAST_POWER = 6, 4
#: Words in a row that all occur twice inside a run, given the two limits above.
GRAM = 4
#: Words that are looked at together; a longer text is looked at alone.
CHUNK = 200_000
#: Entries of the Euler tour that one minimum of the sparse table covers.
RANGE = 16

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """The suffix tree of numbers from 1 on, with a final 0 added, after Ukkonen."""

    def __init__(self, numbers: Sequence[int]):
        self.text = [*numbers, 0]
        self.base = max(self.text) + 1
        self._build()

    def _build(self) -> None:
        text, base, n = self.text, self.base, len(self.text)
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        find = edges.get
        node = at = length = waiting = 0
        for i, c in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    at = i
                key = node * base + text[at]
                child = find(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[child]
                    span = end[child] - first
                    if length >= span:
                        at += span
                        length -= span
                        node = child
                        continue
                    if text[first + length] == c:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    # The edge is cut: a new inner node above the child, and a leaf beside it.
                    inner = len(start)
                    edges[key] = inner
                    start += (first, i)
                    end += (first + length, n)
                    link += (0, 0)
                    edges[inner * base + c] = inner + 1
                    start[child] = first + length
                    edges[inner * base + text[first + length]] = child
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        self.start, self.end = np.array(start), np.array(end)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.parent, self.letter = keys // base, keys % base

    def _children(self, letters: np.ndarray) -> tuple[list[int], list[int]]:
        """Children by parent and letter, last first, and where the ones of each node begin."""
        order = np.lexsort((-letters, self.parent))
        counts = np.bincount(self.parent, minlength=len(self.start))
        return self.child[order].tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()

    def tour(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Depths in words along the Euler tour, where each suffix' leaf is on it, its rank."""
        n = len(self.text)
        child, first = self._children(self.letter)
        span = (self.end - self.start).tolist()
        depths: list[int] = []
        place, rank, turn = [0] * n, [0] * n, 0
        # A number below zero says that the tour comes back to a depth.
        stack, above = [0], [0]
        while stack:
            node = stack.pop()
            if node < 0:
                depths.append(-1 - node)
                continue
            depth = above.pop() + span[node]
            low, high = first[node], first[node + 1]
            if low == high:
                place[n - depth] = len(depths)
                rank[n - depth] = turn
                turn += 1
            else:
                for x in child[low:high]:
                    stack += (-1 - depth, x)
                    above.append(depth)
            depths.append(depth)
        return np.array(depths, np.int32), np.array(place), np.array(rank)

    def ranks_reversed(self) -> np.ndarray:
        """Ranks of the suffixes when greater numbers come first; an end still comes before all."""
        n = len(self.text)
        child, first = self._children(np.where(self.letter == 0, -self.base, -self.letter))
        span = (self.end - self.start).tolist()
        rank, turn, stack, above = [0] * n, 0, [0], [0]
        while stack:
            node = stack.pop()
            depth = above.pop() + span[node]
            low, high = first[node], first[node + 1]
            if low == high:
                rank[n - depth] = turn
                turn += 1
            else:
                stack += child[low:high]
                above += [depth] * (high - low)
        return np.array(rank)


class Extensions:
    """Longest common extensions of pairs of places in constant time each."""

    def __init__(self, depths: np.ndarray, place: np.ndarray):
        self.place = place
        blocks = -(-len(depths) // RANGE)
        grid = np.full(blocks * RANGE, np.iinfo(np.int32).max, np.int32)
        grid[: len(depths)] = depths
        self.depths = grid
        grid = grid.reshape(blocks, RANGE)
        self.ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        self.behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [grid.min(axis=1)]
        step = 1
        while 2 * step <= blocks:
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - step], last[step:]))
            step *= 2

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // RANGE, b // RANGE
        found = np.minimum(self.behind[a], self.ahead[b])
        near = first == last
        if near.any():
            # Inside one block: at most RANGE entries each.
            low, high = a[near], b[near]
            least = self.depths[low]
            for k in range(1, RANGE):
                least = np.minimum(least, self.depths[np.minimum(low + k, high)])
            found[near] = least
        gap = last - first - 1
        for level, minima in enumerate(self.levels):
            here = np.flatnonzero((gap >= 1 << level) & (gap < 2 << level))
            if len(here):
                middle = np.minimum(minima[first[here] + 1], minima[last[here] - (1 << level)])
                found[here] = np.minimum(found[here], middle)
        return found


def _next_smaller(rank: list[int]) -> list[int]:
    """For each suffix the place of the next one of lower rank; the last one is the empty suffix."""
    n = len(rank)
    after = [n - 1] * n
    stack = [n - 1]
    for i in range(n - 2, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        after[i] = stack[-1]
        stack.append(i)
    return after


def runs_of(
    numbers: Sequence[int], least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER
) -> np.ndarray:
    """Rows of start, length, period: all runs of a sequence of numbers from 1 on, sorted."""
    n = len(numbers)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(numbers)
    depths, place, rank = tree.tour()
    right = Extensions(depths, place)
    other = tree.ranks_reversed()
    tree = SuffixTree(numbers[::-1])
    left = Extensions(*tree.tour()[:2])
    del tree
    place = np.arange(n)
    found = []
    for ranks in (rank, other):
        after = np.array(_next_smaller(ranks.tolist()))[:n]
        # The next smaller suffix of a last place is the empty one; it has nothing to extend.
        inside = after < n
        i, j = place[inside], after[inside]
        period = j - i
        ahead = right.of(i, j)
        behind = np.zeros_like(ahead)
        # Place i - 1 is place n - i of the reversal.
        inner = i > 0
        behind[inner] = left.of(n - i[inner], n - j[inner])
        length = period + ahead + behind
        good = (length >= np.maximum(2, least_power) * period) & (length >= least_length)
        found.append(np.stack([(i - behind)[good], length[good], period[good]], axis=1))
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _often(grams: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether a gram occurs twice or more in its group."""
    mixed = (grams ^ (group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed)
    ordered = mixed[order]
    same = ordered[1:] == ordered[:-1]
    found = np.zeros(len(grams), bool)
    found[order[1:]] = same
    found[order[:-1]] |= same
    return found


def stretches(numbers: np.ndarray, owner: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches in which all ``gram`` words in a row occur twice.

    ``owner`` tells texts apart. Equal hashes of different words only make a stretch too large.
    """
    n = len(numbers) - gram + 1
    if n <= 0:
        return []
    grams = np.zeros(n, np.uint64)
    for k in range(gram):
        grams = (grams ^ numbers[k : k + n].astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
        grams ^= grams >> np.uint64(29)
    at = np.flatnonzero(owner[:n] == owner[gram - 1 :])
    group = owner[at]
    while True:
        kept = _often(grams[at], group)
        if kept.all():
            break
        at, group = at[kept], group[kept]
        # What is in a row and of one text is one stretch; within it all is counted anew.
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1])
        group = np.cumsum(new)
    if not len(at):
        return []
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1])]))
    last = np.concatenate([new[1:], [len(at)]]) - 1
    return list(zip(at[new].tolist(), (at[last] + gram).tolist()))


def _gram(least_length: int, least_power: int) -> int:
    """How many words in a row surely come again inside a run of any period.

    A run of length L has places up to L - k for k words in a row, and each has another one a
    period before or after if L - k >= 2q - 1 (or L - k >= 1 for period 1).
    """
    found = GRAM
    while found > 1 and any(
        max(least_length, least_power * q) - found < 2 * q - 1 for q in range(1, least_length + found + 2)
    ):
        found -= 1
    return found


def runs_in_texts(
    texts: list[list[bytes]], least_length: int, least_power: int
) -> list[np.ndarray]:
    """The runs of each list of words."""
    sizes = [len(t) for t in texts]
    known: dict[bytes, int] = {}
    total = sum(sizes)
    numbers = np.fromiter(
        (known.setdefault(w, len(known) + 1) for t in texts for w in t), np.int64, total
    )
    owner = np.repeat(np.arange(len(texts)), sizes)
    base = np.concatenate([[0], np.cumsum(sizes)])
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for start, end in stretches(numbers, owner, _gram(least_length, least_power)):
        if end - start < least_length:
            continue
        doc = int(owner[start])
        # Numbers of its own keep the keys of the tree's edges small.
        _, own = np.unique(numbers[start:end], return_inverse=True)
        runs = runs_of((own + 1).tolist(), least_length, least_power)
        if len(runs):
            found[doc].append(runs + [start - int(base[doc]), 0, 0])
    none = np.zeros((0, 3), np.int64)
    return [np.concatenate(f) if f else none for f in found]


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run holds after its first period."""
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",),
    least_length: int = LEAST_LENGTH, least_power: int = LEAST_POWER,
) -> DataFrame:
    """``row`` (the carried columns), n_words, runs (start, length, period) and ``collapsed``.

    ``collapsed`` is the text without what repeats: words that lie in a run after its first period
    are left out, and the others are joined by one space.
    """
    if least_power < 2 or least_length < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, column = batch.column(0), batch.column(1)
            at, held, words = 0, 0, []
            for i in range(batch.num_rows):
                words.append(column[i].as_py().encode("utf-8", "surrogatepass").split())
                held += len(words[-1])
                if held >= CHUNK or i + 1 == batch.num_rows:
                    yield answer(row.slice(at, i + 1 - at), words)
                    at, held, words = i + 1, 0, []

    def answer(row: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_in_texts(words, least_length, least_power)
        every = np.concatenate(found)
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        values = pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(every[:, k])) for k in range(3)], fields=list(_RUN)
        )
        return pa.RecordBatch.from_arrays(
            [
                row, pa.array([len(w) for w in words], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), values),
                pa.array([_collapsed(w, f) for w, f in zip(words, found)], pa.string()),
            ],
            ["row", "n_words", "runs", "collapsed"],
        )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text_or_empty(text).alias("body")
    )
    run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [
            rows.schema["row"], T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(run_type)), T.StructField("collapsed", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest length over period, exactly; ties by start, then period."""

    def better(best: Column, x: Column) -> Column:
        left, right = x["length"] * best["period"], best["length"] * x["period"]
        first = F.struct(x["start"], x["period"]) < F.struct(best["start"], best["period"])
        return best.isNull() | (left > right) | ((left == right) & first)

    kind = "struct<start:bigint,length:bigint,period:bigint>"
    none = F.lit(None).cast(kind)
    return F.aggregate(runs, none, lambda b, x: F.when(better(b, x), x).otherwise(b))
