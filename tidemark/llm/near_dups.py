"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

A document's set is its distinct five-word shingles. A signature has 64 coordinates, each the least
value of one hash over the set. Documents are posted under every (coordinate, value) pair they have;
documents with a similarity of 0.75 agree in 48 of 64 coordinates on average, and pairs that agree
in 32 or more are the ones to look at. That threshold loses a pair at exactly 0.75 with a
probability of 4.6e-6, less for more alike pairs; other similarities have thresholds of their own, by
the same binomial bound. Collisions are not counted pair by pair.

*Prefix.* Only shared values count. A document with fewer than 32 shared values has no partner; of
the others only the rarest m - 31 of its m shared values are posted for joining, since two
documents that share 32 values must share one of those (values in one order of rarity).

*Skip.* A list of posted documents is not expanded into pairs. Exact copies are one class from the
start. Every class is first compared with one centre: of the centres (the member with the most
frequent values) of its lists the most central one. Groups that this joins need no more pairs
inside. Only lists that still hold several groups are merged, between groups, in two rounds: first
the pairs whose finer signatures (one bit of each of 2,048 coordinates) agree as pairs above the wanted
similarity do, which connects nearly all of a group; then all others whose agreement leaves a chance
above 2e-6. A pair is taken from the first list it shares. All pairs taken are confirmed on the full
sets, so every link that could join two groups is looked at.

Groups are connected components: labels go to the least one, round by round, with jumps; each round
is written to the shared folder.

Cases: a text without words, or a null one, has an empty set and stays alone; with fewer than five
words the whole sequence is the one shingle; equal sequences of words are one class however many
rows they have; rows may share an id, the smallest id of a group names it; null ids never name one;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import exp, lgamma
from math import log as log_of

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, text_or_empty, unpack_row, whole_row, worker_memory
from tidemark.session import freeze

WORDS = 5
COORDINATES = 64
#: Coordinates of the finer signature, one bit of each.
FINE = 2048
#: A link has PERCENT * union <= 100 * intersection.
PERCENT = 75
#: Chance to lose a pair just at the wanted similarity, by either signature.
LOSS, FINE_LOSS = 5e-6, 2.1e-6

#: Word hashes that a worker remembers at most.
MEMORY = 200_000

_SCHEMA = "doc_id long, r1 long, r2 long, ck binary, n_shingles long, sig array<long>"


def least_agreements(n: int, p: float, loss: float) -> int:
    """The greatest k such that fewer than k of n agreements, each of chance p, have a chance <= loss."""
    below, k = 0.0, 0
    while k < n:
        if 0 < p < 1:
            log = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log_of(p) + (n - k) * log_of(1 - p)
            below += exp(log)
        if below > loss or p <= 0:
            break
        k += 1
    return max(1, k)


def fine_rounds(percent: float) -> tuple[int, int]:
    """Agreements of finer signatures asked for in the two rounds.

    A bit agrees by chance every other time. The first round takes what agrees about as pairs at
    the wanted similarity do on average, the last one what leaves a chance above FINE_LOSS.
    """
    p = (1 + percent / 100) / 2
    usual = int(FINE * p - 0.4 * (FINE * p * (1 - p)) ** 0.5)
    last = least_agreements(FINE, p, FINE_LOSS)
    return max(usual, last), last


class _Hashes(dict):
    """Hash of a word; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(words: list[bytes], size: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    by = _multipliers(size, 77)
    n = len(hashes) - size + 1
    mixed = np.full(n, np.uint64(size))
    for k in range(size):
        mixed += hashes[k : k + n] * by[k]
    return np.unique(_mix(mixed))


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; bytes are lower-cased and split by just the rules wanted."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def coordinate_minima(sets: list[np.ndarray], coordinates: int, seed: int) -> np.ndarray:
    """One row of mixed least values per set; zeros for an empty set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    found = np.zeros((len(sets), coordinates), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        by, after = _multipliers(coordinates, seed), _multipliers(coordinates, seed + 1)
        every = np.concatenate([sets[i] for i in full])
        firsts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for k in range(coordinates):
            hashed = every * by[k]
            hashed ^= hashed >> np.uint64(31)
            hashed *= after[k]
            found[full, k] = _mix(np.minimum.reduceat(hashed, firsts) + np.uint64(k))
    return found


def fine_bits(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One bit of each coordinate's least value, packed; the sets must not be empty.

    32-bit arithmetic is enough where a single bit is kept.
    """
    every = np.concatenate(sets)
    every = (every ^ (every >> np.uint64(32))).astype(np.uint32)
    firsts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    by = _multipliers(coordinates, 23).astype(np.uint32)
    after = _multipliers(coordinates, 24).astype(np.uint32)
    found = np.empty((len(sets), coordinates), np.uint32)
    hashed, moved = np.empty_like(every), np.empty_like(every)
    for k in range(coordinates):
        np.multiply(every, by[k], out=hashed)
        np.right_shift(hashed, np.uint32(15), out=moved)
        np.bitwise_xor(hashed, moved, out=hashed)
        np.multiply(hashed, after[k], out=hashed)
        found[:, k] = np.minimum.reduceat(hashed, firsts)
    found ^= found >> np.uint32(13)
    found *= np.uint32(0x9E3779B1)
    return np.packbits((found >> np.uint32(31)).astype(np.uint8), axis=1, bitorder="little")


def _class_key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _row_name(doc_id: str, text: str) -> list[Column]:
    """A 128-bit name of a row: of its id and its whole text."""
    body, number = text_or_empty(text), F.col(f"`{doc_id}`").cast("long")
    return [F.xxhash64(number, body).alias("r1"), F.xxhash64(body, F.lit(1), number).alias("r2")]


def signatures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = WORDS, coordinates: int = COORDINATES,
) -> DataFrame:
    """doc_id, ck (names the sequence of words), n_shingles, sig (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_memory("word hashes", _Hashes)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                split = [words_of(t) for t in part.column(3).to_pylist()]
                sets = [shingle_set(w, words, known) for w in split]
                sizes = np.array([len(s) for s in sets], np.int64)
                sig = coordinate_minima(sets, coordinates, 11)
                flat = pa.array(sig.view(np.int64).reshape(-1))
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * coordinates)
                lists = pa.ListArray.from_arrays(offsets, flat, mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([_class_key(w) for w in split], pa.binary()),
                     pa.array(sizes), lists],
                    ["doc_id", "r1", "r2", "ck", "n_shingles", "sig"],
                )

    number = F.col(f"`{doc_id}`").cast("long").alias("doc_id")
    rows = docs.select(number, *_row_name(doc_id, text), text_or_empty(text).alias("t"))
    return rows.mapInArrow(run, _SCHEMA)


def shingle_sets(
    docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int
) -> DataFrame:
    """node, ``hashes`` (sorted, 8 bytes each) and ``fine`` for each row (r1, r2, node) in ``wanted``.

    ``fine`` holds one bit of each of 2,048 coordinates, 64 coordinates to a long. Only the texts of
    the named rows, one of each class, leave their partition's join; copies stay behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_memory("word hashes", _Hashes)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [shingle_set(words_of(t), words, known) for t in part.column(1).to_pylist()]
                raw = [s.astype("<u8").tobytes() for s in sets]
                flat = fine_bits(sets, FINE).view(np.int64).reshape(-1)
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (FINE // 64))
                fine = pa.ListArray.from_arrays(offsets, pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(raw, pa.binary()), fine], ["node", "hashes", "fine"]
                )

    texts = docs.select(*_row_name(doc_id, text), text_or_empty(text).alias("t"))
    once = texts.join(wanted, ["r1", "r2"]).dropDuplicates(["r1", "r2"]).select("node", "t")
    return once.mapInArrow(run, "node long, hashes binary, fine array<long>")


def agreements(a: str, b: str) -> Column:
    """In how many bits two finer signatures agree; their longs are the columns a0, a1, .. and b0, .."""
    differ = [F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(FINE // 64)]
    return F.lit(FINE) - reduce(lambda x, y: x + y, differ)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))],
                ["a", "b"],
            )

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, label: one label for all nodes of a component, for every node of an edge (a, b).

    In each round a node points to its neighbour of least rank, if that is below its own; ranks are
    drawn anew, so chains of pointers are short. Pointers jump once, and edges are contracted to
    the nodes pointed to: what two ends share is gone, and the rest shrinks round by round.
    """
    labels, turn = None, 0
    while True:
        there = edges.filter("a != b").select(F.col("a").alias("node"), F.col("b").alias("other"))
        back = there.select(F.col("other").alias("node"), F.col("node").alias("other"))
        both = freeze(there.union(back).distinct())
        if both.isEmpty():
            return both.select("node", F.col("other").alias("label")) if labels is None else labels
        rank = lambda c: F.xxhash64(F.lit(turn), c)  # noqa: B023, E731
        step = both.groupBy("node").agg(F.min_by("other", rank("other")).alias("near"))
        lower = (rank("near") < rank("node")) | (
            (rank("near") == rank("node")) & (F.col("near") < F.col("node"))
        )
        step = freeze(step.select("node", F.when(lower, F.col("near")).otherwise(F.col("node")).alias("near")))
        onward = step.select(F.col("node").alias("near"), F.col("near").alias("far"))
        step = freeze(step.join(onward, "near").select("node", F.col("far").alias("label")))
        if labels is None:
            labels = step
        else:
            later = step.select(F.col("node").alias("label"), F.col("label").alias("new"))
            labels = freeze(
                labels.join(later, "label", "left").select(
                    "node", F.coalesce("new", "label").alias("label")
                )
            )
        first = step.select("node", F.col("label").alias("a"))
        second = step.select(F.col("node").alias("other"), F.col("label").alias("b"))
        once = both.filter("node < other").join(first, "node").join(second, "other")
        edges, turn = once.select("a", "b").filter("a != b").distinct(), turn + 1


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels after adding edges: only edges between different labels need a closer look."""
    first = labels.select(F.col("node").alias("a"), F.col("label").alias("from"))
    second = labels.select(F.col("node").alias("b"), F.col("label").alias("to"))
    mapped = edges.join(first, "a", "left").join(second, "b", "left").select(
        "a", "b", F.coalesce("from", "a").alias("from"), F.coalesce("to", "b").alias("to")
    )
    mapped = freeze(mapped)
    crossing = mapped.filter(F.col("from") != F.col("to"))
    groups = components(crossing.select(F.col("from").alias("a"), F.col("to").alias("b")).distinct())
    known = labels.union(mapped.select("a", "from")).union(mapped.select("b", "to")).distinct()
    groups = groups.select(F.col("node").alias("label"), F.col("label").alias("group"))
    return freeze(
        known.join(groups, "label", "left").select("node", F.coalesce("group", "label").alias("label"))
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
    coordinates: int = COORDINATES, agree: int | None = None, percent: int = PERCENT,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    ``agree`` and the thresholds of the finer signatures follow from ``percent`` if not given.

    Beside them r1 and r2, the name of the row, and ``stays``: true for one row of each group.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"percent must lie above 0 and up to 100, not {percent}.")
    if agree is None:
        agree = least_agreements(coordinates, percent / 100, LOSS)
    rows = freeze(signatures(docs, doc_id, text, words, coordinates))
    labels = class_labels(docs, rows, doc_id, text, words, agree, percent)
    labelled = joined_by_size(rows.drop("sig"), labels, "ck")
    alone = F.concat(F.lit(b"empty"), F.hex("r1").cast("binary"), F.hex("r2").cast("binary"))
    group = F.when(F.col("n_shingles") == 0, alone).otherwise(
        F.coalesce(F.hex("label").cast("binary"), "ck")
    )
    labelled = labelled.withColumn("group", group)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "r1", "r2")
    labelled = freeze(labelled)
    first = labelled.groupBy("group").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    named = joined_by_size(labelled, freeze(first), "group")
    named = named.withColumn("component_id", F.col("first.doc_id"))
    stays = (F.col("first.r1") == F.col("r1")) & (F.col("first.r2") == F.col("r2"))
    return named.select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "r1", "r2", stays.alias("stays"),
    )


def joined_by_size(many: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join with ``facts``, one row a key that also counts the key's ``rows`` in ``many``.

    Keys with more rows than a quarter of an even share of a partition are broadcast: there are at
    most four a partition. The rest is joined by a shuffle in which no key is large.
    """
    share = max(64, many.count() // (4 * partitions(many)))
    large = F.broadcast(facts.filter(F.col("rows") > share).drop("rows"))
    small = facts.filter(F.col("rows") <= share).drop("rows")
    rest = many.join(large.select(key), key, "left_anti").join(small, key, "left")
    return many.join(large, key).unionByName(rest)


def class_labels(
    docs: DataFrame, rows: DataFrame, doc_id: str, text: str, words: int, agree: int, percent: int
) -> DataFrame:
    """ck, label, rows: one label for all classes of a group; classes without a partner are absent.

    Enough confirmed links are found to connect all that are alike.
    """
    # Copies have the same signature, so any one stands for its class, by its row's name.
    full = rows.filter("n_shingles > 0")
    classes = freeze(
        full.groupBy("ck").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.first(c).alias(c) for c in ("r1", "r2", "sig")],
        )
    )
    postings = classes.select("ck", F.explode("sig").alias("value"))
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = postings.join(counts, "value").groupBy("ck").agg(
        F.sort_array(F.collect_list(F.struct("c", "value"))).alias("shared")
    )
    prefix = F.slice("shared", 1, F.size("shared") - agree + 1)
    # Written, the numbers given here are fixed; they are shorter to carry than class keys.
    posted = freeze(
        shared.filter(F.size("shared") >= agree).select(
            F.monotonically_increasing_id().alias("node"), "ck", prefix["value"].alias("prefix"),
            F.aggregate("shared", F.lit(0).cast("long"), lambda s, x: s + x["c"]).alias("score"),
        )
    )
    wanted = posted.select("ck", "node").join(classes.select("ck", "r1", "r2"), "ck").drop("ck")
    sets = freeze(shingle_sets(docs, wanted, doc_id, text, words))

    # Every class with the most central of the centres of its lists.
    listed = posted.select("node", "score", F.explode("prefix").alias("value"))
    centre = listed.groupBy("value").agg(
        F.max(F.struct("score", "node")).alias("centre"), F.count(F.lit(1)).alias("n")
    )
    stars = (
        listed.join(centre.filter("n > 1"), "value")
        .filter(F.col("centre.node") != F.col("node"))
        .groupBy("node")
        .agg(F.max("centre").alias("centre"))
        .select(F.col("node").alias("a"), F.col("centre.node").alias("b"))
    )
    edges = freeze(confirmed(stars, sets, percent))
    # A centre is more central than what points to it, so pointers run without a circle. One step
    # along them is label enough for leaving out pairs inside a star.
    onward = edges.select(F.col("a").alias("b"), F.col("b").alias("c"))
    labels = freeze(
        edges.join(onward, "b", "left").select(
            F.col("a").alias("node"), F.coalesce("c", "b").alias("label")
        )
    )
    fresh = edges
    for least in fine_rounds(percent):
        pairs = between_groups(posted, labels, sets, least, percent)
        found = freeze(confirmed(pairs, sets, percent))
        labels = merged(labels, found if fresh is None else fresh.union(found))
        fresh = None  # the labels know these links from now on
    named = posted.select("ck", "node").join(labels, "node")
    return freeze(named.join(classes, "ck").select("ck", "label", "rows"))


def between_groups(
    posted: DataFrame, labels: DataFrame, sets: DataFrame, least: int, percent: int
) -> DataFrame:
    """Pairs (a, b) of different groups that share a list, agree enough and have sizes that fit."""
    grouped = posted.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "prefix"
    )
    listed = grouped.select("node", "label", "prefix", F.posexplode("prefix").alias("i", "value"))
    mixed = listed.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.filter("low != high").select("value")
    # What comes before in the prefix tells whether two classes have met in an earlier list.
    longs = [F.get("fine", F.lit(i)).alias(f"fine{i}") for i in range(FINE // 64)]
    sizes = sets.select("node", (F.octet_length("hashes") / 8).cast("int").alias("n"), *longs)
    rows = (
        listed.join(mixed, "value", "left_semi")
        .select("value", "node", "label", F.slice("prefix", F.lit(1), F.col("i")).alias("earlier"))
        .join(sizes, "node")
    )
    a, b = (
        rows.select("value", *[F.col(c).alias(f"{side}_{c}") for c in rows.columns if c != "value"])
        for side in ("a", "b")
    )
    fits = (
        (F.col("a_label") < F.col("b_label"))
        & (100 * F.col("a_n") >= percent * F.col("b_n"))
        & (100 * F.col("b_n") >= percent * F.col("a_n"))
        & (agreements("a_fine", "b_fine") >= least)
        & ~F.arrays_overlap("a_earlier", "b_earlier")
    )
    met = a.alias("x").join(b.alias("y"), (F.col("x.value") == F.col("y.value")) & fits)
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, with the columns it came with; of equal rows one stays."""
    staying = near_duplicates(docs, doc_id, text, **options).filter("stays").select("r1", "r2")
    named = docs.select(whole_row(docs), *_row_name(doc_id, text))
    once = named.join(staying.distinct(), ["r1", "r2"]).dropDuplicates(["r1", "r2"])
    return unpack_row(once, docs)
