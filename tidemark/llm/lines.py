"""Line dedup: lines found in many documents are dropped, or kept at their first occurrence only.

A line's key is the line without white space at its ends, A-Z lower-cased, held as a 128-bit hash.
First an aggregate that combines before its shuffle finds the keys with enough occurrences; the
other keys cannot matter. The occurrences of those are range-partitioned by hash, with a second
sort by document and position inside, and streamed in that order: a row opens a document where its
document differs from the row before. A hash is dealt over slices of documents, next to each other
in the range order, so that a very frequent line does not stay in one task. The result per document
is a bitmap of kept lines in run-length form, not text; the text is cut only when asked for.

Cases: a null text is one empty line, like an empty text; rows equal in id and text count as one
document; null ids are ids like any other; an empty table gives an empty table; a very long text is
held by one row only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WHITE,
    ascii_lower,
    partitions,
    text_or_empty,
    whole_row,
)
from tidemark.session import freeze

KEY = ["k1", "k2"]
DOC = ["d1", "d2"]


def _document(doc_id: str, text: str) -> list[Column]:
    """A 128-bit name of a row: of its id and its whole text."""
    body, name = text_or_empty(text), F.col(f"`{doc_id}`")
    return [F.xxhash64(name, body).alias("d1"), F.xxhash64(body, F.lit(1), name).alias("d2")]


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """d1, d2, pos, k1, k2 of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select(
        *_document(doc_id, text), F.posexplode(F.split(text_or_empty(text), "\n")).alias("pos", "line")
    )
    keyed = lines.select(*DOC, "pos", ascii_lower(F.btrim("line", F.lit(WHITE))).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        *DOC, "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")
    )


def occurrences(
    docs: DataFrame, doc_id: str, text: str, min_docs: int, min_chars: int
) -> DataFrame:
    """Occurrences of keys with ``min_docs`` or more, streamed in (key, document, position) order.

    ``opens`` marks the first occurrence of the key in a document.
    """
    lines = line_keys(docs, doc_id, text, min_chars)
    often = freeze(lines.groupBy(*KEY).count().filter(F.col("count") >= min_docs).select(*KEY))
    slices = 4 * partitions(docs)
    # The key is dealt over slices of documents; slices of a rare key lie side by side anyway.
    ranged = (
        lines.join(often, KEY)
        .withColumn("slice", F.pmod("d1", F.lit(slices)))
        .repartitionByRange(*KEY, "slice")
        .sortWithinPartitions(*KEY, "slice", *DOC, "pos")
    )
    stream = Window.partitionBy(*KEY, "slice").orderBy(*DOC, "pos")
    before = F.lag(F.struct(*DOC)).over(stream)
    return freeze(ranged.withColumn("opens", ~F.struct(*DOC).eqNullSafe(before)).drop("slice"))


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """d1, d2 and ``dropped``: the sorted positions of dropped lines; documents with none are absent.

    Keys found in at least ``min_docs`` documents lose all their lines, or with ``keep_first`` all
    but one line of one document.
    """
    rows = occurrences(docs, doc_id, text, min_docs, min_chars)
    spread = rows.groupBy(*KEY).agg(
        F.sum(F.col("opens").cast("long")).alias("n_docs"),
        F.min(F.struct(*DOC, "pos")).alias("first"),
    )
    frequent = freeze(spread.filter(F.col("n_docs") >= min_docs).select(*KEY, "first"))
    lost = rows.join(frequent, KEY)
    if keep_first:
        lost = lost.filter(F.struct(*DOC, "pos") != F.col("first"))
    return lost.groupBy(*DOC).agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row``, ``n_lines``, ``n_dropped``, ``keep_runs`` (null: all) and ``kept_text``."""
    named = docs.select(whole_row(docs), *_document(doc_id, text), text_or_empty(text).alias("body"))
    joined = named.join(bitmaps, DOC, "left").withColumn("lines", F.split("body", "\n"))
    edges = F.concat(F.array(F.lit(-1)), F.col("dropped"), F.array(F.size("lines")))
    joined = joined.withColumn("edges", F.when(F.col("dropped").isNotNull(), edges))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("edges") - 1),
        lambda i: F.struct(
            (F.get("edges", i - 1) + 1).alias("start"),
            (F.get("edges", i) - F.get("edges", i - 1) - 1).alias("length"),
        ),
    )
    runs = F.when(F.col("edges").isNotNull(), F.filter(runs, lambda r: r["length"] > 0))
    joined = joined.withColumn("keep_runs", runs)
    pieces = F.flatten(
        F.transform("keep_runs", lambda r: F.slice("lines", r["start"] + 1, r["length"]))
    )
    return joined.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        "keep_runs",
        F.when(F.col("keep_runs").isNull(), F.col("body"))
        .otherwise(F.array_join(pieces, "\n"))
        .alias("kept_text"),
    )


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
) -> DataFrame:
    """Every document with its bitmap and kept text; see ``apply_bitmaps``."""
    bitmaps = keep_bitmaps(docs, doc_id, text, min_docs, min_chars, keep_first)
    return apply_bitmaps(docs, bitmaps, doc_id, text)


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with the kept text in place of the text; a null text stays null."""
    cut = dedup_lines(docs, doc_id, text, **options)
    value = F.when(F.col(f"row.`{text}`").isNotNull(), F.col("kept_text"))
    return cut.select(
        *[(value if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )
