"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training progress from 0 to 1, linear between knots. Its
integral is the source's weight: it sets the share of all words, with no target above
``max_repeats`` times the source's size and the excess reshared by weight. The running integral is
the source's cumulative demand. A document's place in its source (a shuffled order by hash,
repeated epoch by epoch) is an amount of demand, and the inverted demand curve turns that amount
into a training position. Sorting by position interleaves the sources as their schedules say.

No task holds a source: places are running sums in two steps, over sqrt(n) buckets of about sqrt(n)
documents each. What is as long as the number of sources is one row per source.

Cases: a null source is a source, last in order; a null or empty text has size 0 and is not taken;
rows equal in all but place share a hash and are interchangeable; an empty table gives an empty
table; a source without words has target 0. A copy is taken if its middle lies before the target,
so a source is off its target by half a document at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import count_words, text_or_empty, unpack_row
from tidemark.session import freeze

#: Weights of the sources in code point order, repeated.
WEIGHTS = (5.0, 2.0, 1.0)
#: For each weight the knots (progress, multiple of the weight); every curve has integral 1.
CURVES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)
MAX_REPEATS = 3


def sized(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``row`` (the carried columns), ``source``, ``size`` in words, and ``key``, a hash of id and text."""
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))
    return docs.select(
        *row,
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        count_words(text_or_empty(text)).alias("size"),
        F.md5(F.concat(name, F.lit("|"), text_or_empty(text)).cast("binary")).alias("key"),
    )


def area(knots: Sequence[tuple[float, float]]) -> float:
    """The integral of a piecewise linear curve."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))


def source_targets(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    curves: Sequence[Sequence[tuple[float, float]]] = CURVES,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """One row per source: n_docs, source_size, rank (from 0), weight, target.

    Targets are min(cap, level * weight): sources are taken in the order of cap over weight, and the
    level follows from the first source whose cap is not reached.
    """
    totals = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    )
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    table = F.array(*[F.lit(float(w) * area(c)) for w, c in zip(weights, curves)])
    ranked = ranked.withColumn("weight", F.get(table, F.pmod("rank", F.lit(len(weights)))))
    cap = F.lit(max_repeats) * F.col("source_size")
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("cap", cap.cast("double"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("used", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(onward))
        # The level if this source and all after it stay under their caps.
        .withColumn("free", F.col("weight") * (F.col("total") - F.col("used")) / F.col("left"))
        .withColumn("open", F.col("free") <= F.col("cap"))
    )
    first = F.min(F.when(F.col("open"), F.struct("cap_rank", "used", "left"))).over(
        Window.partitionBy()
    )
    filled = filled.withColumn("cap_rank", F.row_number().over(order)).withColumn("first", first)
    level = F.col("weight") * (F.col("total") - F.col("first.used")) / F.col("first.left")
    target = F.when(F.col("cap_rank") < F.col("first.cap_rank"), F.col("cap")).otherwise(level)
    return filled.select(
        "source", "n_docs", "source_size", "rank", "weight",
        F.coalesce(target, F.col("cap")).alias("target"),
    )


def inverse(amount: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Progress at which the curve's integral reaches ``amount`` of its whole; beyond 1 it goes on."""
    whole = area(knots)
    result, done = 1.0 + (amount - 1.0), 0.0
    steps = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        part = (t1 - t0) * (w0 + w1) / 2
        slope = (w1 - w0) / (t1 - t0)
        rest = amount * whole - done
        if slope == 0:
            at = F.lit(t0) + rest / w0
        else:
            at = F.lit(t0) + (F.sqrt(F.greatest(w0 * w0 + 2 * slope * rest, F.lit(0.0))) - w0) / slope
        steps.append((done + part, at))
        done += part
    for upto, at in reversed(steps):
        result = F.when(amount * whole <= upto, at).otherwise(result)
    return result


def places(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds the source's numbers and ``before``: words of its documents earlier in the hash order."""
    head = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    buckets = F.greatest(F.ceil(F.sqrt(F.col("n_docs").cast("double"))), F.lit(1))
    s = sources.withColumnRenamed("source", "s_source")
    joined = (
        rows.join(s, F.col("source").eqNullSafe(F.col("s_source")))
        .withColumn("bucket", F.floor(head * buckets / F.lit(float(2**32))))
        .drop("s_source")
    )
    totals = joined.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        "rank", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id")
    within = inside.rowsBetween(Window.unboundedPreceding, -1)
    return joined.join(base, ["rank", "bucket"]).withColumn(
        "before", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )


def curriculum(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    curves: Sequence[Sequence[tuple[float, float]]] = CURVES,
    max_repeats: int = MAX_REPEATS,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Adds ``copies`` and ``positions``, one per copy; ``positions[0]`` also where nothing is taken."""
    narrow = (stats if stats is not None else rows).select("source", "size")
    sources = freeze(source_targets(narrow, weights, curves, max_repeats))
    placed = places(rows, sources)
    room = 2 * F.col("target") - 2 * F.col("before") - F.col("size")
    epochs = F.floor(room / (2 * F.col("source_size"))) + 1
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(max_repeats), epochs))
    )
    placed = placed.withColumn("copies", copies.cast("int"))
    shown = F.sequence(F.lit(0), F.greatest(F.col("copies"), F.lit(1)) - 1)
    curve = F.pmod("rank", F.lit(len(weights)))

    def at(epoch: Column) -> Column:
        amount = F.when(
            F.col("target") > 0,
            (epoch * F.col("source_size") + F.col("before")) / F.col("target"),
        ).otherwise(F.lit(2.0))
        chosen = inverse(amount, curves[0])
        for k in range(1, len(curves)):
            chosen = F.when(curve == k, inverse(amount, curves[k])).otherwise(chosen)
        return chosen

    return placed.withColumn("positions", F.transform(shown, at))


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options
) -> DataFrame:
    """The documents in training order, a document as often as the mix takes it."""
    rows = sized(docs, doc_id, source, text, carry=docs.columns)
    stats = sized(docs, doc_id, source, text)
    taken = curriculum(rows, stats=stats, **options).filter("copies > 0")
    copies = taken.select("row", F.explode("positions").alias("position"), "key")
    ordered = copies.repartitionByRange("position", "key").sortWithinPartitions("position", "key")
    return unpack_row(ordered, docs)


def mix_plan(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **options
) -> DataFrame:
    """Per document: size, source_size, target, taken (words, repeats counted), first position."""
    rows = freeze(sized(docs, doc_id, source, text))
    plan = curriculum(rows, **options).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        F.get("positions", F.lit(0)).alias("position"), "key",
    )
    ordered = plan.repartitionByRange("position", "key").sortWithinPartitions("position", "key")
    return ordered.drop("key")
