"""Row-order work (lag, lead, rolling, fill, position) over series of any length.

A window partitioned by series puts one series into one task. That is the best
plan while a series is short, and the wrong one when it holds a large share of all
rows. So each operator here first asks for the number of rows in a group:

* groups within the limit are left to the plain window (one shuffle, one sort);
* longer groups are range-partitioned on (keys, order), which splits each of them
  over many tasks, and numbered. Numbered rows are cut into blocks of a fixed number
  of rows; the few rows a frame reaches across a block edge are copied into the
  neighbour block, and the copies are dropped afterwards.

Both ways give the same result. The numbered rows are written to the shared
folder, because the block of a row must not change when a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import block_rows, fits_broadcast, freeze

SERIES = "series_id"
TIME = "ts"
KEYS = (SERIES,)
ORDER = (TIME, "ordinal")
BOUND = "tidemark.rows_per_series"
MEASURED = "tidemark.measured_rows"

POSITION, ROWS = "_pos", "_rows"
_PART, _RID, _BLOCK, _HOME = "_part", "_rid", "_block", "_home"


def declare_rows_per_series(
    df: DataFrame, rows: int, keys: Sequence[str] = KEYS, note: str = BOUND
) -> DataFrame:
    """Records on the time column how many rows a group of ``keys`` can hold at most."""
    metadata = dict(df.schema[TIME].metadata or {})
    metadata[note] = {**metadata.get(note, {}), ",".join(keys): int(rows)}
    return df.withMetadata(TIME, metadata)


def declared_rows(df: DataFrame, keys: Sequence[str], note: str = BOUND) -> int | None:
    """The smallest declared bound; one for fewer keys holds for more keys as well."""
    if TIME not in df.columns:
        return None
    bounds = (df.schema[TIME].metadata or {}).get(note, {})
    known = [rows for name, rows in bounds.items() if set(name.split(",")) <= set(keys)]
    return min(known, default=None)


def rows_per_group(df: DataFrame, keys: Sequence[str]) -> int:
    """The largest group, from one aggregate that reads the key columns only."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def is_long(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a group may exceed a block. Counts the rows only if no note settles it."""
    if POSITION in df.columns:
        return True
    limit = block_rows(df.sparkSession)
    bound = declared_rows(df, keys)
    if bound is not None and bound <= limit:
        return False
    measured = declared_rows(df, keys, MEASURED)
    return (rows_per_group(df, keys) if measured is None else measured) > limit


def measure(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Notes the length of the longest group, unless what is noted already will do."""
    if not keys or TIME not in df.columns or declared_rows(df, keys, MEASURED) is not None:
        return df
    bound = declared_rows(df, keys)
    if bound is not None and bound <= block_rows(df.sparkSession):
        return df
    return declare_rows_per_series(df, rows_per_group(df, keys), keys, MEASURED)


def for_each_part(
    df: DataFrame,
    function: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Applies ``function`` to the rows of short groups and to those of long ones.

    Inside the function the operators of this module know which part they got, and
    neither count nor number it again. It must not drop rows before it uses them.
    """
    parts = _parts_by_length(df, keys, order)
    results = [function(part) for part in parts]
    if POSITION not in df.columns:
        results = [result.drop(POSITION, ROWS) for result in results]
    return reduce(DataFrame.unionByName, results)


def _parts_by_length(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[DataFrame]:
    """The whole table if no group is long; else the numbered long groups, and the others."""
    if POSITION in df.columns or not is_long(df, keys):
        return [df]
    if not keys:
        return [_numbered(df, keys, order, df.count())]
    limit = block_rows(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    long_groups = freeze(counts)
    rows = long_groups.agg(F.sum("_n")).first()[0] or 0
    named = long_groups.select(*[F.col(c).alias(f"_on_{c}") for c in keys])
    if fits_broadcast(named):
        named = F.broadcast(named)
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in keys]
    short = df.join(named, same, "left_anti")
    if TIME in df.columns:
        short = declare_rows_per_series(short, limit, keys)
    # The union takes its notes from the first part, so the long one comes first.
    return [_numbered(df.join(named, same, "left_semi"), keys, order, rows), short]


def over_rows(
    df: DataFrame,
    build: Callable[[WindowSpec], Sequence[Column]],
    *,
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Adds the columns ``build(window)`` returns.

    They may look at most ``before`` rows back and ``after`` rows ahead.
    """

    def add(part: DataFrame) -> DataFrame:
        if POSITION in part.columns:
            return _over_blocks(part, build, before, after, keys)
        return part.select("*", *build(Window.partitionBy(*keys).orderBy(*order)))

    return for_each_part(df, add, keys, order)


def _cut(df: DataFrame) -> int:
    """Rows per block: well below the limit, so that the blocks of one group spread evenly."""
    return max(1, block_rows(df.sparkSession) // 8)


def _over_blocks(numbered, build, before, after, keys) -> DataFrame:
    size = max(_cut(numbered), before, after)
    offset = F.col(POSITION) % size
    home = F.col(_HOME)
    copies = F.array_compact(
        F.array(
            home,
            F.when(offset >= size - before, home + 1),
            F.when((offset < after) & (home > 0), home - 1),
        )
    )
    blocks = numbered.withColumn(_HOME, F.floor(F.col(POSITION) / size)).withColumn(
        _BLOCK, F.explode(copies)
    )
    window = Window.partitionBy(*keys, _BLOCK).orderBy(POSITION)
    added = blocks.select("*", *build(window))
    return added.filter(F.col(_BLOCK) == F.col(_HOME)).drop(_HOME, _BLOCK)


def with_position(
    df: DataFrame, *, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER
) -> DataFrame:
    """Adds ``position``, counted from 0 in each group, and ``rows``, the size of the group."""

    def add(part: DataFrame) -> DataFrame:
        if POSITION in part.columns:
            return part.withColumnsRenamed({POSITION: "position", ROWS: "rows"})
        group = Window.partitionBy(*keys)
        return part.select(
            "*",
            (F.row_number().over(group.orderBy(*order)) - 1).cast("long").alias("position"),
            F.count(F.lit(1)).over(group).alias("rows"),
        )

    # Rows may be gone since the table was numbered, so old numbers do not count.
    return for_each_part(df.drop(POSITION, ROWS), add, keys, order)


def with_fills(
    df: DataFrame,
    columns: Sequence[str],
    *,
    forward: bool = True,
    backward: bool = False,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Adds ``<c>__forward`` (last value so far) and ``<c>__backward`` (next value)."""
    if not columns:
        return df

    def add(part: DataFrame) -> DataFrame:
        if POSITION in part.columns:
            return _fills_by_block(part, columns, forward, backward, keys)
        return _fills(part, columns, forward, backward, Window.partitionBy(*keys), order)

    return for_each_part(df, add, keys, order)


def _fills(df, columns, forward, backward, group, order) -> DataFrame:
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # The backward fill reads the reversed order: a frame that ends at the last
    # row of the group would be evaluated anew for every row.
    ahead = group.orderBy(*[F.col(c).desc() for c in order]).rowsBetween(*so_far)
    past = group.orderBy(*order).rowsBetween(*so_far)
    for wanted, window, side in ((backward, ahead, "backward"), (forward, past, "forward")):
        if wanted:
            filled = [
                F.last(c, ignorenulls=True).over(window).alias(f"{c}__{side}") for c in columns
            ]
            df = df.select("*", *filled)
    return df


def _fills_by_block(numbered, columns, forward, backward, keys) -> DataFrame:
    size = _cut(numbered)
    blocks = numbered.withColumn(_BLOCK, F.floor(F.col(POSITION) / size))

    edges = []
    for c in columns:
        place = F.when(F.col(c).isNotNull(), F.col(POSITION))
        edges.append(F.max_by(c, place).alias(f"{c}__last"))
        edges.append(F.min_by(c, place).alias(f"{c}__first"))
    per_block = blocks.groupBy(*keys, _BLOCK).agg(*edges)

    # One row per block and group: the values that cross the block's edges.
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = group.orderBy(F.col(_BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    crossing = []
    for c in columns:
        before = F.last(f"{c}__last", ignorenulls=True).over(earlier)
        after = F.last(f"{c}__first", ignorenulls=True).over(later)
        crossing += [before.alias(f"{c}__from_forward"), after.alias(f"{c}__from_backward")]
    crossings = per_block.select(*keys, _BLOCK, *crossing)

    inside = _fills(
        blocks, columns, forward, backward, Window.partitionBy(*keys, _BLOCK), [POSITION]
    )
    sides = [side for side, wanted in (("forward", forward), ("backward", backward)) if wanted]
    filled = _attach(inside, crossings, [*keys, _BLOCK]).withColumns(
        {
            f"{c}__{side}": F.coalesce(f"{c}__{side}", f"{c}__from_{side}")
            for c in columns
            for side in sides
        }
    )
    added = [f"{c}__{side}" for side in sides for c in columns]
    return filled.select(*numbered.columns, *added)


def _numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int
) -> DataFrame:
    """Positions without a task that holds a whole series.

    Range partitions are contiguous in (keys, order), so a position is the rows of
    the series in earlier partitions plus the place inside the own partition.
    """
    spark = df.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffles, -(-total // block_rows(spark)))
    ranged = (
        df.repartitionByRange(parts, *[F.col(c) for c in (*keys, *order)])
        .sortWithinPartitions(*keys, *order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_RID, F.monotonically_increasing_id())
    )
    frozen = freeze(ranged)
    pieces = frozen.groupBy(*keys, _PART).agg(
        F.count(F.lit(1)).alias("_in_part"), F.min(_RID).alias("_first_rid")
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        *keys,
        _PART,
        "_first_rid",
        F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_in_part").over(group).alias(ROWS),
    )
    return (
        _attach(frozen, starts, [*keys, _PART])
        .withColumn(POSITION, F.col("_start") + F.col(_RID) - F.col("_first_rid"))
        .drop(_PART, _RID, "_first_rid", "_start")
    )


def _attach(rows: DataFrame, extra: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where a null key equals a null key."""
    renamed = extra.withColumnsRenamed({c: f"_on_{c}" for c in on})
    condition = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return rows.join(renamed, condition).drop(*[f"_on_{c}" for c in on])
