"""Rolling mean and deviation in time that does not depend on the length of the window.

A plain frame goes over all its rows again for every row. Here each series is cut into blocks as long
as the window. A window that ends in a block is the end of the block before and the start of its own,
so two running statistics are enough: from a block's start to each row, and from each row to the
block's end. Count, mean and square sum about the mean are merged pairwise, without subtracting
large sums, so values far from zero keep their digits. The statistics of the earlier part stand
``size - 1`` rows back, one lag for each window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators.ordered import KEYS, ORDER, POSITION, over_rows

#: Rows of a window from which this costs less than a plain frame.
LONG = 64

_PLACE, _PART = "_roll_place", "_roll_part"


def with_long_windows(
    part: DataFrame, target: str, sizes: Sequence[int], min_periods: int | None = None,
    keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
) -> DataFrame:
    """Adds rolling mean and sample deviation of ``target`` for each size.

    ``part`` is a part that ``for_each_part`` hands out: rows of long series are numbered already.
    """
    if not sizes:
        return part
    if POSITION in part.columns:
        placed = part.withColumn(_PLACE, F.col(POSITION))
    else:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
        placed = part.withColumn(_PLACE, number.cast("long"))
    for size in sizes:
        placed = _with_window(placed, target, size, min_periods, keys)
    return placed.drop(_PLACE)


def _with_window(
    placed: DataFrame, target: str, size: int, min_periods: int | None, keys: Sequence[str]
) -> DataFrame:
    needed = size if min_periods is None else names.positive("min_periods", min_periods)
    block = Window.partitionBy(*keys, _PART)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # To the end of the block: the reversed order, so that this frame grows as well.
    ahead = block.orderBy(F.col(_PLACE).desc()).rowsBetween(*so_far)
    past = block.orderBy(_PLACE).rowsBetween(*so_far)
    columns = placed.columns
    cut = placed.withColumn(_PART, F.floor(F.col(_PLACE) / size))
    # Statistics are of differences from the least value of the block, which keep their digits.
    least = F.min(target).over(block)
    centre = F.when(F.abs(least) < float("inf"), least).otherwise(F.lit(0.0))
    cut = cut.select("*", centre.cast("double").alias("_roll_centre"))
    cut = cut.withColumn("_roll_value", F.col(target) - F.col("_roll_centre"))
    cut = cut.select("*", _statistics(ahead).alias("_roll_after"))
    cut = cut.select("*", _statistics(past).alias("_roll_own")).drop("_roll_value")
    # Places rise with blocks, so this order is the one the rows are in already.
    both = over_rows(
        cut,
        lambda window: [F.lag("_roll_after", size - 1).over(window).alias("_roll_before")],
        before=size - 1,
        keys=keys,
        order=[_PART, _PLACE],
    )
    # The last row of a block has the whole window in its own block.
    before = F.when(F.col(_PLACE) % size != size - 1, F.col("_roll_before"))
    merged = _merged(before, F.col("_roll_own"))
    enough = F.when(merged["n"] >= needed, merged)
    deviation = F.when(enough["n"] > 1, F.sqrt(enough["squares"] / (enough["n"] - 1)))
    return both.select(
        *columns,
        enough["mean"].alias(names.mean_name(target, size)),
        deviation.alias(names.deviation_name(target, size)),
    )


def _statistics(frame) -> Column:
    n = F.count("_roll_value").over(frame)
    return F.struct(
        n.cast("double").alias("n"),
        F.avg("_roll_value").over(frame).alias("mean"),
        (F.var_pop("_roll_value").over(frame) * n).alias("squares"),
        F.col("_roll_centre").alias("centre"),
    )


def _merged(a: Column, b: Column) -> Column:
    """The statistics of two sets of values; one without values has a count of 0 or is null."""
    a_n, b_n = (F.coalesce(x["n"], F.lit(0.0)) for x in (a, b))
    total = a_n + b_n
    apart = (b["mean"] - a["mean"]) + (b["centre"] - a["centre"])
    mean = (
        F.when(a_n == 0, b["centre"] + b["mean"])
        .when(b_n == 0, a["centre"] + a["mean"])
        .otherwise(a["centre"] + (a["mean"] + apart * b_n / total))
    )
    squares = (
        F.when(a_n == 0, b["squares"])
        .when(b_n == 0, a["squares"])
        .otherwise(a["squares"] + b["squares"] + apart * apart * a_n * b_n / total)
    )
    return F.struct(total.alias("n"), mean.alias("mean"), squares.alias("squares"))
