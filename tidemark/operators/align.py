"""Macro series aligned to bars: exact match on time, then filled along each series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import KEYS, ORDER, with_fills
from tidemark.session import fits_broadcast


def attach_macro(bars: DataFrame, macro: DataFrame, on: str = "timestamp") -> DataFrame:
    """Left join on equal time; with ``on='date'`` an intraday bar matches its day's value.

    Of several observations of a day the last value counts. An observation without a bar at the same time is lost, not carried forward.
    A small macro table is broadcast; a larger one is spread over salts, because one
    moment may hold a large share of the bars.
    """
    if on not in ("timestamp", "date"):
        raise ValueError(f"on must be 'timestamp' or 'date', not {on!r}.")
    columns = [c for c in macro.columns if c != "ts"]
    moment = F.col("ts") if on == "timestamp" else F.to_date("ts")
    keyed = macro.select(moment.alias("_at"), *columns)
    if on == "date":
        when = {c: F.when(F.col(c).isNotNull(), F.col("ts")) for c in columns}
        keyed = macro.groupBy(moment.alias("_at")).agg(
            *[F.max_by(c, when[c]).alias(c) for c in columns]
        )
    left = bars.withColumn("_at", moment)
    if fits_broadcast(keyed):
        return left.join(F.broadcast(keyed), "_at", "left").drop("_at")
    # As many salts as tasks: one moment may then be spread over all of them.
    salts = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("series_id", "ordinal"), F.lit(salts))
    spread = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(spread, ["_at", "_salt"], "left").drop("_at", "_salt")


def fill_macro(df: DataFrame, columns, policy: str | None = "ffill") -> DataFrame:
    """Fills along each series in both directions; the policy says which one comes first.

    ``bfill`` (or ``backfill``) prefers the next value, ``nearest`` the one closer in time, of two
    equally close ones the earlier, everything else the last one. Either way leading gaps take a later
    value, so early rows see the future.
    """
    policy = {"pad": "ffill", "backfill": "bfill"}.get(policy, policy)
    if policy not in ("ffill", "bfill", "nearest", None):
        options = ["ffill", "pad", "bfill", "backfill", "nearest", None]
        raise ValueError(f"Unknown fill policy {policy!r}. Options: {options}")
    if policy == "nearest":
        return _fill_nearest(df, list(columns))
    filled = with_fills(df, list(columns), backward=True, keys=KEYS, order=ORDER)
    first, second = ("backward", "forward") if policy == "bfill" else ("forward", "backward")
    wanted = set(columns)
    return filled.select(
        *[
            F.coalesce(f"{c}__{first}", f"{c}__{second}").alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )


def _fill_nearest(df: DataFrame, columns) -> DataFrame:
    """A value travels with the time it was seen at, so that the closer of two neighbours is known."""
    seen = {c: F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.unix_micros("ts").alias("at"), F.col(f"`{c}`").alias("v")))
            for c in columns}
    held = df.select("*", *[value.alias(f"{c}__seen") for c, value in seen.items()])
    filled = with_fills(held, [f"{c}__seen" for c in columns], backward=True, keys=KEYS, order=ORDER)
    now = F.unix_micros("ts")

    def nearest(c: str):
        last, following = F.col(f"{c}__seen__forward"), F.col(f"{c}__seen__backward")
        closer = following["at"] - now < now - last["at"]
        return F.when(last.isNull() | closer, following["v"]).otherwise(last["v"]).alias(c)

    return filled.select(*[nearest(c) if c in seen else F.col(f"`{c}`") for c in df.columns])
