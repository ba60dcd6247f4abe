"""Bars and macro series derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.bars import bars_from_ticks

MACROS = {"A": "macro_a", "N": "macro_n", "R": "macro_r"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def daily_bars(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """One series per order priority; the order key says which order came first."""
    return bars_from_ticks(
        table(spark, folder, "orders"),
        series="o_orderpriority",
        ts="o_orderdate",
        price="o_totalprice",
        order=["o_orderkey"],
        start=start,
        end=end,
    )


def weekday_bars(spark: SparkSession, folder: str) -> DataFrame:
    return daily_bars(spark, folder).filter(F.weekday("ts") < 5)


def hourly_bars(spark: SparkSession, folder: str) -> DataFrame:
    return bars_from_ticks(
        table(spark, folder, "events"),
        series="event_type",
        ts="ts",
        price="value",
        order=["ts", "event_id"],
        interval="1h",
    )


def macro_long(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a flag make one series, with gaps of its own.

    Flag A is observed on every day at midnight, flag N at the end of each quarter (so the first
    bars lie before its first value), flag R at noon (so it meets no daily bar).
    """
    flag = F.col("l_returnflag")
    day = F.date_trunc("day", F.col("l_shipdate").cast("timestamp"))
    quarter_end = F.date_trunc("quarter", day) + F.expr("INTERVAL 3 MONTHS") - F.expr("INTERVAL 1 DAY")
    moment = F.when(flag == "A", day).when(flag == "N", quarter_end)
    names = F.create_map(*[F.lit(v) for pair in MACROS.items() for v in pair])
    return (
        table(spark, folder, "lineitem")
        .select(
            names[flag].alias("macro_id"),
            moment.otherwise(day + F.expr("INTERVAL 12 HOURS")).alias("ts"),
            "l_extendedprice",
        )
        .groupBy("macro_id", "ts")
        .agg(F.max("l_extendedprice").alias("value"))
    )


DAILY_SQL = """
bars AS (
  SELECT o_orderpriority AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts,
         max(o_orderkey)::BIGINT AS ordinal,
         arg_min(o_totalprice, o_orderkey) AS "Open", max(o_totalprice) AS "High",
         min(o_totalprice) AS "Low", arg_max(o_totalprice, o_orderkey) AS "Close",
         count(*)::DOUBLE AS "Volume"
  FROM orders GROUP BY 1, 2)"""

WEEKDAY_SQL = DAILY_SQL + """,
weekday_bars AS (SELECT * FROM bars WHERE isodow(ts) <= 5)"""

HOURLY_SQL = """
bars AS (
  SELECT event_type AS series_id, date_trunc('hour', ts)::TIMESTAMP AS ts,
         max(event_id)::BIGINT AS ordinal,
         arg_min("value", (ts, event_id)) AS "Open", max("value") AS "High",
         min("value") AS "Low", arg_max("value", (ts, event_id)) AS "Close",
         count(*)::DOUBLE AS "Volume"
  FROM events GROUP BY 1, 2)"""

MACRO_SQL = """
macro AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'macro_a' WHEN 'N' THEN 'macro_n' ELSE 'macro_r' END
           AS macro_id,
         CASE l_returnflag WHEN 'A' THEN date_trunc('day', l_shipdate)
           WHEN 'N' THEN date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY
           ELSE date_trunc('day', l_shipdate) + INTERVAL 12 HOUR END::TIMESTAMP AS ts,
         max(l_extendedprice) AS "value"
  FROM lineitem GROUP BY 1, 2),
macro_wide AS (
  SELECT ts, max("value") FILTER (WHERE macro_id = 'macro_a') AS macro_a,
         max("value") FILTER (WHERE macro_id = 'macro_n') AS macro_n,
         max("value") FILTER (WHERE macro_id = 'macro_r') AS macro_r
  FROM macro GROUP BY 1)"""
