"""Queries on sources, alignment and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import values
from tidemark.operators import align, clean, profile
from tidemark.plans.ingest import aligned_dataset
from tidemark.queries import fixtures
from tidemark.queries.fixtures import (
    DAILY_SQL,
    HOURLY_SQL,
    MACRO_SQL,
    WEEKDAY_SQL,
    daily_bars,
    hourly_bars,
    macro_long,
    table,
    weekday_bars,
)
from tidemark.queries.registry import num, nums, query, tidy, when
from tidemark.session import setting
from tidemark.sources import bars as bar_source
from tidemark.sources.bars import FIELDS
from tidemark.sources.macro import fetch_macro

BARS_OUT = f'series_id, {when()}, ordinal, {nums(*FIELDS)}'
SERIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("bars_daily", f"WITH {DAILY_SQL} SELECT {BARS_OUT} FROM bars")
def bars_daily(spark, folder):
    return tidy(daily_bars(spark, folder))


@query("bars_hourly", f"WITH {HOURLY_SQL} SELECT {BARS_OUT} FROM bars")
def bars_hourly(spark, folder):
    return tidy(hourly_bars(spark, folder))


@query(
    "bars_weekly_volume",
    f"""SELECT o_orderstatus AS series_id, {when("date_trunc('week', o_orderdate)", "ts")},
        max(o_orderkey)::BIGINT AS ordinal,
        {num('arg_min(o_totalprice, o_orderkey)', 'Open')}, {num('max(o_totalprice)', 'High')},
        {num('min(o_totalprice)', 'Low')}, {num('arg_max(o_totalprice, o_orderkey)', 'Close')},
        {num('sum(o_custkey)', 'Volume')}
        FROM orders GROUP BY o_orderstatus, date_trunc('week', o_orderdate)""",
)
def bars_weekly_volume(spark, folder):
    return tidy(
        bar_source.bars_from_ticks(
            table(spark, folder, "orders"),
            series="o_orderstatus",
            ts="o_orderdate",
            price="o_totalprice",
            order=["o_orderkey"],
            volume="o_custkey",
            interval="1wk",
        )
    )


@query(
    "history_of_one_series",
    f"""WITH {DAILY_SQL} SELECT {BARS_OUT} FROM bars
        WHERE series_id = '5-LOW' AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1998-01-01'""",
)
def history_of_one_series(spark, folder):
    return tidy(
        bar_source.fetch_history(
            daily_bars(spark, folder, "1996-01-01", "1998-01-01"), "5-LOW", "1996-01-01", "1998-01-01"
        )
    )


@query(
    "bars_long",
    f"""WITH {DAILY_SQL}, x AS (UNPIVOT bars ON "Open", "High", "Low", "Close", "Volume"
          INTO NAME field VALUE "value")
        SELECT series_id, {when()}, field, {num('"value"', 'value')},
               field || '_' || series_id AS name FROM x""",
)
def bars_long(spark, folder):
    return tidy(bar_source.to_long(daily_bars(spark, folder)))


@query(
    "bars_wide",
    f"""WITH {DAILY_SQL} SELECT {when()}, """
    + ", ".join(
        num(f'max("{field}") FILTER (WHERE series_id = \'{s}\')', f"{field}_{s}")
        for field in ("Close", "Volume")
        for s in SERIES
    )
    + " FROM bars GROUP BY bars.ts",
)
def bars_wide(spark, folder):
    return tidy(bar_source.to_wide(daily_bars(spark, folder), SERIES, ("Close", "Volume")))


@query(
    "times_to_utc",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS read_as_utc,
       strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS read_as_local FROM events""",
)
def times_to_utc(spark, folder):
    ts = F.col("ts")
    return tidy(
        table(spark, folder, "events").select(
            "event_id",
            values.to_utc(ts).alias("read_as_utc"),
            values.to_utc(ts, "GMT-5").alias("read_as_local"),
        )
    )


@query(
    "macro_wide",
    f"WITH {MACRO_SQL} SELECT {when()}, {nums('macro_a', 'macro_n', 'macro_r')} FROM macro_wide",
)
def macro_wide(spark, folder):
    return tidy(_macro(spark, folder))


JOINED_SQL = f"""{DAILY_SQL}, {MACRO_SQL},
joined AS (SELECT b.*, macro_a, macro_n, macro_r
           FROM bars b LEFT JOIN macro_wide m ON b.ts = m.ts)"""
MACRO_NAMES = ("macro_a", "macro_n", "macro_r")
JOINED_OUT = f"{BARS_OUT}, {nums(*MACRO_NAMES)}"


@query("macro_left_join", f"WITH {JOINED_SQL} SELECT {JOINED_OUT} FROM joined")
def macro_left_join(spark, folder):
    return tidy(align.attach_macro(daily_bars(spark, folder), _macro(spark, folder)))


@query("macro_join_over_salts", f"WITH {JOINED_SQL} SELECT {JOINED_OUT} FROM joined")
def macro_join_over_salts(spark, folder):
    """The same join by the way taken when the macro table is too large to broadcast."""
    macro = _macro(spark, folder)
    with setting(spark, "spark.tidemark.broadcastRows", "0"):
        joined = align.attach_macro(daily_bars(spark, folder), macro)
    return tidy(joined)


@query(
    "macro_join_on_date",
    f"""WITH {HOURLY_SQL}, {MACRO_SQL}, day AS (
          SELECT ts::DATE + 8400 AS d, arg_max("value", ts) AS macro_day
          FROM macro WHERE macro_id <> 'macro_n' GROUP BY 1)
        SELECT {BARS_OUT}, {num('macro_day')} FROM bars LEFT JOIN day ON bars.ts::DATE = d""",
)
def macro_join_on_date(spark, folder):
    """Two observations of most days, at midnight and at noon: the later one counts."""
    shifted = (
        macro_long(spark, folder)
        .filter(F.col("macro_id") != "macro_n")
        .select(
            F.lit("macro_day").alias("macro_id"),
            (F.col("ts") + F.expr("INTERVAL 8400 DAYS")).alias("ts"),
            "value",
        )
    )
    macro = fetch_macro(shifted, ["macro_day"])
    return tidy(align.attach_macro(hourly_bars(spark, folder), macro, on="date"))


def _fill_sql(first: str, second: str) -> str:
    windows = {
        "forward": "last_value({c} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts, ordinal"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "backward": "first_value({c} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts, ordinal"
        " ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)",
    }
    return ", ".join(
        num(f"coalesce({windows[first].format(c=c)}, {windows[second].format(c=c)})", c)
        for c in MACRO_NAMES
    )


@query(
    "macro_ffill_bfill",
    f"WITH {JOINED_SQL} SELECT {BARS_OUT}, {_fill_sql('forward', 'backward')} FROM joined",
)
def macro_ffill_bfill(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return tidy(align.fill_macro(joined, MACRO_NAMES, "ffill"))


@query(
    "macro_bfill_ffill",
    f"WITH {JOINED_SQL} SELECT {BARS_OUT}, {_fill_sql('backward', 'forward')} FROM joined",
)
def macro_bfill_ffill(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return tidy(align.fill_macro(joined, MACRO_NAMES, "bfill"))


@query(
    "macro_fill_in_blocks",
    f"WITH {JOINED_SQL} SELECT {BARS_OUT}, {_fill_sql('forward', 'backward')} FROM joined",
)
def macro_fill_in_blocks(spark, folder):
    """The same fills by the way taken for long series, with small blocks."""
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    with small_blocks(spark):
        return tidy(align.fill_macro(joined, MACRO_NAMES, "ffill"))


@query(
    "clean_ingest",
    f"""WITH {JOINED_SQL}, filled AS (SELECT series_id, ts, ordinal, "Open", "High", "Low",
          "Close", "Volume", {_fill_sql('forward', 'backward')} FROM joined)
        SELECT {BARS_OUT}, {nums('macro_a', 'macro_n')} FROM filled
        WHERE "Open" IS NOT NULL AND "High" IS NOT NULL AND "Low" IS NOT NULL
          AND "Close" IS NOT NULL AND "Volume" IS NOT NULL""",
)
def clean_ingest(spark, folder):
    """Join, fill, drop the macro column that never matches, drop incomplete bars, cast."""
    return tidy(aligned_dataset(daily_bars(spark, folder), _macro(spark, folder)))


DEDUP_SQL = """SELECT o_orderpriority AS series_id, {when}, o_orderkey AS ordinal, {price}
  FROM orders QUALIFY row_number() OVER (
    PARTITION BY o_orderpriority, o_orderdate ORDER BY o_orderkey {way}) = 1"""


def _ticks(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("ordinal"),
        F.col("o_totalprice").alias("price"),
    )


_DEDUP_OUT = {"when": when("o_orderdate", "ts"), "price": num("o_totalprice", "price")}


@query("dedup_last", DEDUP_SQL.format(way="DESC", **_DEDUP_OUT))
def dedup_last(spark, folder):
    return tidy(clean.keep_one_per_key(_ticks(spark, folder), "last"))


@query("dedup_first", DEDUP_SQL.format(way="ASC", **_DEDUP_OUT))
def dedup_first(spark, folder):
    return tidy(clean.keep_one_per_key(_ticks(spark, folder), "first"))


@query(
    "impose_fitted_columns",
    f"""WITH {DAILY_SQL} SELECT series_id, {when()}, {nums('Volume')}, 0.0::DOUBLE AS gone,
        {nums('Close')} FROM bars""",
)
def impose_fitted_columns(spark, folder):
    return tidy(
        clean.impose_columns(
            daily_bars(spark, folder), ["Volume", "gone", "Close"], ["series_id", "ts"]
        )
    )


@query(
    "fill_missing_values",
    f"""WITH {JOINED_SQL} SELECT series_id, {when()}, {num('coalesce(macro_a, 0)', 'macro_a')},
        {num('coalesce(macro_n, 0)', 'macro_n')}, {num('coalesce(macro_r, 0)', 'macro_r')}
        FROM joined""",
)
def fill_missing_values(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return tidy(clean.fill_missing(joined).select("series_id", "ts", *MACRO_NAMES))


@query(
    "drop_incomplete_rows",
    f"""WITH {JOINED_SQL} SELECT series_id, {when()}, {nums('Close', 'macro_n')}
        FROM joined WHERE macro_n IS NOT NULL AND "Close" IS NOT NULL""",
)
def drop_incomplete_rows(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    kept = clean.drop_rows_with_nulls(joined, ["Close", "macro_n"])
    return tidy(kept.select("series_id", "ts", "Close", "macro_n"))


@query(
    "null_profile",
    f"""WITH {JOINED_SQL}, x AS (SELECT """
    + ", ".join(f'count(*) - count("{c}") AS "{c}"' for c in (*FIELDS, *MACRO_NAMES))
    + """ FROM joined) SELECT "column", nulls::BIGINT AS nulls FROM (
           UNPIVOT x ON COLUMNS(*) INTO NAME "column" VALUE nulls)""",
)
def null_profile(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return tidy(profile.null_counts(joined, (*FIELDS, *MACRO_NAMES)))


@query(
    "completeness",
    f"""WITH {JOINED_SQL}, x AS (SELECT """
    + ", ".join(f'count("{c}") AS "{c}"' for c in (*FIELDS, *MACRO_NAMES))
    + """ FROM joined) SELECT "column", 'double' AS type, n::BIGINT AS "values" FROM (
           UNPIVOT x ON COLUMNS(*) INTO NAME "column" VALUE n)""",
)
def completeness(spark, folder):
    joined = align.attach_macro(daily_bars(spark, folder), _macro(spark, folder))
    return tidy(profile.completeness(joined, (*FIELDS, *MACRO_NAMES)))


@query(
    "range_profile",
    f"""WITH t AS (SELECT o_orderpriority AS series_id, o_orderdate AS ts,
          o_orderdate < lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS f
          FROM orders)
        SELECT series_id, {when('min(ts)', 'first_ts')}, {when('max(ts)', 'last_ts')},
          count(*)::BIGINT AS "rows", count(DISTINCT ts)::BIGINT AS distinct_ts,
          NOT coalesce(bool_or(f), false) AS is_monotonic FROM t GROUP BY 1""",
)
def range_profile(spark, folder):
    return tidy(profile.range_profile(_ticks(spark, folder)))


FREQUENCY_SQL = """, g AS (
  SELECT series_id, epoch(ts - lag(ts) OVER (PARTITION BY series_id ORDER BY ts))::BIGINT AS gap,
         isodow(ts) AS d FROM {bars})
SELECT series_id, CASE WHEN min(gap) = max(gap) THEN min(gap)::VARCHAR
  WHEN bool_and(d <= 5 AND gap = CASE WHEN d = 1 THEN 259200 ELSE 86400 END) THEN 'B' END
  AS frequency FROM g WHERE gap IS NOT NULL GROUP BY 1"""


@query("infer_frequency", f"WITH {HOURLY_SQL}" + FREQUENCY_SQL.format(bars="bars"))
def infer_frequency(spark, folder):
    return tidy(profile.infer_frequency(hourly_bars(spark, folder)))


@query("infer_weekday_frequency", f"WITH {WEEKDAY_SQL}" + FREQUENCY_SQL.format(bars="weekday_bars"))
def infer_weekday_frequency(spark, folder):
    return tidy(profile.infer_frequency(weekday_bars(spark, folder)))


MISSING_SQL = f"""WITH {DAILY_SQL}, c AS (
  SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts
  FROM bars GROUP BY 1),
m AS (SELECT series_id, strftime(ts, '%Y-%m-%d') AS day FROM c ANTI JOIN bars USING (series_id, ts))
SELECT series_id, day FROM m"""


@query("missing_days", MISSING_SQL)
def missing_days(spark, folder):
    return tidy(profile.missing_days(daily_bars(spark, folder)))


@query("first_missing_days", MISSING_SQL + " ORDER BY day, series_id LIMIT 10")
def first_missing_days(spark, folder):
    gaps = profile.missing_days(daily_bars(spark, folder))
    return tidy(gaps.orderBy("day", "series_id").limit(10))


@query(
    "ingest_summary",
    f"""WITH {DAILY_SQL} SELECT count(*)::BIGINT AS "rows",
        strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS first_ts,
        strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_ts FROM bars""",
)
def ingest_summary(spark, folder):
    return tidy(profile.ingest_summary(daily_bars(spark, folder)))


@query("head_of_bars", f"WITH {DAILY_SQL} SELECT {BARS_OUT} FROM bars ORDER BY bars.ts, ordinal LIMIT 5")
def head_of_bars(spark, folder):
    return tidy(profile.first_rows(daily_bars(spark, folder)))


@query(
    "tail_sample",
    f"""WITH {DAILY_SQL}, t AS (SELECT * FROM bars ORDER BY ts DESC, ordinal DESC LIMIT 50)
        SELECT {BARS_OUT} FROM t ORDER BY t.ts, ordinal LIMIT 5""",
)
def tail_sample(spark, folder):
    """The first five of the last fifty bars."""
    return tidy(profile.first_rows(profile.last_rows(daily_bars(spark, folder), 50)))


@query(
    "latest_bar",
    f"""WITH {DAILY_SQL} SELECT series_id, {when()}, ordinal, {nums('Close')} FROM bars
        QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY bars.ts DESC, ordinal DESC) = 1""",
)
def latest_bar(spark, folder):
    return tidy(profile.latest_row(daily_bars(spark, folder), ["Close"]))


def _business_day_sql(ts: str, n: int) -> str:
    """Another way than the library's: number the weekdays since a Monday, add, convert back."""
    days = f"(({ts})::DATE - DATE '1900-01-01')"
    roll = f"least({days} % 7, 4)" if n > 0 else f"CASE WHEN {days} % 7 > 4 THEN 5 ELSE {days} % 7 END"
    number = f"(({days} // 7) * 5 + ({roll}) + ({n}))"
    day = f"(DATE '1900-01-01' + (({number} // 5) * 7 + {number} % 5)::INTEGER)"
    return f"strftime({day} + ({ts} - date_trunc('day', {ts})), '%Y-%m-%d %H:%M:%S')"


@query(
    "business_day_offset",
    "SELECT event_id, "
    + ", ".join(
        f"{_business_day_sql('ts', n)} AS {name}"
        for n, name in ((20, "plus_20"), (-60, "minus_60"), (1, "plus_1"), (-1, "minus_1"))
    )
    + " FROM events",
)
def business_day_offset(spark, folder):
    ts = F.col("ts").cast("timestamp")
    return tidy(
        table(spark, folder, "events").select(
            "event_id",
            values.business_day_offset(ts, 20).alias("plus_20"),
            values.business_day_offset(ts, -60).alias("minus_60"),
            values.business_day_offset(ts, 1).alias("plus_1"),
            values.business_day_offset(ts, -1).alias("minus_1"),
        )
    )


@query(
    "largest_integer_in_text",
    r"""SELECT doc_id, list_max([try_cast(x AS DECIMAL(38,0))
        FOR x IN regexp_extract_all("text", '\d+')])::VARCHAR AS largest FROM documents""",
)
def largest_integer_in_text(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", values.largest_integer(F.col("text")).cast("string").alias("largest")
    )


@query(
    "numbers_for_output",
    """SELECT event_id, try_cast(regexp_extract(props, '\\d+') AS DOUBLE) AS k,
       CASE WHEN isnan(ln_value) THEN NULL ELSE ln_value END AS ln_value FROM (
       SELECT event_id, props, round(CASE WHEN "value" > 0 THEN ln("value") END, 6) AS ln_value
       FROM events)""",
)
def numbers_for_output(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        values.number_or_null(F.regexp_extract("props", r"\d+", 0)).alias("k"),
        F.round(values.natural_log(F.col("value")), 6).alias("ln_value"),
    )


def small_blocks(spark, rows: int = 400):
    """Lets the way for long series run on series of any length."""
    return setting(spark, "spark.tidemark.blockRows", str(rows))


def _macro(spark, folder):
    return fetch_macro(macro_long(spark, folder), list(fixtures.MACROS.values()))
