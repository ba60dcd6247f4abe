"""Quality rules: a threshold table compiled into one projection of built-in functions.

Per document the counts are made natively: words, characters in words, symbols, repeated lines,
words in repeated five-word windows, stop words. A rule names a ratio of two counts and the range
it must lie in; all rules together are one boolean expression.

Cases: a null or empty text has no words and fails the base rule; null ids and other columns pass
through; equal rows are judged alike; an empty table gives an empty table. Cost per document is
linear in its length, and n log n where windows repeat. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WHITE,
    count_chars,
    split_words,
    text_or_empty,
    unpack_row,
    whole_row,
)

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was with as by are this be from at or an "
    "der die das und in zu den von mit ist im nicht ein eine auf für sich des dem "
    "le la les de des et en un une du que dans pour qui sur par au est "
    "el la los las de que y en un una por con se del al es para no"
).split()


@dataclass(frozen=True)
class Rule:
    """``per * numerator`` over ``denominator`` must lie in [low, high]; a zero denominator passes.

    The rule holds for documents of at least ``from_words`` words.
    """

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None, 25),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def with_counts(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: ``row`` (all its columns) and the counts the rules refer to."""
    base = docs.select(whole_row(docs), text_or_empty(text).alias("body"))
    white = count_chars(F.col("body"), WHITE)
    symbols = count_chars(F.col("body"), SYMBOLS)
    lines = F.filter(F.split("body", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    words = base.select(
        "row",
        (F.char_length("body") - white).alias("word_chars"),
        symbols.alias("n_symbols"),
        lines.alias("lines"),
        split_words(F.col("body")).alias("words"),
    )
    stop = F.array(*[F.lit(w) for w in sorted({*STOP_WORDS})])
    hashed = words.select(
        "row",
        "word_chars",
        "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("words").alias("n_words"),
        F.size(F.filter("words", lambda w: F.array_contains(stop, F.lower(w)))).alias(
            "n_stop_words"
        ),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.when(
        F.size("hashes") >= window,
        F.transform(
            F.sequence(F.lit(0), F.size("hashes") - window),
            lambda i: F.struct(
                F.xxhash64(*[F.get("hashes", i + k) for k in range(window)]).alias("h"),
                i.alias("i"),
            ),
        ),
    )
    keyed = hashed.withColumn("windows", windows).drop("hashes")
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct(F.col("windows.h"))) < F.size("windows")
    keyed = keyed.withColumn("sorted", F.when(repeats, F.sort_array("windows"))).drop("windows")

    def again(x: Column, i: Column) -> Column:
        other = [F.get("sorted", i + 1)["h"] == x["h"], F.get("sorted", i - 1)["h"] == x["h"]]
        return reduce(lambda a, b: a | b, [F.coalesce(o, F.lit(False)) for o in other])

    starts = F.sort_array(F.filter("sorted", again)["i"])
    keyed = keyed.withColumn("starts", starts).drop("sorted")
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("starts") - 1),
        F.lit(window),
        lambda sum_, k: sum_
        + F.least(F.lit(window), F.get("starts", k) - F.get("starts", k - 1)),
    )
    return keyed.withColumn(
        "n_repeat_words", F.when(F.size("starts") > 1, covered).otherwise(F.lit(0))
    ).drop("starts")


def passes(rule: Rule) -> Column:
    """The rule as an expression over the counts, written without division."""
    count, of = F.col(rule.numerator), F.col(rule.denominator)
    tests = [F.lit(True)]
    if rule.low is not None:
        tests.append(count >= F.lit(rule.low) * of)
    if rule.high is not None:
        tests.append(count <= F.lit(rule.high) * of)
    inside = reduce(lambda a, b: a & b, tests)
    return (F.col("n_words") < rule.from_words) | (of == 0) | inside


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    min_words: int = 10,
    max_repeat_percent: int = 20,
) -> DataFrame:
    """``row``, the counts, ``base_failed``, ``broken`` (names of broken rules) and ``kept``."""
    counted = with_counts(docs, text)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    broken = F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    # A filter on a plain expression would be pushed below all the counts and copy them over and
    # over; one on a value that depends on the row's place is not.
    here = F.monotonically_increasing_id() >= 0
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("broken", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0) & here)
    )


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return unpack_row(judge(docs, text, rules).filter("kept"), docs)
