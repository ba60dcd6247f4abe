"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import sys
import types
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space of all word rules: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\f\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """The words of a text in order; an empty array if it has none."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_RUN))


def count_words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, WHITE_RUN))).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; ``lower`` alone would change other letters too."""
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_chars(text: Column, chars: str) -> Column:
    """How often the given one-byte characters occur in all."""
    counts = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in chars]
    return reduce(lambda a, b: a + b, counts).cast("long")


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that no name of theirs can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpack_row(df: DataFrame, like: DataFrame, name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"`{name}`.`{c}`").alias(c) for c in like.columns])


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def worker_memory(name, make):
    """What ``make`` returns, kept in the Python worker over all its tasks that ask for ``name``.

    A worker keeps one such memory: asking for another one drops what was there.
    """
    place = "_tidemark_worker_memory"
    module = sys.modules.get(place)
    if module is None:
        module = sys.modules[place] = types.ModuleType(place)
        module.name = module.held = None
    if module.name != name:
        module.name = module.held = None
        module.held = make()
        module.name = name
    return module.held
