"""Chat formatting by perspective: each participant of a dialogue in turn is the assistant.

For every participant the whole dialogue is rendered once, with that speaker's turns as the
assistant's, all others as named users, and a mask: the character spans of the assistant's words,
with the mark that ends them. System turns stay system turns and have no perspective of their own.

A dialogue is cut into parts of 256 turns, in order; most have one. Turns are numbered without a
task that holds a long dialogue, and each turn is sent once per participant, so no group grows with
a dialogue. (A dialogue with n turns by m participants has n * m rendered turns; that is its result.)

Cases: a null dialogue id is one dialogue; turns are ordered by number (null last), then role and
text, so ties and equal rows have a defined order; a null role is the speaker ``unknown``; a null
text is empty; marks of the template inside a text get a space, so that no text can end its turn;
a dialogue of system turns only has no perspective; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import with_position

BEGIN, END = "<|im_start|>", "<|im_end|>"
PART = 256


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def turns_of(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, position, speaker, words; numbered from 0 in each dialogue."""
    rows = conversations.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").isNull().alias("last"),
        F.col(f"`{turn}`").alias("turn"),
        F.regexp_replace(F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("unknown")), "\\s", " ").alias("speaker"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("words"),
    )
    rows = rows.withColumns({"speaker": _clean(F.col("speaker")), "words": _clean(F.col("words"))})
    numbered = with_position(rows, keys=["conv"], order=["last", "turn", "speaker", "words"])
    return numbered.select("conv", "position", "speaker", "words")


def rotate(
    conversations: DataFrame, system: Sequence[str] = ("system",), part: int = PART, **columns: str
) -> DataFrame:
    """conv, perspective, part, n_turns, n_trained, text, mask (array of start, end).

    Starts and ends count characters from the beginning of the part.
    """
    turns = turns_of(conversations, **columns)
    instructs = F.lower("speaker").isin(*[s.lower() for s in system])
    people = turns.filter(~instructs).select("conv", F.col("speaker").alias("perspective")).distinct()
    people = people.withColumnRenamed("conv", "of")
    each = turns.join(people, F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    trained = F.col("speaker") == F.col("perspective")
    header = (
        F.when(instructs, F.lit("system"))
        .when(trained, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    )
    head = F.concat(F.lit(BEGIN), header, F.lit("\n"))
    each = each.select(
        "conv", "perspective", F.floor(F.col("position") / part).cast("long").alias("part"),
        F.struct(
            "position", trained.alias("trained"), F.char_length(head).alias("head"),
            F.concat(head, F.col("words"), F.lit(END + "\n")).alias("text"),
        ).alias("turn"),
    )
    grouped = each.groupBy("conv", "perspective", "part").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask")
    )

    def step(state: Column, x: Column) -> Column:
        after = state["at"] + F.char_length(x["text"])
        span = F.struct((state["at"] + x["head"]).alias("start"), (after - 1).alias("end"))
        return F.struct(
            after.alias("at"),
            F.when(x["trained"], F.concat(state["mask"], F.array(span)))
            .otherwise(state["mask"])
            .alias("mask"),
        )

    return grouped.select(
        "conv", "perspective", "part", F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda x: x["trained"])).cast("long").alias("n_trained"),
        F.array_join(F.transform("turns", lambda x: x["text"]), "").alias("text"),
        F.aggregate("turns", start, step, lambda s: s["mask"]).alias("mask"),
    )
