"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    hard_negatives,
    licenses,
    lines,
    mixing,
    near_dups,
    packing,
    pii,
    quality,
    runs,
    secrets,
    token_files,
    top_k,
)
from tidemark.llm.common import split_words, text_or_empty
from tidemark.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, folder, "documents"))
    return cut.select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )


def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, folder, "embeddings"))


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judge(table(spark, folder, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(
        "row.doc_id", *[F.col(c).cast("long").alias(c) for c in counts], "base_failed", "kept"
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = token_files.token_file_folder(spark)
    token_files.write_token_files(
        table(spark, folder, "documents"), out, tokenizer("word_bpe_49k.json"), "drop", end_id=2
    )
    return token_files.read_token_files(spark, out, with_ids=False).drop("ids")


def op7_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dups.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), "lead", end_id=1,
        with_ids=False,
    )
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_private(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_private(table(spark, folder, "documents"))
    kinds = F.col("base.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, F.lit(k)))).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    found = chat.rotate(table(spark, folder, "conversations"))
    mask = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return found.select(
        F.col("conv").alias("conv_id"), "perspective", "part", "n_turns", "n_trained", "text",
        F.array_join(mask, ",").alias("mask"),
    )


def op11_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    counts = [
        F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in secrets.KINDS[:3]
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", other))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents as the query wants them: in a tenth of them the end of the text repeats.

    With h the check sum of the id and g = h / 10, where h % 10 = 0 the words from place a = g % n on
    are replaced by the first p of them, over and over; p = 1 + (n - a) / (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = docs.withColumn("h", F.coalesce(h, F.lit(1)))
    words = split_words(F.when(F.col("h") % 10 == 0, text_or_empty()))
    planted = planted.withColumn("words", words).withColumn("n", F.size("words"))
    planted = planted.withColumn("g", F.floor(F.col("h") / 10))
    planted = planted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    planted = planted.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int")))
    body = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    changed = F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), body)
    return planted.select(
        *[F.coalesce(changed, "text").alias(c) if c == "text" else c for c in docs.columns]
    )


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = runs.find_runs(with_planted_periods(docs))
    best = runs.strongest(F.col("runs"))
    one = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = found.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(F.transform("runs", one), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    times = F.expr("1000 * best.length div best.period")
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        times.alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_top_k": op3_top_k,
    "op4_licenses": op4_licenses,
    "op5_quality": op5_quality,
    "op6_token_files": op6_token_files,
    "op7_near_dups": op7_near_dups,
    "op8_packing": op8_packing,
    "op9_private": op9_private,
    "op10_chat": op10_chat,
    "op11_secrets": op11_secrets,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_runs": op13_runs,
}
