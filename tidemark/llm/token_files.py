"""Token ids in binary files: patched frame-of-reference blocks.

A stream of ids is cut into blocks of 128. From each block its minimum is subtracted; a percentile
of the bit widths of the rest is the block's width, at which the low bits of all values are packed.
Values that need more bits are exceptions: their place and high bits go to lists. A segment holds
the ids of whole documents, about 64k ids, in one byte string::

    "TMPF" | version, kinds of column... | per column: n values, n blocks, index of block starts,
    minima, widths, numbers of exceptions | packed bits | exception places | exception high bits

with the columns document id, null flag, number of ids, ids. Rows (shard, segment, first id in the
shard, counts, payload) are written by Spark's Parquet writer to any store it can write, so a lost
task is simply run again. Shards are ranges of the document id, segments follow in order.

Cases: a null text has the end id only; null document ids come first; equal ids are ordered by a
hash of the text; an empty table gives an empty file; a document is never split over segments, and
only one segment is held in memory.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.tokens import WordEncoder
from tidemark.session import shared_folder

BLOCK = 128
SEGMENT = 65_536
MAGIC = b"TMPF"
FILE_SCHEMA = "shard int, segment int, start long, n_docs int, n_ids long, payload binary"


def _width(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(values == 0, 0, np.frexp(values.astype(np.float64))[1]).astype(np.int64)


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks of values below 2**width as bytes: eight values fill ``width`` bytes."""
    groups = values.astype(np.uint64).reshape(len(values), BLOCK // 8, 8)
    out = np.zeros((len(values), BLOCK // 8, width), np.uint8)
    for k in range(8):
        first, shift = divmod(k * width, 8)
        moved = groups[:, :, k] << np.uint64(shift)
        for i in range((shift + width + 7) // 8):
            out[:, :, first + i] |= (moved >> np.uint64(8 * i)).astype(np.uint8)
    return out.reshape(len(values), -1)


def _unpack_bits(raw: np.ndarray, width: int) -> np.ndarray:
    groups = raw.reshape(len(raw), BLOCK // 8, width)
    out = np.empty((len(raw), BLOCK // 8, 8), np.uint64)
    for k in range(8):
        first, shift = divmod(k * width, 8)
        whole = groups[:, :, first].astype(np.uint64)
        for i in range(1, (shift + width + 7) // 8):
            whole |= groups[:, :, first + i].astype(np.uint64) << np.uint64(8 * i)
        out[:, :, k] = (whole >> np.uint64(shift)) & np.uint64(2**width - 1)
    return out.reshape(len(raw), BLOCK).astype(np.int64)


def pack(values: np.ndarray, percentile: float = 0.9) -> bytes:
    """One column of non-negative numbers below 2**52 as patched blocks."""
    values = np.asarray(values, dtype=np.int64)
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.concatenate([values, np.full(blocks * BLOCK - n, values[-1] if n else 0)])
    grid = padded.reshape(blocks, BLOCK).astype(np.int64)
    low = grid.min(axis=1) if blocks else np.zeros(0, np.int64)
    rest = grid - low[:, None]
    need = np.sort(_width(rest), axis=1)
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = need[:, at] if blocks else np.zeros(0, np.int64)
    high = rest >> width[:, None]
    where = np.nonzero(high)
    packed = [b""] * blocks
    for w in np.unique(width).tolist():
        same = np.flatnonzero(width == w)
        if w == 0:
            continue
        raw = _pack_bits(rest[same] & (2**w - 1), w)
        for i, b in zip(same.tolist(), raw):
            packed[i] = b.tobytes()
    starts = np.concatenate([[0], np.cumsum(width * (BLOCK // 8))]).astype("<u4")
    odd = np.bincount(where[0], minlength=blocks).astype("<u1")
    return b"".join(
        [
            struct.pack("<II", n, blocks),
            starts.tobytes(),
            low.astype("<i8").tobytes(),
            width.astype("<u1").tobytes(),
            odd.tobytes(),
            *packed,
            where[1].astype("<u1").tobytes(),
            high[where].astype("<u8").tobytes(),
        ]
    )


def unpack(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The column that starts at byte ``at``, and where it ends."""
    n, blocks = struct.unpack_from("<II", data, at)
    at += 8

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    starts = take("<u4", blocks + 1)
    low, width, odd = take("<i8", blocks), take("<u1", blocks), take("<u1", blocks)
    packed = take("<u1", int(starts[-1]))
    rest = np.zeros((blocks, BLOCK), np.int64)
    for w in np.unique(width).tolist():
        if w == 0:
            continue
        same = np.flatnonzero(width == w)
        span = np.arange(BLOCK * w // 8)
        raw = packed[starts[same].astype(np.int64)[:, None] + span]
        rest[same] = _unpack_bits(raw, w)
    total = int(odd.sum())
    place, high = take("<u1", total), take("<u8", total)
    block = np.repeat(np.arange(blocks), odd)
    rest[block, place] |= high.astype(np.int64) << width[block].astype(np.int64)
    return (rest + low[:, None]).reshape(-1)[:n], at


def _column_end(data: bytes, at: int) -> int:
    """Where the column that starts at ``at`` ends, from its header alone."""
    _, blocks = struct.unpack_from("<II", data, at)
    (packed,) = struct.unpack_from("<I", data, at + 8 + 4 * blocks)
    odd = np.frombuffer(data, "<u1", blocks, at + 8 + 4 * (blocks + 1) + 9 * blocks)
    return at + 8 + 4 * (blocks + 1) + 10 * blocks + packed + 9 * int(odd.sum())


def unpack_range(data: bytes, at: int, first: int, end: int) -> np.ndarray:
    """Values ``first`` to ``end`` of the column that starts at ``at``.

    The index of block starts leads to the blocks that hold them; no other block is read.
    """
    n, blocks = struct.unpack_from("<II", data, at)
    first, end = max(0, first), min(n, end)
    if first >= end:
        return np.zeros(0, np.int64)
    low_block, high_block = first // BLOCK, -(-end // BLOCK)
    many = high_block - low_block
    at += 8
    starts = np.frombuffer(data, "<u4", many + 1, at + 4 * low_block).astype(np.int64)
    (packed,) = struct.unpack_from("<I", data, at + 4 * blocks)
    at += 4 * (blocks + 1)
    low = np.frombuffer(data, "<i8", many, at + 8 * low_block)
    width = np.frombuffer(data, "<u1", many, at + 8 * blocks + low_block)
    odd = np.frombuffer(data, "<u1", blocks, at + 9 * blocks)
    at += 10 * blocks
    rest = np.zeros((many, BLOCK), np.int64)
    for w in np.unique(width).tolist():
        if w:
            same = np.flatnonzero(width == w)
            size = BLOCK * w // 8
            raw = np.stack([np.frombuffer(data, "<u1", size, at + int(starts[i])) for i in same])
            rest[same] = _unpack_bits(raw, w)
    # Exceptions lie one after the other, so those of earlier blocks are counted and passed over.
    earlier, mine = int(odd[:low_block].sum()), odd[low_block:high_block]
    total, own = int(odd.sum()), int(mine.sum())
    place = np.frombuffer(data, "<u1", own, at + packed + earlier)
    high = np.frombuffer(data, "<u8", own, at + packed + total + 8 * earlier)
    block = np.repeat(np.arange(many), mine)
    rest[block, place] |= high.astype(np.int64) << width[block].astype(np.int64)
    values = (rest + low[:, None]).reshape(-1)
    return values[first - low_block * BLOCK : end - low_block * BLOCK]


def encode_segment(doc_ids: list[int | None], ids: list[bytes], kind: str = "<u4") -> bytes:
    """Ids of documents are stored as their difference to the smallest, in two halves."""
    nulls = np.array([d is None for d in doc_ids], np.int64)
    known = np.array([0 if d is None else d for d in doc_ids], np.int64).view(np.uint64)
    counts = np.array([len(x) // int(kind[-1]) for x in ids], np.int64)
    stream = np.frombuffer(b"".join(ids), kind)
    halves = [(known >> np.uint64(32)).astype(np.int64), (known & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    return MAGIC + b"".join(pack(c) for c in (nulls, *halves, counts, stream))


def decode_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, all ids."""
    if data[:4] != MAGIC:
        raise ValueError("Not a segment of token ids.")
    at, columns = 4, []
    for _ in range(5):
        column, at = unpack(data, at)
        columns.append(column)
    nulls, upper, lower, counts, stream = columns
    known = ((upper.astype(np.uint64) << np.uint64(32)) | lower.astype(np.uint64)).view(np.int64)
    doc_ids = [None if n else d for n, d in zip(nulls.tolist(), known.tolist())]
    return doc_ids, counts, stream


def _encoder_task(path: str, spaces: str | None, end_id: int | None):
    names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of_worker(path, spaces)
        end = b"" if end_id is None else encoder.as_bytes([end_id])
        shard, segment, start = TaskContext.get().partitionId(), 0, 0
        docs, held, count = [], [], 0

        def flush() -> pa.RecordBatch:
            row = [shard, segment, start, len(docs), count, encode_segment(docs, held, encoder.kind)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = encoder.encode(part.column(1).to_pylist())
                for doc, found in zip(part.column(0).to_pylist(), ids):
                    docs.append(doc)
                    held.append(found + end)
                    count += len(held[-1]) // encoder.size
                    if count >= SEGMENT:
                        yield flush()
                        segment, start = segment + 1, start + count
                        docs, held, count = [], [], 0
        if docs:
            yield flush()

    return run


def write_token_files(
    docs: DataFrame,
    out: str,
    tokenizer: str,
    spaces: str | None = None,
    end_id: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Writes the ids of all documents in ascending order of their id."""
    body = text_or_empty(text)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body.alias("body"))
    keyed = rows.select("doc_id", "body", F.xxhash64("body").alias("h"))
    ordered = keyed.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "h"
    )
    task = _encoder_task(tokenizer, spaces, end_id)
    ordered.select("doc_id", "body").mapInArrow(task, FILE_SCHEMA).write.parquet(out)


def read_token_files(spark, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids.

    Ids are little-endian numbers of 32 bits; they can be left out.

    Shards are few (one per task that wrote), so their first ids are broadcast; segments know their
    place in the shard.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.join(F.broadcast(bases), "shard").select(
        (F.col("base") + F.col("start")).alias("start"), "payload"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc_ids, counts, stream = decode_segment(payload)
                ends = np.cumsum(counts)
                raw = stream.astype("<u4").tobytes()
                cuts = list(zip((4 * (ends - counts)).tolist(), (4 * ends).tolist()))
                each = [raw[a:b] for a, b in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(first + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        pa.array(each if with_ids else [None] * len(each), pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def read_ids(spark, path: str, first: int, end: int) -> DataFrame:
    """start, ids: the ids at places ``first`` to ``end`` of the whole stream, in pieces.

    Only segments that hold some of them are read, and of these only the blocks that do. Places
    beyond the stream are left out.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = F.col("base") + F.col("start")
    rows = files.join(F.broadcast(bases), "shard").select(place.alias("at"), "n_ids", "payload")
    held = rows.filter((F.col("at") < end) & (F.col("at") + F.col("n_ids") > first)).select("at", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                column = len(MAGIC)
                for _ in range(4):
                    column = _column_end(payload, column)
                from_ = max(0, first - at)
                ids = unpack_range(payload, column, from_, end - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at + from_]), pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["start", "ids"]
                )

    return held.mapInArrow(run, "start long, ids binary")


def token_file_folder(spark) -> str:
    """A new place in the shared folder."""
    import uuid

    return f"{shared_folder(spark)}/tidemark/tokens-{uuid.uuid4().hex}"
