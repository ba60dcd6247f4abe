"""Packing by concatenation: all documents form one stream of ids, cut into fixed windows.

First pass: each partition encodes its documents, notes the running number of ids before each, and
writes ids and counts to the shared folder. The partitions' totals, one row each, are summed up to
the first global offset of every partition. Second pass: a document's global offset says which
windows it lies in; it is cut at their borders into boundary records. No row is shuffled. The last
window is the only one that is not full; it is padded, if its length is not a power of two.

Cases: a null text is an empty document, which still has its end id; null ids, equal rows and ties
need no order, as places come from the partition and the row's place in it; an empty table gives an
empty result; a text of any length is one row of the first pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_or_empty
from tidemark.llm.tokens import WordEncoder
from tidemark.session import freeze

WINDOW = 2048


def token_stream(
    docs: DataFrame, tokenizer: str, spaces: str | None, end_id: int | None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """part, doc_id, before (ids earlier in the partition), n, ids; not yet written.

    Ids are unsigned numbers of two bytes, or four if the vocabulary is larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of_worker(tokenizer, spaces)
        end = b"" if end_id is None else encoder.as_bytes([end_id])
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [x + end for x in encoder.encode(some.column(1).to_pylist())]
                counts = np.array([len(x) // encoder.size for x in ids], np.int64)
                ends = total + np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        some.column(0),
                        pa.array(ends - counts),
                        pa.array(counts),
                        pa.array(ids, pa.binary()),
                    ],
                    ["part", "doc_id", "before", "n", "ids"],
                )
                total = int(ends[-1])

    body = text_or_empty(text).alias("body")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), body)
    return rows.mapInArrow(run, "part int, doc_id long, before long, n long, ids binary")


def pack(
    docs: DataFrame, tokenizer: str, spaces: str | None = None, end_id: int | None = None,
    window: int = WINDOW, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, continues, ids.

    ``continues`` says that the document goes on in the next sequence.
    """
    stream = freeze(token_stream(docs, tokenizer, spaces, end_id, doc_id, text))
    totals = stream.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # One row per partition of the input, so the table is small at any size.
    rows = stream.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("first"), "n", "ids"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for doc, first, n, ids in zip(*columns):
                if n:
                    ids = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()
                start = 0
                while start < n:
                    place = (first + start) % window
                    length = min(window - place, n - start)
                    raw = ids[4 * start : 4 * (start + length)]
                    out.append(
                        (doc, start, length, zlib.crc32(raw), n, (first + start) // window, place,
                         start + length < n, raw if with_ids else None)
                    )
                    start += length
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), PIECES)], schema=PIECES
                )

    return rows.mapInArrow(run, PIECES_SQL)


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
        ("offset", pa.int64()), ("continues", pa.bool_()), ("ids", pa.binary()),
    ]
)
PIECES_SQL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, continues boolean, ids binary"
)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids (padded to the window or a power of two), borders.

    ``borders`` lists the offsets at which a piece begins. A group holds one window of ids.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), parts.alias("parts")
    )
    n = F.col("n_tokens")
    power = n.bitwiseAND(n - 1) == 0
    pad = F.when(power, 0).otherwise(window - n).cast("int")
    joined = F.concat(
        F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")),
        F.unhex(F.repeat(F.lit(np.array([pad_id], "<u4").tobytes().hex()), pad)),
    )
    return grouped.select(
        "sequence_id", "n_tokens", joined.alias("ids"),
        F.transform("parts", lambda p: p["offset"]).alias("borders"),
    )
