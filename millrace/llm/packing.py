"""Concatenate and cut: documents' token ids into fixed windows, with boundary records.

Pass one encodes every document once and writes its ids with the input partition, the ids before it there and its
length to the shared folder. The partitions' totals (a row for each) give each partition its global offset by a prefix
sum. Pass two turns each document into pieces, cut where a window ends. No row is shuffled.

Defined results: a null or empty text has the end id alone; a null doc_id stays null; repeated rows are packed as often
as they occur; an empty table gives no pieces; other columns are ignored; a text of any length is cut into as many
pieces as it needs. Every sequence but the last is full, so only the last needs padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, ship
from .tokens import encoder, is_narrow, offer, slices

WINDOW = 4096
END_ID = 2


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, part, before (ids before the document in its part), n, width (bytes of an id), ids; in shared storage."""
    ship(docs.sparkSession)
    offer(docs.sparkSession, tokenizer)
    narrow = is_narrow(tokenizer, end_id)
    width = 2 if narrow else 4
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("n", T.LongType()), T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())])
    end = int(end_id).to_bytes(width, "little")

    def run(batches):
        encode = encoder(tokenizer, narrow).encode
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in slices(batch):
                rows = batch.slice(a, b - a)
                ids = [x + end for x in encode([t or "" for t in rows.column("text").to_pylist()])]
                n = np.array([len(x) // width for x in ids], np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), pa.array(np.full(len(n), width, np.int32)), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "before", "n", "width", "ids"],
                )

    return cut(docs.select("doc_id", "text").mapInArrow(run, schema), "packing-ids")


def offsets(ids: DataFrame) -> DataFrame:
    """part and base, the ids in all parts before it: a prefix sum over a row for each input partition."""
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    ship(docs.sparkSession)
    ids = tokenized(docs, tokenizer, end_id)
    placed = ids.join(F.broadcast(offsets(ids)), "part").select("doc_id", "n", "width", "ids", (F.col("base") + F.col("before")).alias("at"))
    longs = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in longs]] + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches):
        for batch in batches:
            n, at = batch.column("n").to_numpy(), batch.column("at").to_numpy()
            first, last = at // window, (at + n - 1) // window
            many = last - first + 1
            row = np.repeat(np.arange(len(n)), many)
            seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            low = np.maximum(seq * window, at[row])
            high = np.minimum((seq + 1) * window, (at + n)[row])
            start, length = low - at[row], high - low
            kinds = {2: "<u2", 4: "<u4"}
            column, widths = batch.column("ids"), batch.column("width").to_numpy()
            pieces, crc, seen, whole = [], np.empty(len(row), np.int64), -1, None
            for i, r in enumerate(row):
                if r != seen:
                    whole, seen = np.frombuffer(column[int(r)].as_buffer(), kinds[int(widths[r])]).astype("<u4"), r
                piece = whole[start[i] : start[i] + length[i]].tobytes()
                crc[i] = zlib.crc32(piece)
                if with_ids:
                    pieces.append(piece)
            arrays = [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc), pa.array(n[row]), pa.array(seq), pa.array(low - seq * window)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(pieces, pa.binary())] * with_ids, names=schema.names)

    return placed.mapInArrow(run, schema)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed sequences of ``pack(..., with_ids=True)``: sequence_id, ids (binary, padded to ``window``), n_ids, boundaries.

    boundaries is an array of (offset, length, doc_id, start). A group holds one window's ids. A last sequence whose
    length is a power of two stays unpadded.
    """
    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("p"))
    n = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(window - n).cast("int")))
    return grouped.select(
        "sequence_id",
        F.concat(joined, pad).alias("ids"),
        n.alias("n_ids"),
        F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["length"].alias("length"), x["doc_id"].alias("doc_id"), x["start"].alias("start"))).alias("boundaries"),
    )
