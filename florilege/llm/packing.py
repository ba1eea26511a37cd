"""Training sequences of power-of-two lengths, none of which crosses a document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.shingles import tidy
from florilege.llm.tokens import ended_documents, vocabulary

SEQUENCE_TOKENS = 4096


def binary_pieces(counts: np.ndarray, longest: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of ``counts`` tokens cut into powers of two, the largest first: document number, start and length of each piece."""
    whole = counts // longest
    powers = longest >> np.arange(1, longest.bit_length())  # the powers below the longest
    bits = (counts[:, None] & powers[None, :]) > 0
    n = whole + bits.sum(1)
    doc = np.repeat(np.arange(len(counts)), n)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    length = np.full(len(doc), longest, np.int64)
    small = rank >= np.repeat(whole, n)
    length[small] = np.broadcast_to(powers, bits.shape)[bits]
    ends = np.cumsum(length)
    start = ends - length - np.repeat(np.cumsum(counts) - counts, n)
    return doc, start, length


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 2, longest: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Binary decomposition: every document's ids, its ``end_id`` included, are cut into pieces of power-of-two lengths up
    to ``longest``. A piece is a sequence by itself, so no sequence crosses documents and none is padded; sequences of
    one ``length`` form a bucket, from which a trainer draws equal-length batches.

    A row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` (0), and
    ``ids`` if asked for. ``sequence_id`` joins the number of the input partition and a running number in it: unique,
    and the same when a task is repeated. Needs no shuffle. Null text is the empty text: one piece that holds the end
    id. Null and repeated ids are kept as they are; an empty table has no pieces.
    """
    path = tokenizer or vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, ids, counts in ended_documents(batch.column(1), path, end_id):
                doc, start, length = binary_pieces(counts, longest)
                stops = np.cumsum(length)
                view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                sums = np.fromiter((zlib.crc32(view[4 * (b - n) : 4 * b]) for b, n in zip(stops.tolist(), length.tolist(), strict=True)), np.int64, len(doc))
                columns = [batch.column(0).take(pa.array(doc + first)), pa.array(start), pa.array(length), pa.array(sums), pa.array(counts[doc].astype(np.int64)), pa.array(at + np.arange(len(doc))), pa.array(np.zeros(len(doc), np.int64))]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                at += len(doc)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lambda batches: tidy(cut(batches)), schema)
    return pieces.withColumnRenamed("id", id_col)


def write_buckets(docs: DataFrame, path: str, **options) -> None:
    """Write the sequences with their ids, a folder for each length."""
    pack_documents(docs, with_ids=True, **options).write.partitionBy("length").parquet(path)
