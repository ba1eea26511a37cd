"""Token ids of documents as binary files: one id array a file, with Elias-Fano coded document boundaries."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from florilege.llm.durable import qualified
from florilege.llm.elias_fano import SAMPLE, EliasFano
from florilege.llm.expressions import named
from florilege.llm.tokens import ended_documents, vocabulary

#: A file is closed once it holds this many ids (or one longer document).
FILE_IDS = 4 << 20
_HEAD = struct.Struct("<8sBBB5xQQQQQq")
_MAGIC = b"tokenids"
#: Keys that span more than this are held as they are.
_WIDEST = 1 << 62


def pack_file(ids: np.ndarray, counts: np.ndarray, keys: np.ndarray, known: np.ndarray) -> bytes:
    """A file's bytes: header, boundaries, document keys, ids.

    The boundaries are the starts of all documents and the end of the last one. Documents without a key come first; the
    other keys ascend, and like the boundaries they are Elias-Fano coded, from the smallest one up (as 64-bit numbers
    only if they span more than 2^62). Ids take two bytes if all fit.
    """
    wide = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    bounds = EliasFano.of(np.concatenate([[0], np.cumsum(counts)])).to_bytes()
    own = keys[known].astype(np.int64)
    low = int(own[0]) if len(own) else 0
    coded = not len(own) or int(own[-1]) - low < _WIDEST
    held = EliasFano.of(own - low).to_bytes() if coded else own.astype("<i8").tobytes()
    head = _HEAD.pack(_MAGIC, 2, wide, coded, len(counts), len(own), len(ids), len(bounds), len(held), low)
    return b"".join([head, bounds, held, memoryview(ids.astype(f"<u{wide}", copy=False)).cast("B")])


class TokenFile:
    """Reads a file's bytes: ``document(i)`` is a view of its ids, ``key(i)`` its key; ``documents`` goes through all."""

    def __init__(self, data: bytes | memoryview):
        magic, version, wide, coded, self.n_docs, self.n_keys, self.n_ids, n_bounds, n_held, self.low = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 2:
            raise ValueError("not a token file")
        at = _HEAD.size
        self.bounds = EliasFano.from_bytes(memoryview(data)[at : at + n_bounds])
        held = memoryview(data)[at + n_bounds : at + n_bounds + n_held]
        self.keys = EliasFano.from_bytes(held) if coded else np.frombuffer(held, "<i8")
        self.ids = np.frombuffer(data, f"<u{wide}", self.n_ids, at + n_bounds + n_held)

    def keys_of(self, first: int, last: int) -> list[int | None]:
        none = self.n_docs - self.n_keys
        a, b = max(first - none, 0), max(last - none, 0)
        if a == b:
            own = []
        else:
            own = (self.keys.span(a, b) + self.low if isinstance(self.keys, EliasFano) else self.keys[a:b]).tolist()
        return [None] * (last - first - len(own)) + own

    def key(self, i: int) -> int | None:
        return self.keys_of(i, i + 1)[0]

    def document(self, i: int) -> np.ndarray:
        first, last = self.bounds.span(i, i + 2)
        return self.ids[first:last]

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray]]:
        """Keys and boundaries of some documents at a time, each stretch selected by itself."""
        for first in range(0, self.n_docs, SAMPLE):
            last = min(first + SAMPLE, self.n_docs)
            yield self.keys_of(first, last), self.bounds.span(first, last + 1)


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a name of its own, then move: a repeated or doubled task leaves one whole file."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    part = f"{path}/_{name}-{uuid.uuid4().hex}"
    with where.open_output_stream(part) as out:
        out.write(data)
    where.move(part, f"{path}/{name}")


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` and write them in ascending ``id_col`` order (null first; ties by text) to files in ``folder``.

    ``folder`` must be one that the driver and all executors share; without a scheme it is one of Spark's default file
    system. Documents are dealt by ranges of the id and sorted
    inside each range; a task writes one file after another, each of a bounded size. Null text is the empty text: its
    only id is ``end_id``. The lazy result has a row per file: ``name``, ``n_docs``, ``n_ids``; names sort in file order.
    Repeated ids are documents like others; very long texts are encoded whole; an empty table gives no file. ``id_col``
    must be an integer column.
    """
    path = tokenizer or vocabulary()
    folder = qualified(docs.sparkSession, folder)
    folder = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, sizes = TaskContext.get().partitionId(), [], []
        ids, counts, keys, known, held = [], [], [], [], 0

        def close() -> None:
            if counts:
                name = f"part-{part:07d}-{len(names):07d}.tok"
                all_counts = np.concatenate(counts)
                _put(folder, name, pack_file(np.concatenate(ids), all_counts, np.concatenate(keys), np.concatenate(known)))
                names.append(name)
                sizes.append((len(all_counts), int(all_counts.sum())))
                for x in (ids, counts, keys, known):
                    x.clear()

        for batch in batches:
            key = batch.column(0)
            for first, encoded, n in ended_documents(batch.column(1), path, end_id):
                some = key.slice(first, len(n))
                ids.append(encoded if encoded.max() >= 1 << 16 else encoded.astype(np.uint16))
                counts.append(n)
                known.append(np.asarray(some.is_valid()))
                keys.append(some.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                held += len(encoded)
                if held >= FILE_IDS:
                    close()
                    held = 0
        close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "n_docs": pa.array([x[0] for x in sizes], pa.int64()), "n_ids": pa.array([x[1] for x in sizes], pa.int64())})

    rows = docs.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("text"))
    rows = (rows.repartitionByRange(partitions, "id") if partitions else rows.repartitionByRange("id")).sortWithinPartitions("id", "text")
    return rows.mapInArrow(write, "name string, n_docs long, n_ids long")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            file = TokenFile(content.as_buffer())
            for keys, bounds in file.documents():
                sums = [zlib.crc32(file.ids[a:b].astype("<u4")) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["name", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """A row per document of the files named in ``manifest``: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32``, all computed from the files. An empty manifest gives no rows."""
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tok").load(folder)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInArrow(_decode, "name string, doc_id long, start long, n_tokens long, ids_crc32 long")
    before = F.sum("n_ids").over(W.orderBy("name").rowsBetween(W.unboundedPreceding, -1))  # a row per file
    base = manifest.select("name", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(base, "name").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
