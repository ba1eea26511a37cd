"""Lines that very many documents share dropped from all of them, by counts in a sharded minimal perfect hash."""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florilege.llm.durable import Scratch, readable, shared_path
from florilege.llm.expressions import named
from florilege.llm.perfect_hash import CountIndex
from florilege.llm.shingles import chunks, text_buffers, tidy

#: Keys of one shard, the unit that is built by one task and read as a whole: some 3 MB.
SHARD_KEYS = 1 << 18
#: Bytes of shards that a worker holds at once; beyond it those that were not asked for longest give way.
RESIDENT = 64 << 20
#: Bytes of text whose lines are asked for together.
ASK_BYTES = 8 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line: without white space at both ends, A-Z in lower case."""
    return [line.strip(_SPACE).lower() for line in text.split(b"\n")]


def _counts(key: bytes, min_chars: int) -> bool:
    """Whether a key has ``min_chars`` code points (each has one to four bytes)."""
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def _hashes(keys: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)


def _texts(column: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in groups of about ``size`` bytes, with the number of the first; a longer text stands alone."""
    data, offsets = text_buffers(column)
    for first, last in chunks(offsets, size):
        at = offsets[first : last + 1].tolist()
        yield first, [data[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def _count(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _texts(batch.column(0), ASK_BYTES):
            n: Counter[bytes] = Counter()
            for text in texts:
                n.update(key for key in set(line_keys(text)) if _counts(key, min_chars))
            if n:
                h = _hashes(n).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(list(n.values()), pa.int64())], names=["h0", "h1", "n"])


def common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``(h0, h1, n)``: the 128-bit hashes of the keys of ``min_chars`` or more code points that lie in at least
    ``min_docs`` rows of ``docs``, with the number of those rows. Lines are counted in the task that reads them first, so a
    line of a third of all documents sends a row per some megabytes of text."""
    texts = docs.select(named(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(lambda batches: tidy(_count(batches, min_chars)), "h0 long, h1 long, n long")
    return counted.groupBy("h0", "h1").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def write_line_index(common: DataFrame, path: str, shard_keys: int = SHARD_KEYS) -> int:
    """Write the counts of ``common(h0, h1, n)``, a written table, to ``path`` as shards of about ``shard_keys`` keys;
    returns the number of shards. A shard is chosen by the second hash and built by one task."""
    n_shards = -(-common.count() // shard_keys)

    def build(table: pa.Table) -> pa.Table:
        keys = np.column_stack([table.column(c).to_numpy().view(np.uint64) for c in ("h0", "h1")])
        index = CountIndex.of(keys, table.column("n").to_numpy())
        return pa.table({"shard": table.column("shard").slice(0, 1), "data": pa.array([index.to_bytes()], pa.binary())})

    if n_shards:
        dealt = common.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
        dealt.groupBy("shard").applyInArrow(build, "shard int, data binary").write.partitionBy("shard").parquet(path)
    return n_shards


class LineIndex:
    """Reads the counts of keys from the shards at ``path``, at most about ``resident`` bytes of them held at once."""

    def __init__(self, path: str, n_shards: int, resident: int = RESIDENT):
        self.path, self.n_shards, self.resident = path, n_shards, resident
        self.held: OrderedDict[int, CountIndex] = OrderedDict()
        self.size = 0

    def _shard(self, k: int) -> CountIndex:
        if k in self.held:
            self.held.move_to_end(k)
            return self.held[k]
        where, path = fs.FileSystem.from_uri(f"{self.path}/shard={k}")
        files = [f.path for f in where.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.is_file and f.path.endswith(".parquet")]
        data = [x.as_buffer() for f in files for x in pq.ParquetFile(where.open_input_file(f)).read(columns=["data"]).column(0)]
        found = CountIndex.from_bytes(data[0]) if data else CountIndex.of(np.zeros((0, 2), np.uint64), np.zeros(0, np.int64))
        while self.held and self.size + found.nbytes > self.resident:
            self.size -= self.held.popitem(last=False)[1].nbytes
        self.held[k] = found
        self.size += found.nbytes
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for one without; shard by shard, those held first."""
        out = np.zeros(len(keys), np.int64)
        if not self.n_shards or not len(keys):
            return out
        shard = keys[:, 1].view(np.int64) % self.n_shards
        order = np.argsort(shard, kind="stable")
        shards, starts = np.unique(shard[order], return_index=True)
        parts = dict(zip(shards.tolist(), np.split(order, starts[1:]), strict=True))
        for k in sorted(parts, key=lambda k: k not in self.held):
            out[parts[k]] = self._shard(k).find(keys[parts[k]])
        return out


def drop_common_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1, counts: tuple[str, str] = ("n_lines", "n_dropped"), shard_keys: int = SHARD_KEYS, resident: int = RESIDENT) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` rows share, and two columns: how many lines a text had and
    how many were dropped.

    A text is split at line feeds; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z in lower case. A
    key of ``min_chars`` or more code points that lies in ``min_docs`` rows loses all its lines in every row; the others
    stay as they are, joined by line feeds.

    1. Distinct keys of each row are counted, first in the task, then by their 128-bit hash; this is the only shuffle.
    2. The hashes that reach ``min_docs`` (others are never dropped and need no slot) are dealt to shards. Each shard is a
       minimal perfect hash whose slots index a fingerprint and a count, written to the shared folder.
    3. Every row's lines probe those arrays: a task asks for the distinct keys of some megabytes of text at once and reads
       the shards that these need, of which it holds ``resident`` bytes. No line is joined, and nothing passes the driver.

    A null text counts as one empty line and stays null; an empty text is one empty line; an empty key is dropped only
    with ``min_chars`` 0. Each row is a document, also where rows or ids repeat. Long texts are read whole, by one task.
    Columns named as in ``counts`` are replaced, others stay as they are. An empty table gives no rows. The index stays
    in the shared folder for as long as the lazy result may be asked for.
    """
    spark = docs.sparkSession
    path = readable(spark, shared_path(spark, "line-index"))
    with Scratch(spark) as tables:
        n_shards = write_line_index(tables.write(common_lines(docs, text_col, min_docs, min_chars), "common"), path, shard_keys)
    rest = [c for c in docs.columns if c not in counts]
    place = rest.index(text_col)
    rows = docs.select(*(named(c).cast("string").alias(c) if c == text_col else named(c) for c in rest))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex(path, n_shards, resident)
        for batch in batches:
            valid = np.asarray(batch.column(place).is_valid())
            for first, texts in _texts(batch.column(place), ASK_BYTES):
                keys = [line_keys(text) for text in texts]
                asked = list({key for own in keys for key in own if _counts(key, min_chars)})
                gone = {asked[i] for i in np.flatnonzero(index.find(_hashes(asked)) >= min_docs).tolist()}
                out, dropped = [], []
                for i, (text, own) in enumerate(zip(texts, keys, strict=True)):
                    n = sum(key in gone for key in own)
                    if n:
                        text = b"\n".join(line for line, key in zip(text.split(b"\n"), own, strict=True) if key not in gone)
                    out.append(text.decode("utf-8", "replace") if valid[first + i] else None)
                    dropped.append(n)
                columns = batch.slice(first, len(texts)).columns
                columns[place] = pa.array(out, pa.string())
                columns += [pa.array([len(own) for own in keys], pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, *counts])

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields] + [T.StructField(c, T.LongType()) for c in counts])
    return rows.mapInArrow(lambda batches: tidy(clean(batches)), schema)
