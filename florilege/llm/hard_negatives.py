"""Hard negatives of anchor vectors: per positive, the highest scores of other labels inside a window under its own score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from florilege.llm.durable import Scratch, durable, readable
from florilege.llm.expressions import named

#: Vectors that meet in one block: rows of a task, and anchors read at a time.
ROWS, ANCHORS = 16384, 256
#: Products of one task; where there are more, rows are dealt to more tasks.
WORK = 1 << 33
#: Products below this are exact in double precision.
_EXACT = 1 << 53


def _matrix(column: pa.Array, dim: int = 0) -> np.ndarray:
    """Integer vectors as rows; shorter ones are filled up with zeros."""
    column = column if isinstance(column, pa.Array) else column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), max(dim, int(lengths.max(initial=0)), 1)), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows as 64-bit integers, by floating point where that is exact."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    if float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * n < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _first(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` first of each group by descending score, ties by ascending id: the combiner of a task."""
    order = np.lexsort((ids, ~scores, group))
    own = group[order]
    start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return order[rank < k]


def _against(anchors_path: str, columns: list[str], choose: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that holds a block of its rows against all anchors, which it reads from their written table some at a time.

    ``choose(anchors, scores, labels, ids)`` gives, for one block of anchors and rows, the chosen (anchor, row) places
    and their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = fs.FileSystem.from_uri(anchors_path)
        anchors = ds.dataset(path, filesystem=where, format="parquet")
        for rows in _blocks(batches):
            x, labels, ids = _matrix(rows.column("v")), rows.column("label").to_numpy(), rows.column("id").to_numpy()
            for some in anchors.to_batches(columns=columns, batch_size=ANCHORS):
                if some.num_rows:
                    scores = _products(_matrix(some.column("v")), x)
                    a, r, slot = choose(some, scores, labels, ids)
                    yield pa.RecordBatch.from_arrays([some.column("id").take(pa.array(a)), pa.array(slot.astype(np.int32)), pa.array(scores[a, r]), pa.array(ids[r])], names=["anchor", "slot", "score", "id"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of ``ROWS``, the last one shorter."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, ROWS - n))
            batch = batch.slice(held[-1].num_rows)
            n += held[-1].num_rows
            if n == ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places, among those that fit, of each line's ``k`` highest scores and all that tie with the last of them."""
    lowest = np.iinfo(np.int64).min
    held = np.where(fits, scores, lowest)
    if held.shape[1] > k:
        fits = fits & (held >= np.partition(held, -k, axis=1)[:, -k][:, None])
    return np.nonzero(fits)


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of at most ``width`` numbers as rows, filled up with the smallest number."""
    out = np.full((len(lists), width), np.iinfo(np.int64).min)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
    return out


def _percent(x: Column, percent: int, plus: int) -> Column:
    """``percent`` / 100 of a whole number, rounded down; with ``plus`` 99 rounded up. Exact."""
    rest = F.pmod(x, F.lit(100))
    return F.call_function("div", x - rest, F.lit(100)) * percent + F.call_function("div", rest * percent + plus, F.lit(100))


def _top(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot: Spark keeps no more before the shuffle and ranks what is left after it."""
    rank = F.row_number().over(W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def mine_hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each row for which ``anchors``
    holds and each of its first ``positives`` other rows of the same label, the first ``negatives`` rows of other labels
    whose score, in percent of the positive's, lies in ``window``.

    A score is the inner product of two integer vectors, exact in 64 bits; higher scores come first, ties by smaller id.

    1. Every row meets every anchor, block by block; a task keeps the first positives of each anchor in a block, Spark the
       first ones of a task and of all.
    2. The positives' upper limits, descending, cut an anchor's scores into disjoint slots. Each row of another label
       falls into one slot at most; again blocks, tasks and all keep the first ``negatives`` of a slot, so windows that
       overlap are not searched one by one.
    3. A window reaches from its positive's upper limit downwards, so its first ones are among those of its own slot
       followed by the slots below: one descending merge of an anchor's slots answers all its windows.

    Anchors are a written table that tasks read in pieces; nothing is broadcast or collected, and a task holds two blocks
    at a time. A hot label is spread like any other. Rows with a null id, label or vector, or a null component take no
    part. Shorter vectors count as filled up with zeros. Of rows that repeat an id one takes part, the first by label and
    vector. An anchor without positives, and a positive with no row in its window (a negative score always), give no rows.
    Further columns are ignored. An empty table gives no rows. ``id_col`` holds integers. The result is a written table.
    """
    low, high = window
    spark = vectors.sparkSession
    if vectors.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("ids must be integers")
    rows = vectors.select(named(id_col).cast("long").alias("id"), named(label_col).alias("name"), named(vector_col).cast("array<long>").alias("v"), anchors.alias("anchor"))
    rows = rows.where("id is not null and name is not null and v is not null and not exists(v, x -> x is null)")
    shape = "anchor long, slot int, score long, id long"
    with Scratch(spark) as tables:
        repeated = tables.write(rows.groupBy("id").count().where("count > 1").select("id"), "repeated")
        if not repeated.isEmpty():
            one = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("name", "v", "anchor")).alias("x")).select("id", "x.*")
            rows = rows.join(repeated, "id", "left_anti").unionByName(one)
        rows = tables.write(rows.select("id", F.xxhash64("name").alias("label"), "v", "anchor"), "rows")
        asked, others = rows.where("anchor").select("id", "label", "v"), rows.select("id", "label", "v")
        tasks = -(-rows.count() * asked.count() // WORK)
        if tasks > others.rdd.getNumPartitions():
            others = others.repartition(tasks)

        def alike(some: pa.RecordBatch, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            fits = (some.column("label").to_numpy()[:, None] == labels) & (some.column("id").to_numpy()[:, None] != ids)
            a, r = _best(scores, fits, positives)
            keep = _first(a, scores[a, r], ids[r], positives)
            return a[keep], r[keep], np.zeros(len(keep), np.int32)

        files = readable(spark, tables.put(asked, "anchors"))
        found = _top(others.mapInArrow(_against(files, ["id", "label", "v"], alike), shape), positives)
        ranked = F.reverse(F.sort_array(F.collect_list(F.struct("score", (-F.col("id")).alias("minus")))))  # at most ``positives``
        chosen = found.groupBy(F.col("anchor").alias("id")).agg(ranked.alias("p"))
        limits, lows = F.transform("p", lambda p: _percent(p["score"], high, 0)), F.transform("p", lambda p: _percent(p["score"], low, 99))
        chosen = tables.write(chosen.withColumns({"limits": limits, "lows": lows}), "positives")

        def unlike(some: pa.RecordBatch, scores: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            tops = _padded(some.column("limits"), positives)
            fits = (some.column("label").to_numpy()[:, None] != labels) & (scores <= tops[:, :1]) & (scores >= some.column("low").to_numpy()[:, None])
            a, r = np.nonzero(fits)
            slot = (scores[a, r][:, None] <= tops[a]).sum(1)  # how many positives' limits it keeps to
            keep = _first(a * (positives + 1) + slot, scores[a, r], ids[r], negatives)
            return a[keep], r[keep], slot[keep]

        files = readable(spark, tables.put(asked.join(chosen, "id").select("id", "label", "v", "limits", F.array_min("lows").alias("low")), "limits"))
        slots = _top(others.mapInArrow(_against(files, ["id", "label", "v", "limits", "low"], unlike), shape), negatives)
        entries = F.reverse(F.sort_array(F.collect_list(F.struct("score", (-F.col("id")).alias("minus"), "slot"))))  # at most ``negatives`` a slot
        merged = slots.groupBy(F.col("anchor").alias("id")).agg(entries.alias("e"))
        each = chosen.join(merged, "id").select("id", "e", F.posexplode(F.arrays_zip("p", "lows")).alias("k", "x"))
        below = F.slice(F.filter("e", lambda e: e["slot"] > F.col("k")), 1, negatives)
        each = each.select("id", "x", F.posexplode(F.filter(below, lambda e: e["score"] >= F.col("x.lows"))).alias("k", "e"))
        out = each.select(
            F.col("id").alias("anchor_id"), (-F.col("x.p.minus")).alias("positive_id"), (F.col("k") + 1).cast("int").alias("rank"),
            (-F.col("e.minus")).alias("negative_id"), F.col("x.p.score").alias("positive_score"), F.col("e.score").alias("negative_score"),
        )
        return durable(out, "hard-negatives")
