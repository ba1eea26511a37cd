"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.components import connected_components
from florilege.llm.durable import Scratch, durable
from florilege.llm.expressions import all_of, named
from florilege.llm.id_filter import filter_blocks, with_maybe
from florilege.llm.shingles import chunks, mix64, shingle_sets, text_buffers, tidy

COORDINATES = 640
BANDS, ROWS = 25, 5
#: The pairs of low bits of a coordinate agree with probability j + (1 - j) / 4. Candidates with fewer agreements than
#: five deviations below the mean at the asked similarity (a chance of 3e-7) are not compared further.
DEVIATIONS = 5


def permute(position: np.ndarray) -> np.ndarray:
    """The fixed second permutation of the universe of 32-bit positions."""
    x = position ^ (position >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Circulant MinHash: the first permutation places each shingle in the universe; coordinate k is the smallest value
    of the second permutation after a circular shift by k. One row for each text with shingles."""
    at = np.concatenate([[0], np.cumsum(counts)])[:-1][counts > 0]
    placed = shingles.astype(np.uint32)
    out = np.empty((len(at), COORDINATES), np.uint32)
    if len(at):
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat(permute(placed - np.uint32(k + 1)), at)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        total = np.full(len(signature), b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + signature[:, k].astype(np.uint64))
        keys[:, b] = total
    return keys


def low_bits(signature: np.ndarray) -> np.ndarray:
    """Two low bits of each coordinate, 32 coordinates to a 64-bit number."""
    two = (signature & np.uint32(3)).astype(np.uint64).reshape(len(signature), COORDINATES // 32, 32)
    return np.bitwise_or.reduce(two << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=2)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        for first, last in chunks(offsets):
            sets, counts = shingle_sets(data, offsets[first : last + 1])
            some = counts > 0
            at = np.concatenate([[0], np.cumsum(counts)])[:-1][some]
            signature = signatures(sets, counts)
            missing = pa.array(~some)
            wide = np.zeros((len(counts), 2 + COORDINATES // 32), np.uint64)
            if len(at):
                wide[some, 0] = np.add.reduceat(mix64(sets), at)
                wide[some, 1] = np.add.reduceat(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), at)
                wide[some, 2:] = low_bits(signature)
            wide = wide.view(np.int64)
            keys = pa.array(band_keys(signature).view(np.int64).ravel())
            ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
            columns = [batch.column(0).slice(first, last - first), pa.array(counts.astype(np.int64))]
            columns += [pa.array(wide[:, j], mask=~some) for j in range(wide.shape[1])]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), keys, mask=missing))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "d0", "d1", *(f"s{j}" for j in range(COORDINATES // 32)), "bands"])


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, set size, 128-bit digest of the set, low bits of its signature, band keys."""
    kind = docs.schema[id_col].dataType.simpleString()
    bits = ", ".join(f"s{j} long" for j in range(COORDINATES // 32))
    return docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text")).mapInArrow(lambda batches: tidy(_describe(batches)), f"id {kind}, n_shingles long, d0 long, d1 long, {bits}, bands array<long>")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = []
        for name in ("text_a", "text_b"):
            data, offsets = text_buffers(batch.column(name))
            sides.append((data, offsets))
        shared = np.zeros(batch.num_rows, np.int64)
        union = np.zeros(batch.num_rows, np.int64)
        size = np.maximum(np.diff(sides[0][1]), np.diff(sides[1][1]))
        for first, last in chunks(np.concatenate([[0], np.cumsum(size)])):
            (a, na), (b, nb) = (shingle_sets(data, offsets[first : last + 1]) for data, offsets in sides)
            at_a, at_b = np.concatenate([[0], np.cumsum(na)]).tolist(), np.concatenate([[0], np.cumsum(nb)]).tolist()
            for i in range(last - first):
                both = np.concatenate([a[at_a[i] : at_a[i + 1]], b[at_b[i] : at_b[i + 1]]])
                both.sort()
                shared[first + i] = np.count_nonzero(both[1:] == both[:-1])
                union[first + i] = len(both) - shared[first + i]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared), pa.array(union)], names=["a", "b", "shared", "total"])


def _agreements(a: str, b: str) -> F.Column:
    """How many of the coordinates' low-bit pairs agree."""
    odd = F.lit(0x5555555555555555)
    differ = None
    for j in range(COORDINATES // 32):
        x = F.col(f"{a}.s{j}").bitwiseXOR(F.col(f"{b}.s{j}"))
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
        differ = n if differ is None else differ + n
    return F.lit(COORDINATES) - differ


def _maybe_near(a: str, b: str, percent: int, deviations: float | None) -> F.Column:
    j = percent / 100
    small, large = F.least(f"{a}.n_shingles", f"{b}.n_shingles"), F.greatest(f"{a}.n_shingles", f"{b}.n_shingles")
    sizes = small * 100 >= large * percent
    if deviations is None:
        return sizes
    agree = j + (1 - j) / 4
    return sizes & (_agreements(a, b) >= COORDINATES * agree - deviations * (COORDINATES * agree * (1 - agree)) ** 0.5)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, deviations: float | None = DEVIATIONS) -> DataFrame:
    """``docs``' ids with ``n_shingles``, ``component_id`` and ``kept``; linked are documents whose sets of five-word
    shingles have a Jaccard similarity of at least ``percent`` / 100.

    1. Documents with equal sets form a class; its smallest id stands for it from here on.
    2. Classes that share a band key meet. Each is first compared with the smallest id of its bucket; in buckets of
       three and more also with the smallest id of the finer buckets that two neighbouring bands make. Those links are
       joined into components. In a bucket that still holds several components, each member outside of the one with
       most members is compared with the members of the others. A group of copies thus needs some comparisons a
       member, and no bucket is capped.
    3. A pair is passed on by an estimate from its signatures that ``deviations`` separate from a loss (without them all
       pairs are passed on), and then decided on the full shingle sets. Only texts of such pairs are shuffled.

    With 25 bands of 5 coordinates a pair at similarity 0.80 meets in no band with probability 5e-5, at 0.85 4e-7.

    A null or empty text, or one without words, has no shingles and is linked with nothing. Very long texts are described
    whole. Rows that repeat an id are one node and all get its answer. A row with a null id is linked with nothing: its
    component is null and it is kept. An empty table gives no rows. The result is a written table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    with Scratch(docs.sparkSession) as tables:
        rows = tables.write(describe(source, "id", "text"), "described")
        classes = rows.where("d0 is not null and id is not null").groupBy("d0", "d1").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        classes = tables.write(classes.where("n > 1").drop("n"), "classes")
        nodes = rows.select("id", "n_shingles", "d0", "d1").join(classes, ["d0", "d1"], "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("first", "id")).alias("node"))
        copies = classes.select("d0", "d1", "first")
        stand = rows.where("bands is not null and id is not null").join(copies, ["d0", "d1"], "left").where("first is null or id = first").drop("d0", "d1", "first")
        stand = tables.write(stand, "stand")
        banded = stand.select(F.explode("bands").alias("key"), "id")
        buckets = tables.write(banded.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1"), "buckets")
        members = tables.write(banded.join(buckets, "key").where("id <> leader"), "members")

        def confirmed(pairs: DataFrame) -> DataFrame:
            ids = tables.write(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "asked")
            some = with_maybe(source, filter_blocks(ids, "id"), F.col("id")).where("__maybe").drop("__maybe")
            texts = tables.write(some.join(ids, "id", "left_semi"), "texts")
            a, b = (texts.select(F.col("id").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
            compared = pairs.join(a, "a").join(b, "b").mapInArrow(lambda batches: tidy(_compare(batches)), f"a {kind}, b {kind}, shared long, total long")
            return tables.write(compared.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b"), "links")

        crowd = stand.select("id", "bands").join(members.where("n > 2").select("id").distinct(), "id", "left_semi")
        fine = crowd.select("id", F.explode(F.transform("bands", lambda key, i: F.xxhash64(key, F.element_at("bands", F.pmod(i + 1, F.lit(BANDS)) + 1)))).alias("key"))
        fine = tables.write(fine, "fine")
        first = fine.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
        finer = fine.join(first, "key").where("id <> leader")
        led = members.select(F.col("leader").alias("x"), F.col("id").alias("y")).union(finer.select("leader", "id")).distinct()
        a, b = stand.drop("bands").alias("a"), stand.drop("bands").alias("b")
        near = led.join(a, F.col("x") == F.col("a.id")).join(b, F.col("y") == F.col("b.id")).where(_maybe_near("a", "b", percent, deviations))
        near = tables.write(near.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "candidates")
        labels = connected_components(confirmed(near), tables)

        # members that a bucket's leader did not bring into one component
        tagged = members.where("n > 2").select("key", "id").join(labels, F.col("id") == F.col("node"), "left")
        tagged = tables.write(tagged.select("key", "id", F.coalesce("component", "id").alias("component")), "tagged")
        sizes = tagged.groupBy("key", "component").agg(F.count("*").alias("n"))
        mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("kinds")).where("kinds > 1")
        mixed = tables.write(tagged.join(mixed.select("key", F.col("most.component").alias("main")), "key").join(stand, "id"), "mixed")
        a, b = mixed.where("component <> main").alias("a"), mixed.alias("b")
        other = (F.col("a.component") != F.col("b.component")) & ((F.col("b.component") == F.col("b.main")) | (F.col("a.id") < F.col("b.id")))
        once = F.array_intersect("a.bands", "b.bands")[0] == F.col("a.key")  # the first bucket that both are in
        apart = a.join(b, (F.col("a.key") == F.col("b.key")) & other & _maybe_near("a", "b", percent, deviations) & once)
        apart = tables.write(apart.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct(), "candidates")
        more = confirmed(apart)
        at = labels.withColumnRenamed("component", "at")
        more = more.join(at.select(F.col("node").alias("a"), F.col("at").alias("at_a")), "a", "left").join(at.select(F.col("node").alias("b"), F.col("at").alias("at_b")), "b", "left")
        merged = connected_components(more.select(F.coalesce("at_a", "a").alias("a"), F.coalesce("at_b", "b").alias("b")), tables)
        out = nodes.join(labels.select("node", F.col("component").alias("c1")), "node", "left").withColumn("c1", F.coalesce("c1", "node"))
        out = out.join(merged.select(F.col("node").alias("c1"), F.col("component").alias("c2")), "c1", "left")
        component = F.coalesce("c2", "c1")
        out = out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component.isNull() | (F.col("id") == component)).alias("kept"))
        return durable(out, "near-duplicates")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, deviations: float | None = DEVIATIONS) -> DataFrame:
    """``docs`` with one document of each group that ``near_duplicates`` finds: the one with the smallest id.

    Of rows that repeat an id one stays, that with the smallest hash of its text (of equal texts the first by all
    columns); rows with a null id stay, as do those with a null or empty text. An empty table stays empty. Rows that a
    filter of at most 8 MB shows to be untouched are not shuffled.
    """
    found = near_duplicates(docs, id_col, text_col, percent, deviations).where(named(id_col).isNotNull())
    touched = found.groupBy(named(id_col).alias("__id")).agg(F.min("kept").alias("__kept"), F.count("*").alias("__n")).where("not __kept or __n > 1")
    touched = durable(touched, "touched")
    flagged = with_maybe(docs, filter_blocks(touched, "__id"), named(id_col))
    free = flagged.where("not __maybe").select(*all_of(docs))
    held = flagged.where("__maybe").join(touched, named(id_col) == F.col("__id"), "left").where("__kept is null or __kept")
    out = free.unionByName(held.where("__n is null or __n = 1").select(*all_of(docs)))
    if touched.where("__kept and __n > 1").isEmpty():
        return out
    whole = F.struct(*all_of(docs))
    one = held.where("__n > 1").groupBy("__id").agg(F.min_by(whole, F.struct(F.xxhash64(named(text_col)), F.to_json(whole))).alias("__row"))
    return out.unionByName(one.select(*(F.col("__row").getField(c).alias(c) for c in docs.columns)))
