"""Near-duplicate embeddings of one label by E8 lattice hashing and exact cosine."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.components import connected_components
from florilege.llm.durable import Scratch, durable
from florilege.llm.shingles import mix64

TABLES, PROBES = 20, 8
#: Distance of projected unit vectors that makes up one lattice unit.
UNIT = 1.3
#: Sign bits of random projections, for an estimate of the angle; candidates with more differing bits than five
#: deviations above the mean at the asked cosine (a chance of 3e-7) are not compared further.
SIGN_BITS, DEVIATIONS = 128, 5
#: Vectors of one component that meet in one block of the final count.
BLOCK = 1024


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring cells."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    r = np.rint(y)
    off = y - r
    odd = np.flatnonzero(r.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    r[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 moved by a half in each coordinate."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def _unit_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision, shorter ones filled up with zeros, and which rows have one that counts."""
    column = column if isinstance(column, pa.Array) else column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    dim = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(column), max(dim, 1)))
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    with np.errstate(all="ignore"):
        largest = np.abs(out).max(1)
        good = np.isfinite(out).all(1) & (largest > 0) & (lengths > 0)
        out[~good], largest[~good] = 0, 1
        out /= largest[:, None]
        norm = np.sqrt((out * out).sum(1))
        out /= np.where(norm > 0, norm, 1)[:, None]
    return out, good


def _projections(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8)
    shift = rng.uniform(0, 1, (TABLES, 8))
    codes = rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.normal(0, 1, (dim, TABLES * 8 + SIGN_BITS)), shift, codes


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roots = _roots()
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            x, good = _unit_vectors(batch.column("v"))
            good &= np.asarray(batch.column("label").is_valid()) & np.asarray(batch.column("id").is_valid())
            label = pc.fill_null(batch.column("label_hash"), 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            project, shift, codes = _projections(x.shape[1])
            y = x @ project
            signs = np.packbits(y[:, TABLES * 8 :] > 0, axis=1, bitorder="little").view(np.int64)
            home = np.empty((len(x), TABLES), np.uint64)
            probes = np.empty((len(x), TABLES, PROBES), np.uint64)
            fine = np.empty((len(x), TABLES), np.uint64)

            def code(points: np.ndarray, t: int, label: np.ndarray) -> np.ndarray:
                whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
                return mix64((whole * codes).sum(-1, dtype=np.uint64) + mix64(label + np.uint64(t)))  # noqa: B023

            for t in range(TABLES):
                place = y[:, 8 * t : 8 * t + 8] / UNIT + shift[t]
                cell = nearest_e8(place)
                home[:, t] = code(cell, t, label)
                near = np.argpartition(-((place - cell) @ roots.T), PROBES, axis=1)[:, :PROBES]
                probes[:, t] = code(cell[:, None, :] + roots[near], t, label[:, None])
                some = (signs.view(np.uint64)[:, t % 2] >> np.uint64(6 * (t // 2) % 56)) & np.uint64(0xFF)
                fine[:, t] = mix64(home[:, t] + some * np.uint64(0x9E3779B97F4A7C15))
            bad = pa.array(~good)

            def lists(keys: np.ndarray) -> pa.Array:
                n = keys[0].size if len(keys) else 1
                ends = np.concatenate([[0], np.cumsum(good * n)]).astype(np.int32)  # noqa: B023
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[good].view(np.int64).ravel()), mask=bad)  # noqa: B023

            bits = np.ascontiguousarray(x).view(np.uint64) if len(x) else np.zeros((0, 1), np.uint64)
            salt = mix64(np.arange(x.shape[1], dtype=np.uint64) + np.uint64(5))
            set_ = bits << np.uint64(1) != 0  # zeros, and what a batch with longer vectors fills up, leave a digest as it is
            d0 = mix64((mix64(bits + salt) * set_).sum(1, dtype=np.uint64) + label)
            d1 = mix64((mix64(bits ^ salt) * set_).sum(1, dtype=np.uint64) ^ label)
            columns = [batch.column("id"), pa.array(d0.view(np.int64), mask=~good), pa.array(d1.view(np.int64), mask=~good), pa.array(signs[:, 0]), pa.array(signs[:, 1]), lists(home), lists(fine), lists(probes.reshape(len(x), -1)), batch.column("v")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "d0", "d1", "s0", "s1", "home", "fine", "probes", "v"])


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _unit_vectors(batch.column("va"))[0], _unit_vectors(batch.column("vb"))[0]
        n = min(a.shape[1], b.shape[1])
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((a[:, :n] * b[:, :n]).sum(1))], names=["a", "b", "cosine"])


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93, deviations: float | None = DEVIATIONS) -> DataFrame:
    """The ids of ``vectors`` with ``n_links``, ``component_id`` and ``kept``; linked are vectors of one label whose cosine
    is at least ``cosine``.

    1. Vectors with equal directions and labels form a class, its smallest id stands for it.
    2. In each table a vector is projected to eight dimensions and decoded to its nearest E8 point, its home cell; it
       also probes the neighbouring cells nearest to it. First, members of a home cell that also share eight sign bits
       are compared with the smallest id among them; the links are joined into components. Then vectors whose home
       cell is another one's home or probe, and that are still in different components, are compared.
    3. Linked vectors lie in one component, so the links of a component's members are counted among them, block by
       block of at most about ``BLOCK`` by ``BLOCK`` vectors: pairs are counted where they meet and never written.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or id, are
    linked with nothing (a null id has a null component and is kept). Vectors are compared in double precision.
    Rows that repeat an id are vectors of their own, each linked by what it holds, and show the same id. Vectors of
    different lengths compare as if zeros followed. With ``deviations`` None no pair is left out by its sign bits.
    An empty table gives no rows. Cells hash the label, so a large label is spread over its cells.
    The result is a written table; the others are deleted.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    element = vectors.schema[vector_col].dataType.simpleString()
    source = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    described = source.withColumn("label_hash", F.xxhash64("label")).mapInArrow(_describe, f"id {kind}, d0 long, d1 long, s0 long, s1 long, home array<long>, fine array<long>, probes array<long>, v {element}")
    with Scratch(vectors.sparkSession) as tables:
        rows = tables.write(described, "described")
        classes = tables.write(rows.where("d0 is not null").groupBy("d0", "d1").agg(F.min("id").alias("first"), F.count("*").alias("n")), "classes")
        # a class is known by its smallest id, where different vectors share that by its digest too
        shared = not classes.groupBy("first").count().where("count > 1").isEmpty()
        key = (lambda c: F.struct(c.alias("id"), F.col("d0").alias("d"))) if shared else (lambda c: c)
        kind = f"struct<id:{kind},d:bigint>" if shared else kind
        nodes = rows.select("id", "d0", "d1").join(classes, ["d0", "d1"], "left").select("id", F.when(F.col("id").isNotNull(), key(F.coalesce("first", "id"))).alias("node"), F.coalesce("n", F.lit(1)).alias("n"))
        stand = rows.join(classes, ["d0", "d1"]).where("id = first").dropDuplicates(["d0", "d1"]).withColumn("id", key(F.col("id")))
        stand = tables.write(stand.drop("d0", "d1", "first"), "classes")
        p = float(np.arccos(cosine) / np.pi)
        most = SIGN_BITS if deviations is None else SIGN_BITS * p + deviations * (SIGN_BITS * p * (1 - p)) ** 0.5

        def differing(a: str, b: str) -> F.Column:
            return F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))) + F.bit_count(F.col(f"{a}.s1").bitwiseXOR(F.col(f"{b}.s1")))

        def linked(pairs: DataFrame) -> DataFrame:
            a, b = stand.select(F.col("id").alias("a"), F.col("v").alias("va")), stand.select(F.col("id").alias("b"), F.col("v").alias("vb"))
            found = pairs.join(a, "a").join(b, "b").select("a", "b", "va", "vb").mapInArrow(_cosines, f"a {kind}, b {kind}, cosine double")
            return found.where(F.col("cosine") >= cosine).select("a", "b")

        fine = stand.select(F.explode("fine").alias("key"), "id")
        first = tables.write(fine.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n"), "leaders")
        led = fine.join(first, "key").where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
        a, b = stand.select("id", "s0", "s1").alias("a"), stand.select("id", "s0", "s1").alias("b")
        led = led.alias("p").join(a, F.col("p.a") == F.col("a.id")).join(b, F.col("p.b") == F.col("b.id")).where(differing("a", "b") <= most).select("p.a", "p.b")
        labels = connected_components(linked(led), tables)
        placed = tables.write(stand.select("id", "s0", "s1", "home", "probes").join(labels, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node"), "placed")
        homes = placed.select(F.explode("home").alias("key"), "id", "component", "s0", "s1").alias("a")
        asked = placed.select(F.explode(F.concat("home", "probes")).alias("key"), "id", "component", "s0", "s1").alias("b")
        apart = homes.join(asked, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component")) & (differing("a", "b") <= most))
        apart = apart.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()
        more = tables.write(linked(tables.write(apart, "candidates")), "links")
        where = placed.select("id", "component")
        more = more.join(where.select(F.col("id").alias("a"), F.col("component").alias("at_a")), "a").join(where.select(F.col("id").alias("b"), F.col("component").alias("at_b")), "b")
        merged = connected_components(more.select(F.col("at_a").alias("a"), F.col("at_b").alias("b")), tables)
        member = where.join(merged.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select("id", F.coalesce("top", "component").alias("component"))
        member = tables.write(member, "members")
        counts = _count_links(stand.select("id", "n", "v"), member, kind, element, cosine, tables)
        out = nodes.join(member.withColumnRenamed("id", "node"), "node", "left").join(counts.withColumnRenamed("id", "node"), "node", "left")
        component = F.coalesce("component", "node")
        component = component["id"] if shared else component
        links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
        out = out.select(F.col("id").alias(id_col), links.cast("long").alias("n_links"), component.alias("component_id"), (component.isNull() | (F.col("id") == component)).alias("kept"))
        return durable(out, "near-embeddings")


def _count_links(stand: DataFrame, member: DataFrame, kind: str, element: str, cosine: float, tables: Scratch) -> DataFrame:
    """``(id, links)``: for each class the vectors of other classes of its component that it is linked with."""
    sizes = tables.write(member.groupBy("component").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    many = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = member.join(sizes, "component").join(stand, "id").withColumn("of", many).withColumn("own", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    blocks = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    blocks = blocks.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n", "v")

    def count(table: pa.Table) -> pa.Table:
        x, _ = _unit_vectors(table.column("v"))
        own, n = table.column("own").to_numpy(), table.column("n").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        near = x @ x.T >= cosine
        near &= (own[:, None] != own[None, :]) if i != j else ~np.eye(len(x), dtype=bool)
        return pa.table({"id": table.column("id"), "links": pa.array(near.astype(np.int64) @ n)})

    return blocks.groupBy("component", "i", "j").applyInArrow(count, f"id {kind}, links long").groupBy("id").agg(F.sum("links").alias("links"))
