"""Pairs of large groups, nearest neighbours, sketches, hierarchies: against brute force."""

import hashlib
import math
import pathlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from florilege.functions import sequence as seq
from florilege.operators import aggregates as ag
from florilege.operators import joins as jo
from florilege.operators import ontology as on
from florilege.operators.neighbours import knn_of_vectors, pairs_within


def test_pairs_of_large_groups(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 40, "e": 7}
    rows = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i int").repartition(3)
    for block in (1, 3, 1024):
        got = sorted(map(tuple, pairs_within(rows, ["g"], "i", block).collect()))
        assert got == sorted((g, x, y) for g, n in sizes.items() for y in range(n) for x in range(y))
    assert pairs_within(rows.limit(0), ["g"], "i").collect() == []


def test_group_pairs_of_one_group(spark):
    """All suppliers in one group."""
    rows = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").withColumn("one", F.lit(1))
    n = rows.count()
    got = jo.group_pairs(rows, ["one", "s_nationkey"], "s_suppkey", "s_acctbal")
    assert got.count() == n * (n - 1) // 2


@pytest.mark.parametrize("block", [None, "label"])
def test_nearest_neighbours(spark, block):
    """Clusters, copies, ties at whole numbers, a label of one row, and rows that take no part."""
    rng = np.random.default_rng(2)
    rows = [(int(i), int(i % 3), [float(x) for x in rng.integers(0, 3, 4) + 10 * (i % 5)]) for i in rng.permutation(160)]
    rows += [(200 + i, 0, [1.0, 1.0, 1.0, 1.0]) for i in range(30)] + [(300, 9, [0.0] * 4), (301, 1, [1e3] * 4)]
    odd = [(400, None, [1.0] * 4), (401, 1, None), (402, 1, [1.0, None, 1.0, 1.0]), (None, 1, [1.0] * 4)]
    table = spark.createDataFrame(rows + odd, "id long, label int, vec array<double>").repartition(4)
    if block is None:
        rows = rows + [(400, None, [1.0] * 4)]
    want = {}
    for i, label, v in rows:
        near = sorted((math.dist(v, w), j) for j, other, w in rows if j != i and (block is None or other == label))
        want |= {(i, k + 1): (j, d) for k, (d, j) in enumerate(near[:4])}
    got = {(r.a, r["rank"]): (r.b, r.dist) for r in knn_of_vectors(table, "id", "vec", 4, block).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    assert knn_of_vectors(table.limit(0), "id", "vec", 4).collect() == []


def test_quantiles_of_a_hot_value(spark):
    values = [5.0] * 800 + [float(v) for v in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    got = ag.quantiles(df, F.col("v"), {f"q{p}": p / 100 for p in (0, 1, 50, 86, 99, 100)}).first()
    assert np.allclose(list(got), np.quantile(values, [0, 0.01, 0.5, 0.86, 0.99, 1]))


def test_similarity_join_of_copies_and_a_hot_hash(spark):
    """Groups of copies, near copies, and a passage that most sequences share."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    hot, base = word(80), [word(150) for _ in range(4)]
    texts = [(i, hot + base[i % 4] + ("" if i % 3 else "ACGTTGCA")) for i in range(24)] + [(100 + i, hot + word(120)) for i in range(20)] + [(200, None), (201, "AC")]
    df = spark.createDataFrame(texts, "id int, seq string").repartition(3).select("id", seq.sketch(F.col("seq"), 15, 100, numbers=True).alias("s")).cache()
    for most in (0.005, 0.03):
        want = df.alias("x").join(df.alias("y"), F.col("x.id") < F.col("y.id")).where(F.size("x.s") > 0).where(F.size("y.s") > 0)
        want = want.select("x.id", "y.id", seq.sketch_distance(F.col("x.s"), F.col("y.s"), 15, 100).alias("d")).where(F.col("d") <= most)
        want = sorted((a, b, round(d, 12)) for a, b, d in want.collect())
        got = sorted((a, b, round(d, 12)) for a, b, d in jo.similarity_join(df, "id", "s", 15, most, 100).collect())
        assert got == want and len(want) >= 60


def test_sketches_of_long_and_repetitive_sequences(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 4, 5, 30, 200, 4000)] + ["abc" * 2000, "ab" * 900 + "".join(rng.choice("abcdef") for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = df.select("i", seq.sketch(F.col("s"), 5, 40, canonical=False).alias("t"), seq.sketch(F.col("s"), 5, 40, canonical=False, numbers=True).alias("n")).collect()
    for r in got:
        want = sorted({hashlib.md5(f"123:{texts[r.i][j:j + 5]}".encode()).hexdigest() for j in range(len(texts[r.i]) - 4)})[:40]
        assert r.t == want and r.n == [int(h[:15], 16) for h in want]


def test_ancestors_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"t{k:04d}", f"t{k + 1:04d}") for k in range(1000)] + [(None, "x"), ("y", None)], "id string, parent string")
    found = on.ancestors(edges)
    chain = {r.ancestor: r.depth for r in found.where("id = 't0000'").collect()}
    assert chain == {f"t{k:04d}": k for k in range(1001)} and found.count() == 1001 * 1002 // 2


def test_ancestors_by_several_ways_and_on_a_cycle(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("d", "e"), ("e", "f"), ("x", "c"), ("a", "d")]
    got = {(r.id, r.ancestor): r.depth for r in on.ancestors(spark.createDataFrame(edges, "id string, parent string")).collect()}
    assert got[("a", "d")] == 1 and got[("a", "f")] == 3 and got[("x", "f")] == 4 and got[("b", "e")] == 3 and got[("a", "a")] == 0 and len(got) == 26
    for loop in ([("f", "a")], [("f", "f")], [("c", "b")]):
        with pytest.raises(ValueError, match="ancestor"):
            on.ancestors(spark.createDataFrame(edges + loop, "id string, parent string"), on_cycle="raise")
    around = on.ancestors(spark.createDataFrame([(f"c{k}", f"c{(k + 1) % 7}") for k in range(7)], "id string, parent string"))
    assert sorted((r.id, r.ancestor, r.depth) for r in around.collect()) == sorted((f"c{k}", f"c{(k + d) % 7}", d) for k in range(7) for d in range(7))
    assert on.ancestors(spark.createDataFrame([], "id string, parent string")).count() == 0


def test_permutations_of_a_given_distance_table(spark):
    """10,000 permutations on the cells of markets: p as in the vector form, F as in SQL's sums."""
    from florilege.operators import statistics as stt
    from florilege.plans import models
    from florilege.plans.catalogue import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    given = models.t2_permanova_given(t).first()
    rows = models._cells(t).cache()
    vectors = stt.permanova_of_vectors(rows, "id", "vec", "label", n_perm=10000).first()
    assert abs(given.f - vectors.f) < 1e-9 and abs(given.r2 - vectors.r2) < 1e-9 and abs(given.p - vectors.p) < 0.02
    # groups that lie apart, and equal ones
    df = spark.createDataFrame([(i, "ab"[i % 2], [float(i % 2), i * 0.001]) for i in range(16)], "id int, label string, vec array<double>")
    pairs = stt.pair_distances(df, "id", "vec")
    far = stt.permanova(pairs, df.select("id", "label"), n_perm=2000).first()
    assert far.p < 0.01
    flat = stt.permanova(pairs, df.select("id", F.when(F.col("id") < 8, "a").otherwise("b").alias("label")), n_perm=2000).first()
    assert flat.p > 0.5
    several = {(r.group1, r.group2): r for r in stt.pairwise_permanova(pairs, df.select("id", F.concat("label", (F.col("id") % 4).cast("string")).alias("label")), n_perm=500).collect()}
    assert len(several) == 6 and several[("a0", "b1")].p < 0.1 < several[("a0", "a2")].p


def test_sketch_kernel_on_odd_texts(spark):
    """Letters of one to four bytes, null, too short ones, and k-mers of more than one block of the digest."""
    texts = ["", None, "abc", "日本語" * 40 + "abc" * 30 + "é🎉" * 50, "x" * 20, "x" * 21, "ab" * 300_000 + "日本" * 300, "xyz" * 7]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    for k in (21, 70):
        for r in df.select("i", seq.sketch(F.col("s"), k, 100, canonical=False, numbers=True).alias("n")).collect():
            s = texts[r.i] or ""
            assert r.n == sorted({int(hashlib.md5(f"123:{s[j:j + k]}".encode()).hexdigest()[:15], 16) for j in range(len(s) - k + 1)})[:100]
    a, b = [1, 3, 5, 9], [3, 4, 5, 7, 9]
    for cast in (int, str):
        kind = "array<long>" if cast is int else "array<string>"
        pairs = spark.createDataFrame([([cast(v) for v in a], [cast(v) for v in b]), ([], []), (None, [cast(1)])], f"a {kind}, b {kind}")
        assert [[r[0] for r in pairs.select(seq.sketch_jaccard(F.col("a"), F.col("b"), s)).collect()] for s in (1, 3, 100)] == [[0.0, 0.0, None], [1 / 3, 0.0, None], [0.5, 0.0, None]]


def test_similarity_join_writes_no_sketches(spark, tmp_path):
    """What it writes is a small part of the sketches, and pairs by frequent hashes alone are found."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    hot = word(60)
    texts = [(i, word(1500)) for i in range(300)] + [(1000 + i, hot[: 50 + 5 * (i % 3)]) for i in range(90)]
    df = spark.createDataFrame(texts, "id long, text string").select("id", seq.sketch(F.col("text"), 21, 1000, canonical=False, numbers=True).alias("s"))
    size = lambda path: sum(p.stat().st_size for p in path.rglob("*.parquet"))
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = size(shared)
    got = jo.similarity_join(df, "id", "s", 21, 0.00123693, 1000).collect()
    assert sorted((r.a, r.b) for r in got) == [(1000 + i, 1000 + j) for i in range(90) for j in range(i + 1, 90) if i % 3 == j % 3]
    df.write.parquet(f"{tmp_path}/sketches")
    assert size(shared) - before < size(tmp_path / "sketches") / 4


def test_sketch_distances_write_only_sketches_that_are_compared(spark, tmp_path):
    from florilege.plans import catalogue

    size = lambda path: sum(p.stat().st_size for p in path.rglob("*.parquet"))
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = size(shared)
    assert catalogue.queries()["x24_sketch_distance"](spark, "/root/testdata/sf0.001").count() > 10
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.select(seq.sketch(F.col("text"), 21, 1000, canonical=False, numbers=True)).write.parquet(f"{tmp_path}/sketches")
    assert size(shared) - before < size(tmp_path / "sketches") / 2


@pytest.mark.parametrize("numbers", [True, False])
def test_all_distances_in_packs(spark, numbers):
    """Packs of few rows, a passage that most share, copies, short texts: against each pair by itself."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    hot = word(70)
    texts = [(i, hot + word(rng.randrange(200))) for i in range(30)] + [(100 + i, word(60)) for i in range(10)] + [(200 + i, hot) for i in range(4)] + [(300, "AC"), (None, hot)]
    df = spark.createDataFrame(texts, "id int, seq string").repartition(3).select("id", seq.sketch(F.col("seq"), 15, 60, canonical=False, numbers=numbers).alias("s")).cache()
    want = df.alias("x").join(df.alias("y"), F.col("x.id") < F.col("y.id")).where(F.arrays_overlap("x.s", "y.s"))
    want = sorted(map(tuple, want.select("x.id", "y.id", seq.sketch_distance(F.col("x.s"), F.col("y.s"), 15, 60)).collect()))
    for pack in (7, 1024):
        assert sorted(map(tuple, jo.all_distances(df, "id", "s", 15, 60, pack).collect())) == want and len(want) > 400
    assert jo.all_distances(df.limit(0), "id", "s", 15, 60).collect() == []


def test_nearest_neighbours_do_not_copy_vectors_to_each_cell(spark):
    """Vectors that point everywhere ask most cells; what is shuffled for it grew with their number."""
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=32)]) for i in range(1500)], "id long, vec array<double>").repartition(3).cache()
    got = knn_of_vectors(table, "id", "vec", 3)
    assert got.count() == 3 * 1500
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    x = np.array([r.vec for r in table.orderBy("id").collect()])
    first = {r.a: r.b for r in got.where("rank = 1").collect()}
    for i in range(0, 1500, 50):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        assert first[i] == int(d.argmin())


def test_distances_of_all_pairs_in_packs(spark, monkeypatch):
    """Packs of few rows, vectors of other lengths, with nulls and null, and no join of single rows of vectors."""
    from florilege.operators import statistics as stt

    monkeypatch.setattr(stt, "PACK", 7)
    rng = np.random.default_rng(4)
    data = [(i, "ab"[i % 2], [float(v) for v in rng.normal(size=3)]) for i in range(40)] + [(50, "a", [1.0, 2.0]), (51, "a", [2.0, 2.0]), (52, "a", None), (53, "b", [1.0, None, 1.0]), (54, None, [1.0] * 3), (None, "a", [1.0] * 3)]
    df = spark.createDataFrame(data, "id int, g string, vec array<double>").repartition(3)
    for block in (None, "g"):
        got = stt.pair_distances(df, "id", "vec", block)
        known = [r for r in data if r[0] is not None and (block is None or r[1])]
        whole = lambda v: v is not None and None not in v
        want = {(p[0], q[0]): math.dist(p[2], q[2]) if whole(p[2]) and whole(q[2]) and len(p[2]) == len(q[2]) else None for p in known for q in known if p[0] < q[0] and (block is None or p[1] == q[1])}
        rows = {(r.a, r.b): r.dist for r in got.collect()}
        assert rows.keys() == want.keys() and got.count() == len(want)
        assert all(rows[k] == want[k] or abs(rows[k] - want[k]) < 1e-12 for k in want)
    assert "zip_with" not in got._jdf.queryExecution().optimizedPlan().toString()
