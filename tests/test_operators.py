"""Catalogue operators on small frames: null keys, ties, duplicates, empty tables."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from florilege.functions import sequence as seq
from florilege.functions import text as tx
from florilege.functions.similarity import ratio, token_set_ratio, wratio
from florilege.operators import aggregates as ag
from florilege.operators import columns as co
from florilege.operators import filters as fi
from florilege.operators import joins as jo
from florilege.operators import ontology as on
from florilege.operators import sets as st
from florilege.operators import statistics as stt
from florilege.operators import windows as wi
from florilege.operators.strings import similar_pairs
from florilege.plans import catalogue
from florilege.plans import composites as cp


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_recode_strict_fails_on_unknown(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    assert rows(co.recode(df, "x", {"a": 1}, strict=True)) == [(1,), (None,)]
    with pytest.raises(PySparkException):
        co.recode(spark.createDataFrame([("b",)], "x string"), "x", {"a": 1}, strict=True).collect()


def test_filters_and_nulls(spark):
    df = spark.createDataFrame([(1, "Plasmid one", "complete", ""), (2, "CHROMOSOME", None, "Complete Genome"), (3, None, " ", None), (4, "gene", "complete", "Scaffold")], "id int, d string, a string, b string")
    assert rows(fi.exclude_matching(df, "d", "chromosome").select("id")) == [(1,), (3,), (4,)]
    assert rows(fi.completeness_filter(df, "a", "complete", "b", "Complete Genome").select("id")) == [(1,), (2,)]
    ref = spark.createDataFrame([("a", "b"), ("b", None), (None, "z"), ("c", "a")], "k string, r string")
    assert rows(fi.exclude_referenced(ref, "k", "r").select("k")) == [("c",), (None,)]
    tags = spark.createDataFrame([("disease,host", ""), (None, None), ("diseases", "x")], "t string, f string")
    assert rows(fi.check_flag(fi.flag_tag(tags, "t", "disease", "w"), "w", "f", "c").select("w", "c")) == [(False, False), (False, False), (True, True)]


def test_validated_join_raises(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        jo.validated_join(left, right, ["k"])
    assert jo.validated_join(left, right, ["k"], validate="m:m").count() == 3


def test_pick_best_and_ties(spark):
    df = spark.createDataFrame([("g", 1, None), ("g", 2, 5), ("g", 3, 5), ("h", 4, None)], "g string, id int, s int")
    assert rows(wi.pick_best(df, ["g"], ["s"], "id").select("g", "id")) == [("g", 2), ("h", 4)]
    assert rows(wi.tie_count(df, ["g"], ["s"], "id").select("id", "tied")) == [(2, True), (4, False)]


def test_deduplicate_keeps_null_content_apart(spark):
    df = spark.createDataFrame([(1, "ACGT", 1), (2, "ACGT", 9), (3, None, 1), (4, None, 2), (5, "TTTT", 1), (6, "AAAA", 3)], "id int, seq string, s int")
    assert rows(cp.deduplicate(df, "id", "seq", ["s"])) == [(1, 2, 2), (2, 2, 2), (3, 3, 1), (4, 4, 1), (5, 5, 1), (6, 6, 1)]
    both = rows(cp.deduplicate(df, "id", "seq", ["s"], both_strands=True))
    assert (5, 6, 2) in both and (6, 6, 2) in both
    assert cp.deduplicate(df.limit(0), "id", "seq", ["s"]).count() == 0


def test_release_diff_of_itself_is_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert jo.release_diff(df, df, "k").count() == 0
    new = spark.createDataFrame([(2, None), (3, "y")], "k int, v string")
    gone = spark.createDataFrame([(1,)], "k int")
    assert rows(jo.release_diff(new, df, "k", reasons=[(gone, "k", "filtered")])) == [(1, "Removed", "", "filtered"), (2, "Changed", "v", ""), (3, "Added", "", "")]


def test_proximity_dedup_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    data = [(i, rng.randrange(3), s := rng.randrange(200), s + rng.randrange(40)) for i in range(150)]
    df = spark.createDataFrame(data, "id int, part int, s int, e int")
    near = lambda a, b: a[1] == b[1] and abs(a[2] - b[2]) <= 7 and abs(a[3] - b[3]) <= 7
    want = sorted(a[0] for a in data if not any(near(a, b) and b[0] < a[0] for b in data))
    assert sorted(r.id for r in jo.proximity_dedup(df, ["part"], "s", "e", 7, [], "id").collect()) == want


def test_similarity_join_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    base = ["".join(rng.choice("ACGT") for _ in range(120)) for _ in range(6)]
    texts = [(i, base[i % 6][: 118 + i % 3]) for i in range(18)] + [(99, "ACG")]
    df = spark.createDataFrame(texts, "id int, seq string").select("id", seq.sketch(F.col("seq"), 15, 60).alias("s"))
    all_pairs = df.alias("x").join(df.alias("y"), F.col("x.id") < F.col("y.id")).select(F.col("x.id"), F.col("y.id"), seq.sketch_distance(F.col("x.s"), F.col("y.s"), 15, 60).alias("d")).where("d <= 0.02")
    assert rows(jo.similarity_join(df, "id", "s", 15, 0.02, 60)) == rows(all_pairs)


def test_chain_hits(spark):
    hits = spark.createDataFrame([("q", 1, 10, 50, 10, 100.0), ("q", 11, 20, 50, 9, 90.0), ("q", 40, 45, 50, 6, 80.0), ("r", 5, 9, 10, 5, 50.0), ("r", 6, 9, 0, 6, 50.0)], "q string, s int, e int, n int, l int, i double")
    assert rows(ag.chain_hits(hits, ["q"], "s", "e", "n", "l", "i")) == [("q", 0, 20, 20, 95.0, 38.0), ("r", 6, 9, 6, 50.0, None)]  # a chain from 1 on extends the empty one, which starts at 0


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    table = [("a", float(v)) for v in rng.normal(size=501)] + [("b", float(v)) for v in rng.integers(0, 3, 200)] + [("c", 7.0), ("c", None), (None, 1.5)]
    df = spark.createDataFrame(table, "g string, v double").repartition(5)
    got = {r[0]: r[1:] for r in ag.quantiles(df, F.col("v"), {"q1": 0.25, "m": 0.5, "p99": 0.99}, [F.col("g")]).collect()}
    for g in ("a", "b", "c", None):
        assert np.allclose(got[g], np.quantile([v for k, v in table if k == g and v is not None], [0.25, 0.5, 0.99]))
    whole = ag.quantiles(df, F.col("v"), {"m": 0.5}).first()
    assert np.isclose(whole.m, np.median([v for _, v in table if v is not None]))
    assert ag.quantiles(df.limit(0), F.col("v"), {"m": 0.5}).first().m is None


def test_outliers_take_the_first_reason(spark):
    df = spark.createDataFrame([(i, float(10 + i % 3), 5.0, None) for i in range(40)] + [(90, 5000.0, 5.0, None), (91, 5000.0, 5.0, "x"), (92, 11.0, 900.0, None), (93, 11.0, None, "x")], "id int, a double, b double, e string")
    got = dict(rows(cp.outlier_status(df, "id", {"a": True, "b": False}, 1.5, ["e"], ("a", 0, 1000), df.where("id in (90, 93)"))))
    assert got == {90: "outlier without evidence", 91: "out of range", 92: "outlier without evidence", 93: "listed"}


def test_ancestors_stop_at_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), (None, "q")], "id string, parent string")
    found = rows(on.ancestors(edges).where("id = 'x'"))
    assert found == [("x", "a", 1), ("x", "b", 2), ("x", "c", 3), ("x", "x", 0)]


def test_canonical_pairs_are_symmetric(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.4), (3, 3, 0.0)], "a int, b int, dist double")
    assert rows(jo.canonical_pairs(df)) == rows(jo.canonical_pairs(df.select(F.col("b").alias("a"), F.col("a").alias("b"), "dist"))) == [(1, 2, 0.4)]


def test_batches_and_schema_diff(spark):
    df = spark.range(25).withColumnRenamed("id", "k")
    assert rows(st.assign_batch(df, "k", size=10).groupBy("batch").count()) == [(0, 10), (1, 10), (2, 5)]
    assert rows(st.schema_diff(df, df.withColumn("v", F.lit(1))).select("column", "status")) == [("k", "same"), ("v", "removed")]


def test_scalars(spark):
    df = spark.createDataFrame([("53.5;10", "gccNN", "CDS")], "c string, s string, t string")
    lat, lng = tx.parse_latlng(F.col("c"))
    row = df.select(lat, lng, seq.gc_fraction(F.col("s")), seq.reverse_complement(F.col("s")), tx.haversine_km(lat, lng, lat, lng), tx.midpoint(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(10.0))[1]).first()
    assert row[0] == 53.5 and row[1] == 10 and row[2] == 1.0 and row[3] == "NNggc" and row[4] == 0 and round(row[5], 9) == 5


def test_scorers(spark):
    pairs = [("", ""), ("abc", "abc"), ("a", "b"), ("new york", "york new city"), ("b a", "a b")]
    df = spark.createDataFrame(list(zip(range(5), *zip(*pairs), strict=False)), "i int, a string, b string")
    got = df.select(*(f(F.col("a"), F.col("b")) for f in (ratio, token_set_ratio, wratio))).collect()
    assert [r[0] for r in got[:3]] == [100, 100, 0]
    assert got[3][1] == 100
    assert got[4][2] >= 95


def test_fuzzy_cascade_takes_the_first_rung(spark):
    queries = spark.createDataFrame([("lung disease",), ("disease of lungs",), ("nothing",)], "q string")
    vocab = spark.createDataFrame([("Lung Disease",), ("heart disease",)], "t string")
    out = rows(jo.fuzzy_cascade(queries, "q", [(vocab, "t", lambda a, b: tx.levenshtein_ratio(F.lower(a), F.lower(b)), 90.0), (vocab, "t", token_set_ratio, 60.0)]).select("query", "term", "rung"))
    assert out == [("disease of lungs", "Lung Disease", 2), ("lung disease", "Lung Disease", 1)]


def test_typing_table(spark):
    types = spark.createDataFrame([("p1", "IncF"), ("p2", "-")], "sample_id string, rep string")
    mlst = spark.createDataFrame([("p1", "IncF", 12), ("p1", "IncN", None)], "sample_id string, scheme string, sequence_type int")
    assert rows(cp.typing_table(types, mlst, "sample_id")) == [("p1", "IncF", "IncF:ST12;IncN:"), ("p2", None, None)]


def test_viral_curation(spark):
    scores = spark.createDataFrame([("a|1", 0.99, 2), ("b|1", 0.96, 0), ("b|2", 0.1, 0), ("d|1", 0.5, 3), ("e|1", 0.1, 0), ("f|1", 0.1, 0)], "contig string, max_score double, hallmark long")
    cont = spark.createDataFrame([("a|1", 3, 0), ("b|1", 0, 4), ("b|2", 1, 0), ("c|1", 0, 4), ("d|1", 0, 9), ("e|1", 0, 1)], "contig string, viral_genes long, host_genes long")
    genes = spark.createDataFrame([("d__1", "Endonuclease", None), ("a__1", "endonuclease", None), ("b__1", None, "other")], "gene string, gene_description string, module string")
    contigs, records = cp.viral_curation(scores, cont, genes, "contig", ["endonuclease"])
    assert rows(contigs.select("contig", "category", "putative")) == [("a|1", "likely_viral_1", True), ("b|1", "likely_viral_2", True), ("b|2", "likely_viral_1", True), ("c|1", "mostly_non-viral", False), ("e|1", "mostly_mge", False), ("f|1", "undefined", False)]
    assert ("b", "likely_viral_1-2", True) in rows(records) and records.count() == 5


def test_merge_reports_removes_only_repeated_symbols(spark):
    schema = "rec string, gene string, strand string, s int, e int, id int"
    one = spark.createDataFrame([("r", "blaX", "+", 10, 20, 1), ("r", "other", "+", 12, 22, 2)], schema)
    two = spark.createDataFrame([("r", "X", "+", 11, 21, 3), ("r", "X", "-", 11, 21, 4), ("r", "X", "+", 10, 20, 5)], schema)
    got = cp.merge_reports({"a": (one, {}, {}), "b": (two, {}, {})}, "gene", "a", "b", "bla", ["rec"], "strand", "s", "e", 5, "id")
    assert rows(got.select("id")) == [(1,), (2,), (4,)]


def test_feature_tables(spark):
    feats = spark.createDataFrame([("r", "CDS", "tetA", "", "t1", 9, 2, "p1", "MK"), ("r", "gap", "x", "", "", 1, 1, None, None)], "id string, type string, gene string, product string, locus_tag string, start long, end long, protein_id string, translation string")
    over = feats.where("gene = 'tetA'").withColumn("gene", F.lit("TETA")).withColumn("start", F.lit(3).cast("long"))
    named, seqs, proteins = cp.feature_tables(feats, over, spark.createDataFrame([("r", "GGCC")], "id string, seq string"))
    assert rows(named.select("name", "start", "end")) == [("", 1, 1), ("TETA", 2, 3)]
    assert rows(seqs) == [("r", 1.0, 4)] and rows(proteins) == [("p1", "r", "MK")]


def test_permutations_of_slots_are_permutations():
    keys = np.random.default_rng(0).integers(0, 2**32, (2000, stt.ROUNDS), np.uint32)
    for n in (1, 2, 7, 30, 101):
        moved = stt.permuted_slots(np.arange(n), n, keys)
        assert (np.sort(moved, 1) == np.arange(n)).all()
    moved = stt.permuted_slots(np.arange(7), 7, keys)
    assert all(abs(np.bincount(moved[:, i], minlength=7) / 2000 - 1 / 7).max() < 0.04 for i in range(7))


def test_tests_of_vectors_equal_those_of_pairs(spark):
    rng = np.random.default_rng(3)
    table = [(i, "abc"[i % 3], [float(v) for v in rng.normal(0.35 * (i % 3 == 2), 1, 2) + 50]) for i in range(60)]
    df = spark.createDataFrame(table, "id long, label string, vec array<double>")
    pairs, groups = stt.pair_distances(df, "id", "vec"), df.select("id", "label")
    one, given = stt.permanova_of_vectors(df, "id", "vec", "label", 999).first(), stt.permanova(pairs, groups, 399).first()
    assert one.f == pytest.approx(given.f) and one.r2 == pytest.approx(given.r2) and abs(one.p - given.p) < 0.1
    got = {(r.group1, r.group2): r for r in stt.pairwise_permanova_of_vectors(df, "id", "vec", "label", 999).collect()}
    want = {(r.group1, r.group2): r for r in stt.pairwise_permanova(pairs, groups, 399).collect()}
    assert got.keys() == want.keys() and len(got) == 3
    assert all(got[k].f == pytest.approx(want[k].f) and got[k].r2 == pytest.approx(want[k].r2) and abs(got[k].p - want[k].p) < 0.1 for k in got)


def test_tests_cover_all_nations_with_a_production_p(spark):
    q = catalogue.queries()
    rows = q["t3_pairwise_permanova"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 10 and all(abs(r.p * 10001 - round(r.p * 10001)) < 1e-6 for r in rows)
    orders, customers = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("orders", "customer"))
    assert q["t4_dispersion_all"](spark, "/root/testdata/sf0.001").count() == customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").count()


def test_every_term_within_the_edits_is_found(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abc"), rng.integers(0, 24))) for _ in range(120)]

    def misspelt(w):
        w = list(w)
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(w) + 1))
            w[at : at + int(rng.integers(0, 2))] = rng.choice(list("abcd"), rng.integers(0, 2)).tolist()
        return "".join(w)

    queries = spark.createDataFrame([(misspelt(w),) for w in words] + [("tuberculosys",), (None,)], "query string").distinct()
    terms = spark.createDataFrame([(w,) for w in words] + [("tuberculosis",), (None,)], "term string").distinct()
    score = tx.levenshtein_ratio(F.col("query"), F.col("term"))
    for least in (80, 90):
        want = rows(queries.na.drop().crossJoin(terms.na.drop()).where(score >= least))
        assert rows(similar_pairs(queries.na.drop(), terms.na.drop(), tx.levenshtein_ratio, least).select("query", "term")) == want and len(want) > 60
    found = rows(jo.fuzzy_cascade(queries, "query", [(terms, "term", tx.levenshtein_ratio, 90.0)]).select("query", "term"))
    assert ("tuberculosys", "tuberculosis") in found


def test_rank_statistics_with_ties_and_nulls(spark):
    rng = np.random.default_rng(6)
    data = [(int(rng.integers(0, 3)) or None, "ab"[int(rng.integers(0, 2))], float(rng.integers(0, 12)) if rng.random() > 0.1 else None, i) for i in range(400)]
    df = spark.createDataFrame(data, "by int, g string, v double, id long").repartition(7)
    for r in wi.rank_sum(df, "g", "v", ["by"], "a", "b").collect():
        a, b = ([v for k, g, v, _ in data if k == r.by and g == side and v is not None] for side in "ab")
        assert (r.n1, r.n2) == (len(a), len(b)) and r.u == sum((x > y) + (x == y) / 2 for x in a for y in b)
    p = df.withColumn("p", F.col("v") / 12)
    got = {r.id: r.p_adjusted for r in wi.bh_adjust(p, "p", ["by"], "id").collect()}
    assert len(got) == 400
    for k in {k for k, *_ in data}:
        known = sorted((v / 12, i) for j, _, v, i in data if j == k and v is not None)
        raw = [q * len(known) / n for n, (q, _) in enumerate(known, 1)]
        assert all(abs(got[i] - min(1.0, *raw[n:], raw[-1])) < 1e-12 for n, (_, i) in enumerate(known))
    assert all(got[i] is None for *_, v, i in data if v is None)
    assert wi.bh_adjust(p.limit(0), "p", ["by"], "id").count() == wi.rank_sum(df.limit(0), "g", "v", ["by"], "a", "b").count() == 0


def test_kmers_across_blocks(spark):
    texts = ["", None, "abc", "é" * 3 + "".join(chr(97 + i * i % 26) for i in range(2 * seq.BLOCK + 5)), "x" * seq.BLOCK, "y" * (seq.BLOCK + 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, s string").select("i", seq.kmers(F.col("s"), 5).alias("m"))
    assert {r.i: r.m for r in df.collect()} == {i: [s[j : j + 5] for j in range(len(s) - 4)] if s else [] for i, s in enumerate(texts)}


def test_outliers_among_empty_documents_are_those_of_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(10**6 + i, "", "en", "web", 0) for i in range(4)] + [(10**6 + 9, None, "en", "web", None), (10**6 + 10, "e", "en", "web", 0)]
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    tables = {"documents": docs.union(spark.createDataFrame(odd, docs.schema)), "labels": labels.union(spark.createDataFrame([(10**6 + 1, 1, 0)], labels.schema))}
    con = duckdb.connect()
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = rows(catalogue.queries()["c11_outlier_status"](spark, str(tmp_path)))
    assert got == sorted(con.sql(catalogue.oracle_sql()["c11_outlier_status"]).fetchall(), key=repr)
    assert dict(got)[10**6] == "outlier without evidence" and dict(got)[10**6 + 1] == "out of range" and 10**6 + 9 not in dict(got)


def test_merged_reports_leave_out_crowded_hits_by_one_join(spark):
    """Before, the hits that stay were joined back twice with all that repeat."""
    schema = "rec string, gene string, strand string, s int, e int, id int"
    one = spark.createDataFrame([("r", "x", "+", s, s + 9, i) for i, s in enumerate((-25, -24, 0, 43, 44, 54, 65, 1000))], schema)
    got = cp.merge_reports({"a": (one, {}, {}), "b": (one.where("id < 0"), {}, {})}, "gene", "a", "b", "bla", ["rec"], "strand", "s", "e", 10, "id")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1
    assert rows(got.select("id")) == [(0,), (2,), (3,), (6,), (7,)]


def test_group_pairs_shuffle_no_pairs_and_send_no_parts_to_the_driver(spark):
    data = [(1, 5.0, "a", "u"), (2, 4.0, "a", "u"), (3, 4.0, "a", None), (4, 9.0, None, "u"), (5, 1.0, None, None), (5, 1.0, None, None)]
    df = spark.createDataFrame(data, "id int, n double, g string, h string")
    got = jo.group_pairs(df, ["g", "h"], "id", "n")
    assert rows(got) == [(1, 4), (2, 1), (2, 3), (2, 4), (3, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < (plan.index("Aggregate") if "Aggregate" in plan else len(plan)) and "strategy=merge" in plan
    twice = df.union(spark.createDataFrame([(2, 4.5, "a", "v")], df.schema))
    assert rows(jo.group_pairs(twice, ["g", "h"], "id", "n")) == [(1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2)]
