"""Similarity of strings against plain dynamic programs, and its joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from florilege.functions import similarity as sim
from florilege.functions.text import levenshtein_ratio
from florilege.operators import joins as jo
from florilege.operators.strings import similar_pairs
from florilege.plans import models
from florilege.plans.catalogue import Tables


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def brute_set(a, b):
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, [both, " ".join(sorted(z))])) for z in (x - y, y - x))
    return max(plain(left, right), *((plain(both, s) for s in (left, right)) if both else (0.0,)))


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return 100.0 * (1 - row[-1] / max(len(a), len(b))) if a or b else 100.0


BRUTE = {
    sim.ratio: lambda a, b: plain(a.lower(), b.lower()),
    sim.token_set_ratio: lambda a, b: brute_set(a.lower(), b.lower()),
    sim.wratio: lambda a, b: max(plain(a.lower(), b.lower()), 0.95 * plain(" ".join(sorted(a.lower().split())), " ".join(sorted(b.lower().split()))), 0.95 * brute_set(a.lower(), b.lower())),
    levenshtein_ratio: brute_edits,
}


def strings(seed, n):
    """Names of a few words with swapped, repeated, misspelt and single-letter words, and odd ones."""
    rng, words = random.Random(seed), ["tuberculosis", "lung", "acute", "disease", "of", "the", "Ärm", "a", "b", "日本", "mellitus", "diabetes"]
    out = {"", " ", "a", "ab", "b", "x y z", "a b c d e f", "disease", "tuberculosys xx", "tuberculosis", "diabetis melitus", "Diabetes Mellitus", "lung  lung", "lung\tdisease", "disease " * 30}
    while len(out) < n:
        some = [rng.choice(words) for _ in range(rng.randint(1, 4))]
        s = list(" ".join(some))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            k = rng.randrange(len(s) + 1)
            s[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "e"])
        out.add("".join(s))
    return sorted(out)


@pytest.fixture(scope="module")
def two(spark):
    a, b = strings(1, 90), strings(2, 80)
    return a, b, spark.createDataFrame([(x,) for x in a], "query string"), spark.createDataFrame([(x,) for x in b], "term string")


def test_scores(spark, two):
    a, b, queries, terms = two
    got = queries.crossJoin(terms).select("query", "term", sim.ratio(F.col("query"), F.col("term")).alias("r"), sim.token_set_ratio(F.col("query"), F.col("term")).alias("s"), sim.wratio(F.col("query"), F.col("term")).alias("w")).collect()
    assert len(got) == len(a) * len(b)
    for r in got:
        assert (r.r, r.s, r.w) == pytest.approx(tuple(BRUTE[f](r.query, r.term) for f in (sim.ratio, sim.token_set_ratio, sim.wratio)))
    none = spark.createDataFrame([(None, "a"), ("a", None)], "a string, b string").select(sim.wratio(F.col("a"), F.col("b")).alias("w"))
    assert [r.w for r in none.collect()] == [None, None]


@pytest.mark.parametrize(("scorer", "least"), [(levenshtein_ratio, 90), (levenshtein_ratio, 60), (levenshtein_ratio, 40), (sim.ratio, 85), (sim.ratio, 50), (sim.token_set_ratio, 80), (sim.token_set_ratio, 55), (sim.wratio, 80), (sim.wratio, 97)])
def test_no_pair_is_missing(two, scorer, least):
    a, b, queries, terms = two
    want = {(x, y): BRUTE[scorer](x, y) for x in a for y in b}
    want = {k: v for k, v in want.items() if v >= least}
    got = {(r.query, r.term): r.score for r in similar_pairs(queries, terms, scorer, least).collect()}
    assert got.keys() == want.keys() and len(want) > 10 and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_terms_without_a_common_token(spark):
    queries = spark.createDataFrame([("tuberculosys xx",), ("diabetis melitus",), (None,)], "q string")
    terms = spark.createDataFrame([("tuberculosis",), ("diabetes mellitus",), (None,)], "t string")
    got = sorted((r.query, r.term, round(r.score, 1)) for r in jo.fuzzy_cascade(queries, "q", [(terms, "t", sim.wratio, 80.0)]).collect())
    assert got == [("diabetis melitus", "diabetes mellitus", 90.9), ("tuberculosys xx", "tuberculosis", 81.5)]
    assert jo.fuzzy_cascade(queries.limit(0), "q", [(terms, "t", sim.wratio, 80.0)]).count() == 0
    with pytest.raises(ValueError):
        similar_pairs(queries.toDF("query"), terms.toDF("term"), lambda a, b: F.lit(1.0), 80)


@pytest.mark.parametrize("name", ["j16_fuzzy_cascade", "j16_fuzzy_terms"])
def test_the_registered_cascades(spark, name):
    """Every rung of the queries against all pairs."""
    t = Tables(spark, "/root/testdata/sf0.001")
    parts = t.part.collect()
    names, types = sorted({p.p_name for p in parts}), sorted({p.p_type for p in parts})
    if name == "j16_fuzzy_cascade":
        left = {p.p_name.lower() for p in parts}
        rungs = [(names, levenshtein_ratio, 90), (names, sim.wratio, 85), (types, sim.token_set_ratio, 80)]
    else:
        left = {f"{p.p_name} {p.p_type}".lower().replace("e", "") for p in parts}
        both, brands = sorted({f"{p.p_name} {p.p_type}" for p in parts}), sorted({f"{p.p_brand} {p.p_type}" for p in parts})
        rungs = [(both, sim.wratio, 92), (brands, sim.wratio, 88), (both, sim.token_set_ratio, 84), (brands, sim.token_set_ratio, 60)]
    want = {}
    for k, (terms, scorer, least) in enumerate(rungs):
        for x in sorted(left):
            hits = [(-BRUTE[scorer](x, y), y) for y in terms]
            hits = [h for h in hits if -h[0] >= least]
            if hits:
                want[x] = (min(hits)[1], round(-min(hits)[0], 6), k + 1)
                left = left - {x}
    got = {r["query"]: (r.term, r.score, r.rung) for r in getattr(models, name)(t).collect()}
    assert got == want
