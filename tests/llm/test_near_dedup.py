"""Near-duplicate documents and link components against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from florilege.llm.components import connected_components
from florilege.llm.near_dedup import drop_near_duplicates, near_duplicates

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(docs, percent):
    sets = {i: shingle_set(t) for i, t in docs}
    top = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(top[a], top[b])
            if top[a] != low or top[b] != low:
                top[a] = top[b] = low
                changed = True
    return {i: (len(sets[i]), top[i]) for i in sets}


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{k}é" for k in range(400)]
    base = [[rng.choice(vocab) for _ in range(n)] for n in (3, 4, 5, 6, 40, 80, 200, 400)]
    docs = []
    for words in base:
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            docs.append(" ".join(copy).upper() if rng.random() < 0.2 else " \n".join(copy))
    docs += ["", None, " \t\n", docs[0], "x" * 5000]
    rng.shuffle(docs)
    return list(enumerate(docs, 10))


def test_near_duplicates_equal_brute_force(spark):
    docs = corpus()
    for percent in (80, 85):
        got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(docs, SCHEMA), percent=percent).collect()}
        want = brute(docs, percent)
        assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
        assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F"), (3, None)], SCHEMA).withColumn("id", F.lit("clash")).withColumn("text_a", F.lit(1))
    got = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (None, 2, None, True)], key=repr)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 3, None]
    assert near_duplicates(df.limit(0)).count() == 0 and drop_near_duplicates(df.limit(0)).count() == 0


def test_names_with_dots_and_long_texts(spark):
    long = " ".join(f"w{k * k}" for k in range(30000))
    rows = [(1, long, "x"), (2, long + " end", "y"), (3, "", "z"), (2, long + " end", "w")]
    df = spark.createDataFrame(rows, "`doc.id` long, `te.xt` string, `a.b` string")
    out = drop_near_duplicates(df, "doc.id", "te.xt")
    assert out.columns == df.columns and sorted(r[0] for r in out.collect()) == [1, 3]
    again = spark.createDataFrame([(5, "one two three", "b"), (5, "one two three", "a"), (6, "four", "c")], "doc_id long, text string, rate string")
    assert sorted(map(tuple, drop_near_duplicates(again).collect())) == [(5, "one two three", "a"), (6, "four", "c")]


def test_every_link_of_the_driver_table(spark):
    """op1's query against brute force: ids divisible by 100 against all rows, and the counts of shingles."""
    from florilege.llm.queries import op1_minhash_near_dedup

    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in op1_minhash_near_dedup(spark, folder).collect()}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    assert all(got[i].n_shingles == len(s) and got[i].kept == (got[i].component_id == i) for i, s in sets.items())
    for a in (i for i in sets if i % 100 == 0 and sets[i]):
        for b in sets:
            if sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                assert got[a].component_id == got[b].component_id


def test_without_the_estimate(spark):
    docs = corpus(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, SCHEMA), deviations=None).collect()}
    assert got == brute(docs, 80)


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(0)
    chain = [(int(a), int(a) + 1) for a in rng.permutation(60)]
    links = chain + [(1000, k) for k in range(1001, 1040)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got[k] for k in range(61)) == {0} and set(got[k] for k in range(1000, 1040)) == {1000}
