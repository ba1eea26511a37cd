"""Line dedup, periodic runs and hard negatives: brute force, edge rows, the registered queries."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from florilege.llm import queries as q
from florilege.llm.hard_negatives import mine_hard_negatives
from florilege.llm.line_dedup import LineIndex, _hashes, drop_common_lines, write_line_index
from florilege.llm.perfect_hash import CountIndex
from florilege.llm.periodic_runs import collapse_runs, find_runs

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# lines


def test_perfect_hash_finds_all_keys_and_no_others():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 5000):
        keys, counts = rng.integers(0, 2**64, (n, 2), dtype=np.uint64), rng.integers(1, 10**6, n)
        if n > 2:
            keys[1, 0] = keys[0, 0]  # one half alone tells nothing
        index = CountIndex.from_bytes(CountIndex.of(keys, counts).to_bytes())
        assert index.find(keys).tolist() == counts.tolist()
        assert sorted(index._slots(keys).tolist()) == list(range(n))
        other = rng.integers(0, 2**64, (1000, 2), dtype=np.uint64)
        assert not index.find(other).any()
        if n == 5000:
            assert index.words.nbytes * 8 < 4 * n
    with pytest.raises(ValueError):
        CountIndex.of(np.ones((2, 2), np.uint64), np.ones(2))


def test_sharded_index_with_little_memory(spark, tmp_path):
    keys = [f"line {k}".encode() for k in range(3000)]
    h = _hashes(keys).view(np.int64)
    rows = spark.createDataFrame([(int(a), int(b), k + 1) for k, (a, b) in enumerate(h)], "h0 long, h1 long, n long")
    n = write_line_index(rows, str(tmp_path / "index"), shard_keys=100)
    assert n == 30
    index = LineIndex(f"file://{tmp_path}/index", n, resident=4000)
    assert index.find(_hashes(keys)).tolist() == list(range(1, 3001))
    assert index.size <= 4000 and not index.find(_hashes([b"no such line"])).any()


def brute_lines(texts, min_docs, min_chars):
    keys = [[x.strip(SPACE).translate(LOWER) for x in (t or "").split("\n")] for t in texts]
    n = Counter(k for own in keys for k in set(own))
    gone = {k for k, c in n.items() if c >= min_docs and len(k) >= min_chars}
    out = []
    for t, own in zip(texts, keys, strict=True):
        kept = "\n".join(x for x, k in zip((t or "").split("\n"), own, strict=True) if k not in gone)
        out.append((len(own), sum(k in gone for k in own), None if t is None else kept))
    return out


@pytest.mark.parametrize(("min_docs", "min_chars"), [(2, 1), (3, 4), (3, 0), (1, 1)])
def test_lines_against_brute_force(spark, min_docs, min_chars):
    texts = [None, "", "\n", "a\nb\n a \nA", "É\r\nÉ \né", "ÉÉ\nx", "b\t\n a", "common line\nmine", "COMMON LINE \nyours", " common line\n\nother\n", "\n\n", None, "", "a\nb\n a \nA", "ÉÉ", "x" * 300_000 + "\ncommon line", "日本\n日本語", "日本\n日本語"]
    docs = spark.createDataFrame([(k % 5 or None, t, k, -1) for k, t in enumerate(texts)], "id long, text string, h0 int, n_lines int").repartition(4)
    got = {r.h0: r for r in drop_common_lines(docs, min_docs=min_docs, min_chars=min_chars, shard_keys=2, resident=200).collect()}
    for k, want in enumerate(brute_lines(texts, min_docs, min_chars)):
        assert (got[k].n_lines, got[k].n_dropped, got[k].text) == want, k
        assert got[k].id == (k % 5 or None)


def test_lines_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert drop_common_lines(empty).collect() == [] and collapse_runs(empty).collect() == []


def test_op11(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in q.op11_line_dedup(spark, FOLDER).collect()}
    want = dict(zip(texts, brute_lines(list(texts.values()), 10, 1), strict=True))
    assert any(w[1] for w in want.values())
    assert {i: (r.n_lines, r.n_dropped, r.kept_sha256) for i, r in got.items()} == {i: (w[0], w[1], sha(w[2])) for i, w in want.items()}


# runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w):
    """By the definition: maximal stretches of each period, those of a smaller one first."""
    found = {}
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - p:
            s = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(6, 4 * p):
                found.setdefault((s, i - s + p), p)
            i += 1
    return sorted((s, n, p) for (s, n), p in found.items())


def brute_collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_against_brute_force():
    rng = np.random.default_rng(5)
    for trial in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            n = int(rng.choice([0, 1, 5, 6, 7, 8, 20, 64, 200, 900]))
            t = rng.integers(0, rng.choice([1, 2, 3, 60]), n)
            for _ in range(rng.integers(0, 4)):
                if n > 10:
                    p, a = int(rng.integers(1, n // 4 + 1)), int(rng.integers(0, n))
                    for i in range(a + p, min(n, a + int(rng.integers(3, 8)) * p)):
                        t[i] = t[i - p]
            texts.append(t.tolist())
        ids = [x for k, t in enumerate(texts) for x in (*t, -k - 1)]
        at, want = 0, []
        for t in texts:
            want += [(s + at, n, p) for s, n, p in brute_runs(t)]
            at += len(t) + 1
        assert list(map(tuple, find_runs(np.array(ids), np.array([len(t) for t in texts])).tolist())) == want, trial


def test_runs_of_each_period(spark):
    """A run of four periods, the shortest there is, for every period up to 70, and one word less of it, which is none."""
    for p in range(2, 71):
        filler = [f"f{k}" for k in range(p)]
        w = [*filler, *[f"w{k}" for k in range(p)] * 4, "end"]
        for text, n in ((w, 1), (w[: p + 4 * p - 1] + ["end"], 0)):
            number = {x: k for k, x in enumerate(text)}
            got = find_runs(np.array([number[x] for x in text] + [-1]), np.array([len(text)]))
            assert got.tolist() == [[p, 4 * p, p]] * n, p


def test_collapse_of_odd_rows(spark):
    texts = [None, "", " \n ", "a a a a a", "a a a a a a", "x  a\tb a b a b a b y", "É é É é É é É é z", ("long tale " * 30_000).strip(), "a b a b a b a b", "a b a b a b a b", "a a a a"]
    docs = spark.createDataFrame([(None if k == 3 else 7, k, t, "own") for k, t in enumerate(texts)], "id long, key int, text string, runs string").repartition(3)
    got = {r.key: r for r in collapse_runs(docs).collect()}
    assert got.keys() == set(range(len(texts)))
    for k, t in enumerate(texts):
        w = words_of(t)
        runs = [(0, 60_000, 2)] if k == 7 else brute_runs(w)
        assert (got[k].n_words, [tuple(r) for r in got[k].runs]) == (len(w), runs)
        assert got[k].text == (None if t is None else brute_collapsed(w, runs))


def test_op12(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in q.op12_periodic_runs(spark, FOLDER).collect()}
    assert got.keys() == texts.keys() and sum(r.n_runs > 0 for r in got.values()) > 10
    for i, t in texts.items():
        w, h = words_of(t), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        runs = brute_runs(w)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        row = got[i]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period, row.exponent_milli) == ((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2]))
        assert row.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in runs))
        assert row.collapsed_sha256 == sha(brute_collapsed(w, runs))


# negatives


def brute_negatives(rows, anchor, positives=5, negatives=5, low=80, high=100):
    """``rows``: id -> (label, integers)."""
    out = set()

    def score(a, b):
        return sum(x * y for x, y in zip(rows[a][1], rows[b][1], strict=False))

    for a in filter(anchor, rows):
        order = sorted((-score(a, b), b) for b in rows if b != a)
        same = [(b, -s) for s, b in order if rows[b][0] == rows[a][0]][:positives]
        other = [(b, -s) for s, b in order if rows[b][0] != rows[a][0]]
        for p, ps in same:
            for k, (b, s) in enumerate([x for x in other if low * ps <= 100 * x[1] <= high * ps][:negatives]):
                out.add((a, p, k + 1, b, ps, s))
    return out


@pytest.mark.parametrize("window", [(80, 100), (10, 95), (50, 130)])
def test_negatives_against_brute_force(spark, window):
    rng = np.random.default_rng(3)
    base = rng.integers(-3, 4, (12, 6))  # few directions, so many scores tie
    rows = {int(i): (int(rng.integers(0, 3)), base[rng.integers(0, 12)].tolist()) for i in rng.permutation(400)}
    rows |= {500 + k: (9, [5, 0, 0, 0, 0, 0]) for k in range(2)} | {600: (77, [1] * 6), 601: (1, [2, 2])}
    table = spark.createDataFrame([(i, label, v, "extra", 1) for i, (label, v) in rows.items()], "vec_id long, label int, embedding array<long>, score string, anchor int").repartition(5)
    got = mine_hard_negatives(table, F.pmod("vec_id", F.lit(20)) == 0, positives=3, negatives=4, window=window)
    assert len(found := [tuple(r) for r in got.collect()]) == len(set(found))
    assert set(found) == brute_negatives(rows, lambda i: i % 20 == 0, 3, 4, *window)


def test_negatives_of_odd_rows(spark):
    rows = [(0, 1, [1, 0]), (1, 1, [2, 0]), (2, 2, [2, 0]), (None, 2, [2, 0]), (3, None, [2, 0]), (4, 2, None), (5, 2, [None, 2]), (2, 2, [2, 0]), (6, 2, [2**40, 0]), (7, 2, [])]
    table = spark.createDataFrame(rows, "vec_id int, label int, embedding array<long>")
    got = mine_hard_negatives(table, F.col("vec_id") == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 2, 2)]
    assert mine_hard_negatives(table.limit(0), F.col("vec_id") == 0).collect() == []
    assert mine_hard_negatives(table, F.lit(None).cast("boolean")).collect() == []
    big = spark.createDataFrame([(0, 1, [2**40 + 1, 1]), (1, 1, [2**20, 1]), (2, 2, [2**20, 0])], "vec_id int, label int, embedding array<long>")
    assert [r.negative_score for r in mine_hard_negatives(big, F.col("vec_id") == 0).collect()] == [(2**40 + 1) * 2**20]


def test_op13(spark):
    folder = "/root/testdata/sf0.01"
    rows = {}
    for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            rows[r.vec_id] = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * float(x))) for x in r.embedding])
    got = q.op13_hard_negatives(spark, folder)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert set(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 100 == 0)
