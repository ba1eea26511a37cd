"""The other operators: round trips, brute force, held-out accuracy, edge rows."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from florilege.llm import fingerprints, language, mixing, pii, toxicity, url_filter
from florilege.llm.elias_fano import EliasFano
from florilege.llm.embedding_dedup import near_embeddings, nearest_e8
from florilege.llm.packing import pack_documents
from florilege.llm.shingles import text_buffers
from florilege.llm.token_files import read_token_digests, write_token_files
from florilege.llm.tokens import WordEncoder, vocabulary
from tests.llm.test_near_dedup import shingle_set

TEXTS = ["Hello, World! don't", "", None, "É,È. naïve 12,5 <|endoftext|> x<|STARTOFTEXT|>y", "a " * 5000, "日本語。 テスト", "..a b.. c!"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i * 7 % 11, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(3)


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary()).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 700):
        v = np.sort(rng.integers(0, 10**6, n))
        code = EliasFano.from_bytes(EliasFano.of(v).to_bytes())
        assert (code.all() == v).all() and all(code.select(i) == v[i] for i in range(n))
        assert all((code.span(a, b) == v[a:b]).all() for a, b in ((0, n), (n // 2, n), (n // 3, n // 3 + 1)) if a < b <= n)
    with pytest.raises(ValueError):
        EliasFano.of(np.array([2, 1]))


def test_token_files(spark, docs, tmp_path):
    manifest = write_token_files(docs, str(tmp_path / "t"), partitions=3).cache()
    manifest.count()
    got = sorted(map(tuple, read_token_digests(spark, str(tmp_path / "t"), manifest).collect()))
    at, want = 0, []
    for i, t in sorted((k * 7 % 11, t) for k, t in enumerate(TEXTS)):
        ids = [*encoded(t), 1]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    odd = spark.createDataFrame([(None, "x y", 1), (None, None, 2), (5, "a", 3), (5, "b b", 4), (-(2**63), "c", 5), (2**63 - 1, "d", 6)], "doc_id long, text string, name int")
    rest = write_token_files(odd, str(tmp_path / "odd"), partitions=1).cache()
    rest.count()
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in read_token_digests(spark, str(tmp_path / "odd"), rest).collect())
    assert [(i, n) for _, i, n in found] == [(None, 1), (None, 3), (-(2**63), 2), (5, 2), (5, 3), (2**63 - 1, 2)]
    none = write_token_files(docs.limit(0), str(tmp_path / "none"))
    assert read_token_digests(spark, str(tmp_path / "none"), none).count() == 0


def test_words_that_end_in_any_marks_share_their_letters():
    """Once for the letters and once for the marks, not once for each pair of them; the ids are the library's."""
    texts = ["ab$$$ Cd*** ef%%% ab### ab&&& ñí*** ab.### ab<|x|> ab''", "ab<|endoftext|> ab's ef'=\u0338 don't*", "x_y$$ 1$$ $$$"]
    words = WordEncoder(vocabulary())
    column = pa.array(texts)
    ids, counts = words.encode(*text_buffers(column))
    ends = np.cumsum(counts).tolist()
    assert [ids[b - n : b].tolist() for b, n in zip(ends, counts.tolist(), strict=True)] == [encoded(t) for t in texts]
    assert {"ab", "cd", "ef", "ñí", "$$$", ".###", "''"} <= words.known.keys() and not words.known.keys() & {"ab$$$", "Cd***", "ef%%%", "ab.###", "ab''"}


def test_packing(docs):
    pieces = {}
    for r in pack_documents(docs).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for p in pieces.values() for r in p}) == sum(map(len, pieces.values()))
    for k, t in enumerate(TEXTS):
        ids, at = [*encoded(t), 2], 0
        for r in sorted(pieces[k * 7 % 11], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    assert pack_documents(docs.limit(0)).count() == 0


def test_fingerprints(spark):
    rng = random.Random(2)
    vocab = [f"v{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 30, 300]))) for _ in range(40)] + ["", None, "Same text here", "Same text here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    ids = sorted(got, reverse=True)
    for k, i in enumerate(ids):
        text, other = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if text == other:
            assert got[i].fingerprint == got[ids[(k + 1) % len(ids)]].fingerprint and got[i].near_next == 1.0
        sets = [shingle_set(x) for x in (text, edited, other)]
        exact = lambda a, b: len(a & b) / max(1, len(a | b)) if a or b else 1.0
        assert abs(got[i].near_edited - exact(sets[0], sets[1])) < 0.2 and abs(got[i].near_next - exact(sets[0], sets[2])) < 0.2
    assert fingerprints.edited_fingerprints(df.limit(0)).count() == 0
    ties = spark.createDataFrame([(3, "a b c d e f g"), (3, "a b"), (None, "c"), (None, None), (1, "x " * 30000)], "doc_id long, `t.x` string").withColumn("next_text", F.lit("clash"))
    out = fingerprints.edited_fingerprints(ties, text_col="t.x").collect()
    assert len(out) == 5 and sorted(r.n_chars for r in out) == [0, 1, 3, 13, 60000]


def test_places_among_bounds(spark):
    for n in (0, 1, 2, 7, 50):
        bounds = [3 * k for k in range(n)]
        got = spark.range(-2, 160).select("id", fingerprints._bounds_below(F.col("id"), bounds, spark.range(1).schema["id"].dataType).alias("k")).collect()
        assert all(r.k == sum(b < r.id for b in bounds) for r in got)


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    assert (nearest_e8(np.array([[0.4] * 8])) == 0.5).all()
    base = rng.normal(size=(20, 16))
    rows = [(i, (base[i % 20] + rng.normal(size=16) * rng.choice([0.02, 0.3])).astype("float32").tolist(), int(i % 20) // 10) for i in range(150)]
    rows += [(200, rows[0][1], 0), (201, None, 0), (202, [0.0] * 16, 0), (203, [float("nan")] * 16, 0), (204, rows[0][1], None)]
    got = {r.vec_id: r for r in near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    good = [(i, np.array(v, float), k) for i, v, k in rows if v is not None and k is not None and np.isfinite(v).all() and np.any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v, _ in good])
    near = (unit @ unit.T >= 0.93) & np.equal.outer([k for *_, k in good], [k for *_, k in good])
    np.fill_diagonal(near, False)
    assert {i: got[i].n_links for i, *_ in good} == {i: int(n) for (i, *_), n in zip(good, near.sum(1), strict=True)}
    for i in (201, 202, 203, 204):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    odd = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (2, [1.0, 2.0, 0.0], 0)], "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(0))
    assert sorted(((r.vec_id, r.n_links) for r in near_embeddings(odd).collect()), key=repr) == [(1, 2), (1, 2), (2, 2), (None, 0)]
    assert near_embeddings(odd.limit(0)).count() == 0


def test_recall_on_the_driver_table(spark):
    """op4's query against brute force over all rows."""
    from florilege.llm.queries import op4_lattice_near_dedup

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    got = {r.vec_id: r.n_links for r in op4_lattice_near_dedup(spark, "/root/testdata/sf0.01").collect()}
    unit = np.array([np.array(r.embedding, float) / np.linalg.norm(r.embedding) for r in rows])
    near = (unit @ unit.T >= 0.93) & np.equal.outer([r.label for r in rows], [r.label for r in rows])
    np.fill_diagonal(near, False)
    assert got == {r.vec_id: int(n) for r, n in zip(rows, near.sum(1), strict=True)}


def test_url_rules(spark):
    urls = ["HTTPS://A.Example.NET/en/x?y", "http://net", "http://x.example.com/de/1#t", None, "nourl", "http://b.org/fr/2"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.filter_urls(df, {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}).collect()}
    assert [(got[k].host, got[k].path, got[k].rule) for k in range(6)] == [("a.example.net", "/en/x", "example.net/en/"), ("net", "", None), ("x.example.com", "/de/1", "example.com/de/"), ("", "", None), ("", "", None), ("b.org", "/fr/2", "org/fr/")]
    assert [got[k].verdict for k in (0, 2, 5)] == ["allow", "block", "allow"]


def test_template_of_mostly_blocked_labels_is_rejected(spark):
    rows = [("h", f"/bad/{k}.html", True if k % 10 else None) for k in range(60)] + [("h", f"/good/{k}", False if k % 10 else None) for k in range(60)]
    judged = url_filter.judge_templates(url_filter.path_templates(spark.createDataFrame(rows, "host string, path string, blocked boolean"))).collect()
    assert {(r.p1, r.p2): r.rejected for r in judged} == {("bad", "*.html"): True, ("good", "*"): False}


def test_branches_that_differ_far_below(spark):
    """Labels that disagree only at the fourth, sixth and twelfth segment; a host without labels keeps four levels."""
    rows = []
    for deep in (3, 5, 11):
        stem = "/".join(f"s{k}" for k in range(deep))
        rows += [(f"h{deep}", f"/{stem}/{kind}/{k}", kind == "bad" if k % 10 else None) for kind in ("bad", "good") for k in range(60)]
    rows += [("free", f"/a/b/c/d/{k}/x", None) for k in range(30)] + [("short", "", None), ("short", "/", True)]
    urls = url_filter.path_templates(spark.createDataFrame(rows, "host string, path string, blocked boolean"))
    judged = url_filter.judge_templates(urls).collect()
    for deep in (3, 5, 11):
        own = {r[f"p{deep + 1}"]: r.rejected for r in judged if r.host == f"h{deep}"}
        assert own == {"bad": True, "good": False}
    (free,) = [r for r in judged if r.host == "free"]
    assert [free[f"p{k}"] for k in (1, 4, 5, 6)] == ["a", "d", "**", None]
    assert urls.count() == len(rows)


def test_url_filter_of_odd_tables(spark):
    rows = [(1, "http://net/" + "a/" * 5000, "x"), (1, "http://h.org/" + "b" * 200_000, "y"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("p1", F.lit(1)).withColumn("__parts", F.lit(1))
    rules = {"net/": "block"}
    got = sorted(((r.page_id, r.host, r.verdict) for r in url_filter.filter_urls(df, rules).collect()), key=str)
    assert got == [(1, "h.org", "allow"), (1, "net", "block"), (None, "", "allow")]
    assert url_filter.filter_urls(df.limit(0), rules).collect() == []


def test_fingerprints_need_numbers(spark):
    with pytest.raises(ValueError, match="numbers"):
        fingerprints.edited_fingerprints(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_families_do_not_depend_on_the_number_of_languages():
    few, many = language.Tree(["xa", "xb", "en"]), language.Tree(["xa", "xb", "en", *(f"y{k:02d}" for k in range(30))])
    assert few.families["others x"] == many.families["others x"] == ["xa", "xb"] and few.families["germanic"] == ["en"]


def test_pseudonyms(spark):
    texts = ["card 4337166598464399, 4337-1665-9846-4399; not 4337166598464398", "mail a.b@c.example.com +1 (456) 555-2186", None, "", "ip 74.42.69.78 v 3.0 999.1.1.1 on 2024-02-29 not 2023-02-29", "ssn 123-45-6789 000-12-3456 DE89370400440532013000 password=1e738d199cb6c4db8d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kind", F.lit("kept"))
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k", kinds_col="kinds").collect()}
    assert got[2].text is None and got[3].text == "" and got[0].kind == "kept"
    card = got[0].text.split()[1].strip(",")
    assert card != "4337166598464399" and got[0].text.split()[2].replace("-", "").strip(";") == card and "4337166598464398" in got[0].text
    digits = [int(c) for c in reversed(card)]
    assert sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0
    assert "example.com" not in got[1].text and "555-2186" not in got[1].text and len(got[1].text.split(" ", 2)[2]) == 17
    assert "v 3.0 999.1.1.1" in got[4].text and "not 2023-02-29" in got[4].text and "2024-02-29" not in got[4].text
    iban = got[5].text.split()[3]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and "1e738d199cb6c4db8d" not in got[5].text


def test_secrets_go_whole(spark):
    values = ["x1Y-" * 75, "eyJhbGci.eyJzdWIi.c2lnbmF0dXJl", "Tr0ub4dor&3xyz", "P@ssw0rd.com'9", "abcdefgh1!)"]
    names = ["token=", "access_token=", "DB_PASSWORD: ", "client_secret=", "clientSecret = ", "AWS_SECRET_ACCESS_KEY="]
    pairs = [(n, v) for n in names for v in values]
    texts = [f"a {n}{v} b" for n, v in pairs] + [f'{{"{n}": "{v}", "b": 1}}' for n, v in [("password", "correct horse 9"), ("api-key", 'q\\"uoted12')]]
    texts += ['password="abc", user="d"', "Token::Identifier(name) token", "token=abcdefgh1 token=abcdefgh1. 'token=abcdefgh1', end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k", kinds_col="kinds").collect()}
    for i, (n, v) in enumerate(pairs):
        new = got[i].text
        assert got[i].kinds == ["secret"] and new.startswith(f"a {n}") and new.endswith(" b") and len(new) == len(texts[i])
        assert set(new[len(n) + 2 : -2]) <= set("0123456789abcdef") and new[len(n) + 2 : -2] != v
    k = len(pairs)
    assert "horse" not in got[k].text and got[k].text.endswith('", "b": 1}') and "oted12" not in got[k + 1].text and got[k + 1].text.endswith('", "b": 1}')
    assert got[k + 2].text == texts[k + 2] and got[k + 3].text == texts[k + 3]
    one, two, three, _ = got[k + 4].text.split(" ")
    assert two.startswith(one) and three == f"'{one}',"


def test_grouped_ibans_and_timestamps(spark):
    texts = ["to DE89 3704 0044 0532 0130 00 EUR", "AT61 1904 3002 3457 3201 EUR 4337 1665 9846 4399", "AT12 4337 1665 9846 4399", "DE88 3704 0044 0532 0130 00", "at 2024-02-29T10:00Z, 2023-02-29T10:00 2024-02-29X", "GB82 WEST 1234 5698 7654 32"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k", kinds_col="kinds").collect()}
    assert [got[i].kinds for i in range(6)] == [["iban"], ["iban", "card"], ["card"], [], ["date"], ["iban"]]
    for text, old in ((got[0].text[3:-4], texts[0][3:-4]), (got[1].text[:24], texts[1][:24]), (got[5].text, texts[5])):
        c = text.replace(" ", "")
        assert text != old and [len(x) for x in text.split(" ")] == [len(x) for x in old.split(" ")] and int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1
    assert got[2].text.startswith("AT12 ") and got[2].text != texts[2] and got[3].text == texts[3]
    assert got[4].text[:3] == "at " and "2024-02-29T" not in got[4].text and got[4].text.endswith("T10:00Z, 2023-02-29T10:00 2024-02-29X")


def test_digit_permutation_is_one_to_one(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = {r[0] for r in df.select(pii._permute_digits("k", "x", F.col("d"))).collect()}
    assert len(out) == 1000 and all(len(x) == 3 for x in out)


def test_toxicity_finds_unseen_endings(spark):
    rng = random.Random(6)
    plain = [f"pl{rng.randrange(500)}" for _ in range(500)]
    text = lambda bad: " ".join([*(rng.choice(plain) for _ in range(60)), *([f"zorkin{rng.choice('abcdefgh')}{rng.randrange(99)}"] * bad), *(rng.choice(plain) for _ in range(20))])
    rows = [(i, text(i % 2), i % 2) for i in range(500)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i < 400], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).collect()}
    right = sum((got[i] >= 0.5) == bool(t) for i, _, t in rows if i >= 400)
    assert right >= 95
    assert toxicity.score_toxicity(docs.limit(1), None).first().score == 0
    assert toxicity.train_toxicity(docs, labels.where("toxic = 1")) is None
    long = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 1, F.repeat(F.concat("text", F.lit(" ")), 40)).otherwise(F.col("text")).alias("text"))
    strays = labels.union(spark.createDataFrame([(10**6 + i, 1) for i in range(3000)], "doc_id long, toxic int"))  # labels of no document
    model = toxicity.train_toxicity(long, strays)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(long.where("doc_id >= 400"), model).collect()}
    assert sum((got[i] >= 0.5) == bool(i % 2) for i in got) >= 80
    odd = spark.createDataFrame([(1, None, 0.1), (1, "", 0.2), (None, rows[1][1] * 900, 0.3)], "doc_id long, text string, `sco.re` double").withColumn("flat", F.lit(1))
    out = toxicity.with_toxicity(odd, model, score_col="sco.re").collect()
    assert len(out) == 3 and out[0]["sco.re"] == out[1]["sco.re"] and toxicity.with_toxicity(odd.limit(0), model).count() == 0


def test_excerpts_reach_both_ends(spark):
    df = spark.createDataFrame([(" ".join(f"w{k}" for k in range(9000)),), ("short one",), (None,)], "t string")
    long, short, none = [r[0] for r in df.select(toxicity.excerpt(F.col("t"), 8000)).collect()]
    assert short == "short one" and none is None and len(long) <= 8000 and {int(w[1:]) // 1000 for w in long.split()} == set(range(9))


def test_language(spark):
    rng = random.Random(8)
    parts = {"en": ["the", "th", "and", "ing"], "de": ["sch", "und", "ein", "ü"], "fr": ["eau", "les", "qu", "é"], "es": ["ción", "los", "que", "ñ"]}
    rows = [(i, " ".join("".join(rng.choice(parts[x]) for _ in range(rng.randrange(1, 4))) for _ in range(40)), x) for i in range(200) for x in [list(parts)[i % 4]]]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34", None), (902, "", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict_language(docs, language.train_language(docs, F.col("id") < 150)).collect()}
    assert sum(got[i].lang_pred == x for i, _, x in rows if i >= 150) >= 48
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    many = [(1000 + i, " ".join(chr(0x4E00 + 7 * i + k % 5) * 2 for k in range(30)) * (400 if i == 0 else 1), f"x{i:03d}") for i in range(24)]
    more = spark.createDataFrame([*rows[:40], *many], "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("clash"))
    got = {r.doc_id: r.lang_pred for r in language.predict_language(more, language.train_language(more)).collect()}
    assert sum(got[i] == x for i, _, x in many) >= 22 and got[1000] == "x000"  # all languages, also one with a long text only
    assert language.train_language(more.limit(0)) is None and language.predict_language(more.limit(0), None).count() == 0


def test_mixing_meets_targets(spark):
    rows = [(i, "alpha beta gamma " * 20 if i % 4 else "omega psi chi " * 20) for i in range(200)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(0, 200, 3)], "id long, domain string")
    rates = mixing.mixing_rates(docs, labelled, {"a": 0.5, "b": 0.5}).collect()
    tokens = {d: sum(r.n_tokens * r.rate for r in rates if r.domain == d) for d in "ab"}
    assert abs(tokens["a"] / sum(tokens.values()) - 0.5) < 0.05 and min(r.rate for r in rates) >= 0
    assert {r.rate for r in mixing.mixing_rates(docs, labelled.limit(0), {"a": 0.5, "b": 0.5}).collect()} == {1.0}
    thick = mixing.sample_at_rates(docs, spark.createDataFrame([(1, 2.0), (2, 0.0)], "doc_id long, rate double"))
    assert thick.where("doc_id = 1").count() == 2 and thick.where("doc_id = 2").count() == 0 and thick.count() == 202


def test_mixing_edge_rows(spark):
    long = "omega psi chi " * 20000
    rows = [(i, "alpha beta gamma " * 20 if i % 4 else "omega psi chi " * 20, 0.5) for i in range(80)] + [(None, "alpha beta", 1.0), (None, "alpha beta", 1.0), (7, long, 2.0), (900, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate double").withColumn("p0.x", F.lit(1))
    labelled = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(0, 80, 3)] + [(10**9 + i, "a") for i in range(50)], "id long, domain string")
    rates = mixing.mixing_rates(docs, labelled, {"a": 0.5, "b": 0.5}).collect()
    assert len(rates) == 84 and sum(r.doc_id is None for r in rates) == 2 and {r.n_tokens for r in rates if r.doc_id == 7} == {60, 60000}
    mixed = mixing.mix_documents(docs, labelled, {"a": 0.5, "b": 0.5})
    assert mixed.columns == docs.columns and mixed.where("length(text) > 1000").count() >= 1
    assert mixing.sample_at_rates(docs, spark.createDataFrame([(1, 0.0)], "doc_id long, rate double")).count() == 83
    assert mixing.mix_documents(docs.limit(0), labelled, {"a": 0.5, "b": 0.5}).count() == 0
    assert mixing.mix_documents(docs, labelled.limit(0), {"a": 0.5, "b": 0.5}).count() == 84


def test_membership_equals_brute_force(spark):
    """op7's posteriors and rates recomputed in Python from its own table of words."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab cd ef gh ij".split() if i % 3 else "ab kl mn op".split()) for _ in range(rng.randrange(1, 90))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(0, 60, 2)], "id long, domain string")
    model = mixing.Domains(docs, labelled, ["x", "y"])
    bucket = {w: b for w, b in docs.select(F.explode(fingerprints.words(F.col("text"))).alias("w")).distinct().select("w", mixing._bucket(F.col("w"))).collect()}
    for r in docs.select("text", model.membership().alias("m")).collect():
        w = r.text.split()
        logits = [sum(float(t[bucket[x]]) for x in w) * min(len(w), 60) / len(w) + np.log(p) for t, p in zip(model.tables, model.prior, strict=True)]
        e = np.exp(np.array(logits) - max(logits))
        assert r.m.n == len(w) and np.allclose(r.m.p, e / e.sum())


def test_pii_of_very_long_finds(spark):
    """Runs that no address may have stay; their rows and those beside them are still cleaned."""
    texts = {
        1: "a@" + "b." * 100_000 + "com and me@x.org", 2: "me@x.org " * 20_000, 3: "@." * 100_000, 4: "token=" + "x" * 1_000_000 + " me@x.org",
        5: 'password="' + '\\"' * 50_000 + '" me@x.org', 6: "1." * 100_000 + " me@x.org", 7: "a@" + "b." * 125 + "com.", 8: "a@" + "b." * 127 + "com", 9: "+1" + "-23" * 100_000, 10: "4 " * 100_000,
    }
    got = {r.doc_id: r.text for r in pii.pseudonymise(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), "k").collect()}
    assert got[1].startswith("a@" + "b." * 100_000 + "com and u") and "me@x.org" not in got[1] + got[2] + got[4] + got[5] + got[6]
    assert got[3] == texts[3] and got[8] == texts[8] and "b.b" not in got[7] and got[7].endswith(".example.")
    assert "xxx" not in got[4] and len(got) == len(texts)


def test_pii_of_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([("x.y", "mail a@b.org", 1), (None, None, 2), ("x.y", "mail a@b.org", 1)], "`a.b` string, text string, kinds int")
    assert pii.pseudonymise(df.limit(0), "k").collect() == []
    got = sorted(map(tuple, pii.pseudonymise(df, "k").collect()), key=str)
    assert got[2] == (None, None, 2) and got[0] == got[1] and "a@b.org" not in got[0][1]


def test_embeddings_that_share_an_id(spark):
    """Different vectors with one id keep their own links; equal ones are one class of copies."""
    x, y = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, 0, x), (1, 0, y), (2, 0, [1.0, 0.1, 0.0, 0.0]), (3, 0, [0.1, 1.0, 0.0, 0.0]), (4, 0, [0.0, 0.0, 1.0, 0.0]), (4, 0, [0.0, 0.0, 1.0, 0.0]), (5, 1, x), (None, 0, x), (6, None, x)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for deviations in (5, None):
        got = sorted((tuple(r) for r in near_embeddings(table, deviations=deviations).collect()), key=str)
        assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, 4, True), (4, 1, 4, True), (5, 0, 5, True), (None, 0, None, True), (6, 0, 6, True)], key=str)


def test_samples_are_bounded_in_rows(spark):
    from florilege.llm.sampling import first_of_classes

    rows = spark.createDataFrame([(1, f"t{k % 3}", 0) for k in range(900)] + [(k, "x", 1) for k in range(5)], "id long, text string, toxic int")
    assert {r.toxic: r["count"] for r in first_of_classes(rows, "toxic", 100, "id", "text").groupBy("toxic").count().collect()} == {0: 100, 1: 5}
