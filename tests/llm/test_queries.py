"""The registered queries on the driver's smallest tables: folds, predictions, digests and counts."""

import zlib

import pytest

from florilege.llm import queries as q
from tests.llm.test_others import crc, encoded

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_op2_scores_and_folds(spark, texts):
    got = {r.doc_id: r for r in q.op2_toxicity(spark, FOLDER).collect()}
    assert got.keys() == texts.keys()
    assert all(r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())


def test_op6_languages_and_folds(spark, texts):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()
    got = {r.doc_id: r for r in q.op6_language_id(spark, FOLDER).collect()}
    learnt = {r.lang for r in rows if r.lang is not None and fold(r.doc_id, 4) != 2}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (fold(i, 4) == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") if not any(c.isalpha() for c in texts[i] or "") else (r.lang_pred in learnt)
    held = [(r.lang, got[r.doc_id].lang_pred) for r in rows if r.lang is not None and got[r.doc_id].held_out and got[r.doc_id].lang_pred != "und"]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_op8_digests(spark, texts):
    got, at = {r.doc_id: r for r in q.op8_token_files(spark, FOLDER).collect()}, 0
    for i in sorted(texts):
        ids = [*encoded(texts[i]), 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_op9_pieces(spark, texts):
    pieces = {}
    for r in q.op9_binary_packing(spark, FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for i, text in texts.items():
        ids, at = [*encoded(text), 2], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.offset, r.doc_tokens, r.ids_crc32) == (at, 0, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)


def test_op5_hosts_paths_and_rules(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()}
    got = {r.page_id: r for r in q.op5_url_filter(spark, FOLDER).collect()}
    assert got.keys() == pages.keys()
    for i, url in pages.items():
        rest = (url or "").partition("://")[2]
        cut = min((k for k in (rest.find(c) for c in "/?#") if k >= 0), default=len(rest))
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        path = rest[cut:].partition("#")[0].partition("?")[0]
        fits = [r for r in q.URL_RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith(f".{h}")) and path.startswith(f"/{p}")]
        rule = max(fits, key=len, default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == q.URL_RULES[rule] if rule else got[i].verdict in ("allow", "block")


def test_op3_op7_op10_keep_every_row(spark, texts):
    prints = {r.doc_id: r for r in q.op3_fingerprints(spark, FOLDER).collect()}
    assert prints.keys() == texts.keys() and all(prints[i].n_chars == len(t or "") for i, t in texts.items())
    same = {}
    for i, t in texts.items():
        same.setdefault(t or "", set()).add(prints[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    assert sorted(r.doc_id for r in q.op7_domain_mixing(spark, FOLDER).collect()) == sorted(texts)
    for r in q.op10_pii_pseudonyms(spark, FOLDER).collect():
        assert (r.text == texts[r.doc_id]) or r.n_replaced > 0
