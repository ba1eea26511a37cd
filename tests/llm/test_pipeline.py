"""The pipeline's stages on a small table."""

import tracemalloc

import numpy as np

import corpus_pipeline
import __spark_entry__
from florilege.llm.subwords import Words
from florilege.llm.toxicity import SubwordBag


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    words = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(words[(i * 31 + j * 7) % 300] for j in range(60)) + (" zorkina zorkinb" if i % 4 == 0 else " fine day"), "en", "s", None) for i in range(80)]
    rows += [(500, rows[1][1], "en", "s", None), (501, "call +1 (456) 555-2186 " + rows[2][1][:40], "en", "s", 5), (502, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 3 > 0, i % 4 == 0) for i in range(80)], "doc_id long, quality boolean, toxic boolean").selectExpr("doc_id", "cast(quality as int) quality", "cast(toxic as int) toxic").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    assert 0 not in seen["toxicity"] and 1 in seen["toxicity"]
    assert 1 in seen["near_dedup"] and 500 not in seen["near_dedup"]
    assert "555-2186" not in seen["pii"][501] and 502 in seen["pii"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_entry_lists_one_query_an_operator():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_training_holds_little_beside_its_features():
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(chr(97 + c) for c in w) for w in rng.integers(0, 26, (250, 9))) for _ in range(300)]
    words = Words(texts)
    words.features((3, 4, 5), 1 << 17)  # tables that are kept
    tracemalloc.start()
    word, bucket = words.features((3, 4, 5), 1 << 17)
    peak = tracemalloc.get_traced_memory()[1]
    n_features = np.bincount(word, minlength=words.n_distinct)
    first_feature, first = np.cumsum(n_features) - n_features, np.arange(0, len(words.which), 20)
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    model = SubwordBag()
    score = model._passage_scores(words, word, bucket, n_features, first_feature, first)
    more = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert peak < 2.5 * (word.nbytes + bucket.nbytes) and more < 1.5 * (word.nbytes + bucket.nbytes)
    parts = [np.stack(x) for x in words._features((3, 4, 5), 1 << 17)]
    wanted = np.concatenate(parts, axis=1)
    wanted = wanted[:, np.argsort(wanted[0], kind="stable")]
    assert (wanted[0] == word).all() and (wanted[1] == bucket).all()
    per_word = np.bincount(word, model.flat()[bucket], words.n_distinct) / n_features
    assert (score == np.add.reduceat(per_word[words.which], first) / 20 + (model.bias[1] - model.bias[0])).all()
    n_texts = np.bincount(np.unique(words.which * 300 + np.repeat(np.arange(300), words.counts)) // 300, minlength=words.n_distinct)
    assert (model._seen_texts(words, word, bucket) == np.bincount(bucket, n_texts[word], 1 << 17)).all()
