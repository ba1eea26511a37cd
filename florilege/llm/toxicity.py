"""Toxicity scores from a subword-bag model trained on a bounded sample of labelled documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florilege.llm.expressions import named
from florilege.llm.sampling import existing, first_of_classes, sample_of_classes
from florilege.llm.shingles import chunks, give_back, text_buffers, tidy
from florilege.llm.subwords import CHUNK_BYTES, Words

SIZES = (3, 4, 5)
BUCKETS, DIMENSIONS = 1 << 17, 8
PASSAGE_WORDS = 20
#: The training sample: at most so many documents of each class, read whole. Where a bound on characters is asked for, a
#: longer one gives as many windows, spread evenly over its whole text, as make up that length.
SAMPLE_DOCUMENTS, WINDOWS = 1500, 16
EPOCHS = 16
TRUNC = 30.0
#: Features that are scored at a time in training.
FEATURES_AT_A_TIME = 1 << 18
#: N-grams of fewer words, counted once in each text of the sample, keep a zero vector.
RARE_TEXTS = 3


class SubwordBag:
    """Word vector: mean of the vectors of its hashed character n-grams and itself. Passage: mean of its distinct words'
    vectors over ``PASSAGE_WORDS`` places, of which those that a repeated word leaves are zero; then a linear softmax
    over the two classes. Vectors and softmax are trained jointly. A document is as toxic as its most toxic passage, so
    a few words count in a long text as in a short one. A fifth of the sample sets the scale and offset of the score."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
        self.softmax = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.scale, self.offset = 1.0, 0.0
        self.rng = rng

    def fit(self, texts: list[str], toxic: np.ndarray, toxic_share: float) -> SubwordBag:
        """``toxic_share``: of toxic documents among all labelled ones, for the score's offset."""
        held = np.arange(len(texts)) % 5 == 4
        if len(set(toxic[held])) < 2:
            held[:] = False
        self._fit([t for t, h in zip(texts, held, strict=True) if not h], toxic[~held], EPOCHS)
        if held.any():
            best = _logits([t for t, h in zip(texts, held, strict=True) if h], self.flat(), float(self.bias[1] - self.bias[0]))
            y = toxic[held]
            weight = np.where(y == 1, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean()))
            a, b = 1.0, 0.0
            for _ in range(300):
                p = 1 / (1 + np.exp(-np.clip(a * best + b, -TRUNC, TRUNC)))
                error = weight * (p - y)
                a, b = max(0.05, a - 0.02 * (error * best).mean() - 1e-4 * a), b - 0.5 * error.mean()
            self.scale, self.offset = a, b
        return self

    def _fit(self, texts: list[str], toxic: np.ndarray, epochs: int, rate: float = 0.5, batch: int = 1024) -> SubwordBag:
        """Passages of clean documents are clean; after a quarter of the epochs the hardest are all used, the others in part.
        In a toxic document every passage counts as toxic at first (with a low weight), later its
        highest-scoring ones only: the others are left out, then clean."""
        words = Words(texts)
        give_back()  # here and below: what a step held is large beside what it leaves
        word, bucket = words.features(SIZES, BUCKETS)
        give_back()
        n_features = np.bincount(word, minlength=words.n_distinct)
        first_feature = np.cumsum(n_features) - n_features
        rare = self._seen_texts(words, word, bucket) < RARE_TEXTS
        self.vectors[rare] = 0
        first, n_words, doc = distinct_passages(words)
        batch = int(np.clip(len(first) // 100, 64, batch))  # a small sample gets as many steps as a large one, of fewer passages
        toxic_passage = toxic[doc].astype(bool)
        give_back()
        squares, squares_softmax = np.full((BUCKETS, DIMENSIONS), 1e-6, np.float32), np.full((DIMENSIONS, 2), 1e-6, np.float32)
        for epoch in range(epochs):
            target = toxic_passage.copy()
            start = epoch < epochs // 8
            weight = np.where(toxic_passage, 0.3, 1.0) if start else np.ones(len(first))
            if not start:
                score = self._passage_scores(words, word, bucket, n_features, first_feature, first)
                best = np.full(len(toxic), -np.inf)
                np.maximum.at(best, doc, score)
                top = score >= np.minimum(best[doc], 0.0 if epoch > epochs // 4 else np.inf)
                target &= top
                weight[toxic_passage & ~top] = 0.0 if epoch < epochs // 2 else 0.3
            hard = toxic_passage | (score > -4) if epoch > epochs // 4 else toxic_passage
            use = np.flatnonzero((weight > 0) & (hard | (self.rng.random(len(first)) < (0.5 if epoch <= epochs // 4 else 0.25))))
            share = max(1e-9, (weight[use] * target[use]).sum()) / max(1e-9, (weight[use] * ~target[use]).sum())
            weight = weight * np.where(target, min(20.0, 1 / share) ** 0.5, 1.0)
            use = self.rng.permutation(use)
            for k in range(0, len(use), batch):
                self._step(use[k : k + batch], words, bucket, n_features, first_feature, first, n_words, target, weight, rate, squares, squares_softmax, rare)
        return self

    @staticmethod
    def _seen_texts(words: Words, word, bucket) -> np.ndarray:
        """For each bucket the texts that its words are in, a word's texts counted once."""
        n = np.int64(max(1, len(words.counts)))
        pairs = words.which * n
        pairs += np.repeat(np.arange(len(words.counts)), words.counts)
        pairs.sort()
        first = np.ones(len(pairs), bool)
        np.not_equal(pairs[1:], pairs[:-1], out=first[1:])
        n_texts = np.bincount(pairs[first] // n, minlength=words.n_distinct)
        del pairs, first
        seen = np.zeros(BUCKETS)
        for a in range(0, len(bucket), FEATURES_AT_A_TIME):
            own = slice(a, a + FEATURES_AT_A_TIME)
            seen += np.bincount(bucket[own], n_texts[word[own]], BUCKETS)
        return seen

    def _passage_scores(self, words: Words, word, bucket, n_features, first_feature, first) -> np.ndarray:
        flat = self.flat()
        per_word = np.zeros(words.n_distinct)
        for a in range(0, len(bucket), FEATURES_AT_A_TIME):  # a word's features stay together
            low, high = np.searchsorted(first_feature, [a, a + FEATURES_AT_A_TIME]).tolist()
            if low < high:
                own = slice(first_feature[low], first_feature[high] if high < len(first_feature) else len(bucket))
                per_word[low:high] = np.bincount(word[own] - low, flat[bucket[own]], high - low)
        per_word /= np.maximum(n_features, 1)
        return np.add.reduceat(per_word[words.which], first) / PASSAGE_WORDS + (self.bias[1] - self.bias[0]) if len(first) else np.zeros(0)

    def _step(self, use, words, bucket, n_features, first_feature, first, n_words, target, weight, rate, squares, squares_softmax, rare) -> None:
        n = n_words[use]
        passage = np.repeat(np.arange(len(use)), n)
        at = np.repeat(first[use] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        distinct, which = np.unique(words.which[at], return_inverse=True)
        m = n_features[distinct]
        owner = np.repeat(np.arange(len(distinct)), m)
        buckets = bucket[np.repeat(first_feature[distinct] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
        rows, row_of = np.unique(buckets, return_inverse=True)
        own = self.vectors[rows]
        word_vectors = np.add.reduceat(own[row_of], np.cumsum(m) - m) / m[:, None]
        bag = np.add.reduceat(word_vectors[which], np.cumsum(n) - n) / PASSAGE_WORDS
        logits = bag @ self.softmax + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(use)), target[use].astype(int)] -= 1
        error = (p * (weight[use] / max(1e-9, weight[use].mean()))[:, None]).astype(np.float32)
        to_bag = error @ self.softmax.T / PASSAGE_WORDS
        step_softmax, step_bias = bag.T @ error, error.mean(0)
        to_rows = np.empty_like(own)
        for j in range(DIMENSIONS):
            to_word = np.bincount(which, to_bag[passage, j], len(distinct)) / m
            to_rows[:, j] = np.bincount(row_of, to_word[owner], len(rows))
        squares[rows] += to_rows**2
        common = 3 * np.sqrt((squares[rows] ** 0.5).mean() ** 2)
        to_rows[rare[rows]] = 0
        self.vectors[rows] -= rate * to_rows / (np.sqrt(squares[rows]) + common)
        squares_softmax += step_softmax**2
        self.softmax -= 0.2 * rate * step_softmax / np.sqrt(squares_softmax)
        self.bias -= 0.1 * step_bias

    def flat(self) -> np.ndarray:
        """Each bucket's share in the difference of the two logits: a mean of vectors and a linear map exchange."""
        return self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])


def passages(counts: np.ndarray, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of ``counts`` words cut into passages of at most ``size``: first word, number of words, text."""
    n = -(-counts // size)
    doc = np.repeat(np.arange(len(counts)), n)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = (np.cumsum(counts) - counts)[doc] + rank * size
    return first, np.minimum(counts[doc] - rank * size, size), doc


def distinct_passages(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``passages``, after each word that repeats in its passage is taken out of ``words.which``."""
    first, n, doc = passages(words.counts)
    passage = np.repeat(np.arange(len(first)), n)
    key = np.unique(passage * np.int64(max(1, words.n_distinct)) + words.which)
    passage, words.which = np.divmod(key, np.int64(max(1, words.n_distinct)))
    n = np.bincount(passage, minlength=len(first))
    return np.cumsum(n) - n, n, doc


def _logits(texts: list[str | None], flat: np.ndarray, bias: float) -> np.ndarray:
    """Largest passage logit of each text; a text without words has the bias alone."""
    words = Words(texts)
    out = np.full(len(texts), bias)
    if len(words.which):
        per_word = words.mean_of(flat[:, None], SIZES)[:, 0]
        first, _, doc = distinct_passages(words)
        logit = np.add.reduceat(per_word[words.which], first) / PASSAGE_WORDS + bias
        out[words.counts > 0] = np.maximum.reduceat(logit, np.flatnonzero(np.diff(doc, prepend=-1)))
    return out


def excerpt(text: Column, characters: int, windows: int = WINDOWS) -> Column:
    """A text of up to ``characters``; of a longer one ``windows`` stretches spread evenly from its start to its end, cut
    at white space."""
    size = characters // windows
    stretch = lambda k: F.regexp_replace(F.substring(text, F.floor(k * (F.length(text) - size) / (windows - 1)).cast("int") + 1, F.lit(size)), r"^\S*\s|\s\S*$", "")
    return F.when(F.length(text) > characters, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), stretch), " ")).otherwise(text)


def whole_or_excerpt(text: Column, characters: int | None) -> Column:
    return text if characters is None else excerpt(text, characters)


def train_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = SAMPLE_DOCUMENTS, characters: int | None = None) -> SubwordBag | None:
    """Fit on a bounded sample of labelled documents that satisfy ``usable`` (a condition on the id).

    The sample is drawn from documents that are there and have a text, of any length, and read whole; ``characters``
    bounds each by an excerpt where they may be too long for the driver. A document with several labels is toxic if one of them says so; null labels and ids say nothing; rows that
    repeat an id are several documents of its label, and ``per_class`` bounds the rows. None if a class has no document: there is then nothing to learn.
    """
    known = labels.where(named(label_col).isNotNull() & named(id_col).isNotNull()).groupBy(named(id_col).alias("id")).agg((F.max(named(label_col)) > 0).cast("int").alias("toxic"))
    if usable is not None:
        known = known.where(usable)
    texts = docs.where(named(text_col).isNotNull()).select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    known = existing(known, texts, "id")
    picked = sample_of_classes(known, "toxic", per_class)
    fit = first_of_classes(texts.join(F.broadcast(picked), "id"), "toxic", per_class, "id", "text").select(F.xxhash64("id").alias("hash"), whole_or_excerpt(F.col("text"), characters).alias("text"), "toxic")  # a bounded sample
    rows = sorted((r.hash, r.text, r.toxic) for r in fit.collect())
    toxic = np.array([r[2] for r in rows], int)
    if not len(rows) or toxic.min() == toxic.max():
        return None
    share = known.agg(F.avg("toxic")).first()[0]
    texts = [r[1] for r in rows]
    del rows
    model = SubwordBag().fit(texts, toxic, min(0.99, max(0.01, share)))
    del texts
    give_back()  # the driver, too, goes on without it
    return model


def with_toxicity(docs: DataFrame, model: SubwordBag | None, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``score_col`` after their other columns: the score of the whole text, 0 to 1, higher for toxic.

    Null and empty texts, and texts without words, get the score of an empty bag: the model's bias.
    Without a model every score is 0. Every row is scored by itself, repeated ids and very long texts too; an empty table
    gives no rows. A column that is already named ``score_col`` is replaced.
    """
    docs = docs.select(*(named(c) for c in docs.columns if c != score_col))
    at = docs.columns.index(text_col)
    bias = 0.0 if model is None else float(model.bias[1] - model.bias[0])
    scale, offset = (1.0, 0.0) if model is None else (model.scale, model.offset)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else model.flat().astype(np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            _, offsets = text_buffers(texts)
            parts = [np.zeros(0)]
            for first, last in chunks(offsets, CHUNK_BYTES):
                if flat is None:
                    parts.append(np.zeros(last - first))
                else:
                    logit = scale * _logits(texts.slice(first, last - first).to_pylist(), flat, bias) + offset
                    parts.append(1 / (1 + np.exp(-np.clip(logit, -TRUNC, TRUNC))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts))], names=[*batch.schema.names, "score"])

    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # mapInArrow takes no names with dots
    scored = plain.mapInArrow(lambda batches: tidy(score(batches)), T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.toDF(*docs.columns, score_col)


def score_toxicity(docs: DataFrame, model: SubwordBag | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of ``with_toxicity``."""
    return with_toxicity(docs.select(named(id_col), named(text_col).cast("string").alias("__text")), model, "__text", "score").drop("__text")
