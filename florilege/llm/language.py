"""Language of documents: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florilege.llm.expressions import named
from florilege.llm.sampling import first_of_classes, sample_of_classes
from florilege.llm.shingles import chunks, text_buffers
from florilege.llm.subwords import CHUNK_BYTES, Words
from florilege.llm.toxicity import whole_or_excerpt

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
UNKNOWN = "und"
#: The training sample: at most so many documents of each language, read whole.
SAMPLE_DOCUMENTS = 200
#: And at most so many documents in all, as long as each language has ``FEW``.
MOST_DOCUMENTS, FEW = 2_000, 5
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne", "ur"),
}


class Level:
    """One-versus-one machines among some names. Weights are held for the buckets that the names' documents have."""

    def __init__(self, names: list[str], doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, of: np.ndarray):
        """``doc``, ``bucket``, ``value``: features in order of documents; ``of``: the name of each document."""
        self.names, self.pairs = names, list(combinations(range(len(names)), 2))
        found = np.unique(bucket[np.isin(of[doc], names)]) if len(self.pairs) else bucket[:0]
        self.rows = np.full(BUCKETS, len(found), np.int32)  # the last row of the weights is zero
        self.rows[found] = np.arange(len(found), dtype=np.int32)
        self.weights = np.zeros((len(found) + 1, len(self.pairs)), np.float32)
        self.biases = np.zeros(len(self.pairs))
        for k, (a, b) in enumerate(self.pairs):
            y = np.where(of == names[a], 1.0, np.where(of == names[b], -1.0, 0.0))
            use = y[doc] != 0
            own, at = np.unique(bucket[use], return_inverse=True)
            w, self.biases[k] = _machine(doc[use], at, value[use], y, len(own))
            self.weights[self.rows[own], k] = 10 * w

    def winners(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """For each text the name's number and the mean pairwise probability of the one with the most of it."""
        n = len(words.counts)
        if not self.pairs:
            return np.zeros(n, int), np.ones(n)
        margins = np.tile(self.biases, (n, 1))
        some = words.counts > 0
        if some.any():
            per_word = words.mean_of(self.weights, SIZES, self.rows)
            begin = (np.cumsum(words.counts) - words.counts)[some]
            for k in range(len(self.pairs)):
                margins[some, k] += np.add.reduceat(per_word[words.which, k], begin) / words.counts[some]
        votes = np.zeros((n, len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            p = 1 / (1 + np.exp(-np.clip(4 * margins[:, k], -30, 30)))
            votes[:, a] += p
            votes[:, b] += 1 - p
        return votes.argmax(1), votes.max(1) / (len(self.names) - 1)


def _machine(doc: np.ndarray, at: np.ndarray, value: np.ndarray, y: np.ndarray, n: int, epochs: int = 40, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Hinge loss with a shrunken weight vector of ``n`` places; the steps of each weight fall with its own gradients."""
    w, b, squares, square_b = np.zeros(n), 0.0, np.full(n, 1e-8), 1e-8
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), np.where(y < 0, 0.5 / max(1, (y < 0).sum()), 0.0))
    for _ in range(epochs):
        margin = y * (np.bincount(doc, w[at] * value, len(y)) + b)
        pull = -y * balance * (margin < 1)
        step = np.bincount(at, pull[doc] * value, n) + shrink * w
        squares += step**2
        w -= 0.3 * step / np.sqrt(squares)
        square_b += pull.sum() ** 2
        b -= 0.05 * pull.sum() / np.sqrt(square_b)
    return w, b


class Tree:
    """Two levels of machines: among families, and among the languages of each family. Languages that stand in no family
    are put together by their first letter, however many there are."""

    def __init__(self, languages: list[str], families: dict[str, tuple[str, ...]] | None = None):
        of = {lang: name for name, some in (families or FAMILIES).items() for lang in some}
        self.families: dict[str, list[str]] = {}
        for lang in sorted(languages):
            self.families.setdefault(of.get(lang) or f"others {lang[:1]}", []).append(lang)

    def fit(self, texts: list[str], languages: np.ndarray) -> Tree:
        words = Words(texts)
        doc = np.repeat(np.arange(len(texts)), words.counts)
        key, count = np.unique(doc * np.int64(max(1, words.n_distinct)) + words.which, return_counts=True)
        doc, which = np.divmod(key, np.int64(max(1, words.n_distinct)))
        word, bucket = words.features(SIZES, BUCKETS)
        n = np.bincount(word, minlength=words.n_distinct)
        first = np.cumsum(n) - n
        share = count / np.maximum(words.counts, 1)[doc] / n[which]
        reps = n[which]
        parts = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))]
        for d in range(len(texts)):  # a document's features at a time
            own = slice(*np.searchsorted(doc, [d, d + 1]))
            at = np.repeat(first[which[own]] - (np.cumsum(reps[own]) - reps[own]), reps[own]) + np.arange(reps[own].sum())
            found, back = np.unique(bucket[at], return_inverse=True)
            parts.append((np.full(len(found), d, np.int32), found.astype(np.int32), (np.bincount(back, np.repeat(share[own], reps[own]), len(found)) * 10).astype(np.float32)))
        doc, bucket, value = (np.concatenate(x) for x in zip(*parts, strict=True))
        home = {lang: name for name, some in self.families.items() for lang in some}
        names = sorted(self.families)
        self.top = Level(names, doc, bucket, value, np.array([home[x] for x in languages], object))
        self.within = {name: Level(self.families[name], doc, bucket, value, np.array(languages, object)) for name in names}
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores: the product, over both levels, of the winner's mean pairwise probability."""
        best, score = self.top.winners(Words(texts))
        out = [""] * len(texts)
        for f, name in enumerate(self.top.names):
            rows = np.flatnonzero(best == f)
            level = self.within[name]
            if not level.pairs or not len(rows):
                lang, p = np.zeros(len(rows), int), np.ones(len(rows))
            else:
                lang, p = level.winners(Words([texts[i] for i in rows.tolist()]))
            score[rows] *= p
            for i, k in zip(rows.tolist(), lang.tolist(), strict=True):
                out[i] = level.names[k]
        return out, score


def train_language(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_DOCUMENTS, characters: int | None = None) -> Tree | None:
    """Fit on a bounded sample of the documents with a language that satisfy ``usable`` (a condition on ``id``).

    Every language of a usable document is learnt, however many there are and however long its documents, which are read
    whole; where they may be too long for the driver, ``characters`` bounds each by an excerpt. Null languages,
    ids and texts teach nothing; repeated rows are drawn together, but no more rows than asked for; None without any usable document.
    """
    texts = docs.select(named(id_col).alias("id"), named(lang_col).cast("string").alias("lang"), named(text_col).cast("string").alias("text"))
    texts = texts.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull())
    if usable is not None:
        texts = texts.where(usable)
    known = texts.select("id", "lang").distinct()
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())  # a row a language
    if not languages:
        return None
    most = min(per_language, max(FEW, MOST_DOCUMENTS // len(languages)))
    picked = sample_of_classes(known, "lang", most)
    fit = first_of_classes(texts.join(F.broadcast(picked), ["id", "lang"]), "lang", most, "id", "text").select(F.xxhash64("id").alias("hash"), whole_or_excerpt(F.col("text"), characters).alias("text"), "lang")  # a bounded sample
    rows = sorted((r.hash, r.text, r.lang) for r in fit.collect())
    return Tree(languages).fit([r[1] for r in rows], np.array([r[2] for r in rows]))


def predict_language(docs: DataFrame, model: Tree | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row, over its whole text.

    A null text, one without a letter, or any text without a model is ``und`` with score 0. Null and repeated ids are
    predicted row by row, very long texts whole; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            langs: list[str] = []
            scores = [np.zeros(0)]
            for first, last in chunks(offsets, CHUNK_BYTES):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                found, score = ([UNKNOWN] * len(texts), np.zeros(len(texts))) if model is None else model.predict(texts)
                blank = np.array([not any(map(str.isalpha, t or "")) for t in texts], bool)
                score[blank] = 0.0
                langs += [UNKNOWN if no else lang for lang, no in zip(found, blank.tolist(), strict=True)]
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], names=["id", "lang_pred", "score"])

    rows = docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
