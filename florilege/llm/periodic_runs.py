"""Periodic runs of words in texts, found by minimizers of several scales, and texts with each run cut to one period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from florilege.llm.expressions import named
from florilege.llm.shingles import chunks, mix64, text_buffers, tidy

#: Periods up to this one are found by comparing all words that far apart.
SHORT = 8
#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
CHUNK_BYTES = 1 << 20
RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each ``w`` neighbours, from running minima forwards and backwards inside blocks of ``w``."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def _minimizers(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the values that are the smallest of some ``w`` neighbours (all that tie)."""
    least = _sliding_minimum(grams, w)
    # a position is chosen if the largest of the minima of the windows that hold it is its own value
    edge = np.zeros(w - 1, grams.dtype)
    most = ~_sliding_minimum(~np.concatenate([edge, least, edge]), w)
    return np.flatnonzero(most == grams)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of neighbouring numbers in an ascending array."""
    if not len(same):
        return same, same
    cut = np.flatnonzero(np.diff(same) != 1)
    return same[np.concatenate([[0], cut + 1])], same[np.concatenate([cut, [len(same) - 1]])] + 1


def _stretch_at(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` of words that equal the one ``lag`` further on: start and end, equal for none.

    Compared in pieces of doubling size, so the work follows the length of the stretch."""
    end, step, n = at, 64, len(words) - lag
    while end < n:
        differ = np.flatnonzero(words[end : min(end + step, n)] != words[end + lag : min(end + step, n) + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = min(end + step, n), step * 2
    if end == at:
        return at, at
    start, step = at, 64
    while start > 0:
        low = max(start - step, 0)
        differ = np.flatnonzero(words[low:start] != words[low + lag : start + lag])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, step * 2
    return start, end


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows ``(start, length, period)``, by start and period, of all maximal runs in ``words``: several texts one after the
    other, each followed by a number that stands nowhere else; ``lengths`` are the texts' words.

    Periods up to ``SHORT`` come from direct scans. For a scale m = 16, 32, .. the m-grams of words are hashed (a gram from
    two of half its size) and the minimizers of windows of m/2 grams chosen. A run of smallest period p, m/2 < p <= m, has
    at least 4p words, so it holds a window and the equal window p further on, which choose equal grams p apart; as
    m >= p, equal grams inside the run are never nearer to each other. So neighbours among equal minimizers give p, and the
    run is what the words themselves, compared p apart, extend to.
    """
    found: set[tuple[int, int, int]] = set()

    def add(start: int, end: int, period: int) -> None:
        if end - start + period >= max(LEAST_WORDS, LEAST_PERIODS * period):
            found.add((start, end - start + period, period))

    for lag in range(1, min(SHORT, int(lengths.max(initial=0)) // LEAST_PERIODS) + 1):
        starts, ends = _stretches(np.flatnonzero(words[:-lag] == words[lag:]))
        long_ = ends - starts + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag)
        for a, b in zip(starts[long_].tolist(), ends[long_].tolist(), strict=True):
            add(a, b, lag)
    m, grams, at, own = 1, mix64(words.astype(np.uint64)), np.arange(len(words)), lengths
    while len(own) and own.max() > 2 * m:  # a run of a period above m/2 has more than 2m words
        if m > SHORT:
            chosen = _minimizers(grams, m // 2)
            order = np.argsort(grams[chosen], kind="stable")
            place, value = at[chosen[order]], grams[chosen[order]]
            lag = place[1:] - place[:-1]
            pairs = np.flatnonzero((value[1:] == value[:-1]) & (2 * lag > m) & (lag <= m))
            pairs = pairs[np.lexsort((place[pairs], lag[pairs]))]
            before, end = 0, 0
            for x, d in zip(place[pairs].tolist(), lag[pairs].tolist(), strict=True):
                if d != before or x >= end:
                    start, end = _stretch_at(words, x, d)
                    before = d
                    add(start, end, d)
        with np.errstate(over="ignore"):
            grams = mix64(grams[:-m] * np.uint64(0x9E3779B97F4A7C15) ^ grams[m:])
        at = at[: len(grams)]
        m *= 2
        if (own <= 2 * m).any() and len(own) > 1:  # texts that are too short for what follows
            stay = own > 2 * m
            held = np.repeat(stay, own + 1)[: len(grams)]
            grams, at, own = grams[held], at[held], own[stay]
    least: dict[tuple[int, int], int] = {}
    for start, length, period in found:  # a stretch also has the multiples of its period
        least[start, length] = min(period, least.get((start, length), period))
    return np.array(sorted((s, n, p) for (s, n), p in least.items()), np.int64).reshape(-1, 3)


def _collapse(batches: Iterator[pa.RecordBatch], place: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(place))
        valid = np.asarray(batch.column(place).is_valid())
        for first, last in chunks(offsets, CHUNK_BYTES):
            bounds = offsets[first : last + 1].tolist()
            texts = [data[a:b].tobytes().split() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]  # at ASCII white space
            lengths = np.array([len(t) for t in texts], np.int64)
            number: dict[bytes, int] = {}
            ids = np.empty(int(lengths.sum()) + len(texts), np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths + 1)])
            for k, t in enumerate(texts):
                a = int(starts[k])
                ids[a : a + len(t)] = [number.setdefault(w, len(number)) for w in t]
                ids[a + len(t)] = -k - 1
            runs = find_runs(ids, lengths)
            text_of = np.searchsorted(starts, runs[:, 0], "right") - 1
            edge = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
            np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
            dropped = np.cumsum(edge)[:-1] > 0
            touched = set(text_of.tolist())
            out = []
            for k, t in enumerate(texts):
                if k in touched:
                    gone = dropped[int(starts[k]) : int(starts[k + 1]) - 1].tolist()
                    t = [w for w, g in zip(t, gone, strict=True) if not g]
                out.append(b" ".join(t).decode("utf-8", "replace") if valid[first + k] else None)
            ends = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=len(texts)))]).astype(np.int32)
            fields = [pa.array(runs[:, 0] - starts[text_of]), pa.array(runs[:, 1].copy()), pa.array(runs[:, 2].copy())]
            columns = batch.slice(first, last - first).columns
            columns[place] = pa.array(out, pa.string())
            columns += [pa.array(lengths), pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def collapse_runs(docs: DataFrame, text_col: str = "text", words_col: str = "n_words", runs_col: str = "runs") -> DataFrame:
    """``docs`` with each text's words joined by one space, without those that repeat a period, and two columns: the number
    of words before, and the runs as an array of ``(start, length, period)`` by start and period.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, numbered from 0. A run is a stretch of words with smallest period q (words q
    apart are equal) of at least max(6, 4q) words that no neighbouring word extends. A word is dropped if any run holds it
    after that run's first q words. All runs of all periods are found, see ``find_runs``; texts are compared by their
    words, not by hashes of them.

    A null text has no words and no runs and stays null; an empty one stays empty. Repeated rows fare alike. A text is
    held whole by one task, long or not; others share a task's chunk of a megabyte. Columns named as the two new ones are
    replaced. An empty table gives no rows. There is no shuffle.
    """
    rest = [c for c in docs.columns if c not in (words_col, runs_col)]
    names = [*rest, words_col, runs_col]
    rows = docs.select(*(named(c).cast("string").alias(c) if c == text_col else named(c) for c in rest))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema.fields), T.StructField(words_col, T.LongType()), T.StructField(runs_col, RUN)])
    place = rest.index(text_col)
    return rows.mapInArrow(lambda batches: tidy(_collapse(batches, place, names)), schema)
