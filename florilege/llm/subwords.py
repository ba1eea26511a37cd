"""Hashed character n-grams of the words of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from florilege.llm.shingles import mix64

_BASE = 0x9E3779B97F4A7C15
_OPEN, _CLOSE = ord("<"), ord(">")
#: Bytes of text that are worked on at a time.
CHUNK_BYTES = 1 << 19
#: Distinct words whose features are found at a time where all are kept.
WORDS_AT_A_TIME = 1 << 14


@lru_cache(1)
def _word_characters() -> np.ndarray:
    return np.array([chr(c).isalnum() for c in range(0x110000)])


@lru_cache(1)
def _values() -> np.ndarray:
    return mix64(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x1234567))


_held: dict[bool, np.ndarray] = {}


def _powers_for(n: int, up: bool) -> np.ndarray:
    """Powers of the base or of its inverse; the longest array that was asked for is kept, but for very long texts."""
    if len(_held.get(up, ())) < n:
        factors = np.full(1 << max(16, (n - 1).bit_length()), _BASE if up else pow(_BASE, -1, 2**64), np.uint64)
        factors[0] = 1
        found = np.cumprod(factors, dtype=np.uint64, out=factors)
        if len(found) > 4 * CHUNK_BYTES:
            return found[:n]
        _held[up] = found
    return _held[up][:n]


def _blocks(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts with about ``CHUNK_BYTES`` characters; a longer text stands alone."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held > CHUNK_BYTES and i > first:
            yield slice(first, i)
            first, held = i, len(text or "")
    if first < len(texts):
        yield slice(first, len(texts))


class Words:
    """The words of some texts: runs of letters and digits in lower case.

    ``counts``: words of each text; ``which``: for each word its number among the distinct ones; ``n_distinct``.
    """

    def __init__(self, texts: list[str | None]):
        counts, inside, first_keys, spelt, lengths = [], [], [], [], []
        for at in _blocks(texts):  # only the words themselves are held for all texts
            codes, starts, stops, n = self._cut(texts[at])
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_values()[codes] * _powers_for(max(1, len(codes)), True)[: len(codes)], out=sums[1:])
            key = (sums[stops] - sums[starts]) * _powers_for(len(codes) + 1, False)[starts]
            distinct, where, number = np.unique(key, return_index=True, return_inverse=True)
            length = (stops - starts)[where]
            place = np.repeat(starts[where] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            counts.append(n)
            inside.append(number.astype(np.int32))
            first_keys.append(distinct)
            spelt.append(codes[place])
            lengths.append(length)
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        _, at, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *first_keys]), return_index=True, return_inverse=True)
        ends = np.cumsum([len(x) for x in first_keys]).tolist()
        self.which = np.concatenate([np.zeros(0, np.int64), *(number[b - len(k) : b][x] for b, k, x in zip(ends, first_keys, inside, strict=True))])
        self.n_distinct = len(at)
        length = np.concatenate([np.zeros(0, np.int64), *lengths])
        stops = np.cumsum(length)
        self._codes, self._starts, self._stops = np.concatenate([np.zeros(0, np.uint32), *spelt]), (stops - length)[at], stops[at]

    @staticmethod
    def _cut(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        texts = [(t or "").lower() for t in texts]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.zeros(len(codes) + 2, bool)
        word[1:-1] = _word_characters()[codes]
        starts, stops = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        return codes, starts, stops, np.diff(np.searchsorted(starts, begins))

    def _features(self, sizes: tuple[int, ...], buckets: int, own: slice = slice(None)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each distinct word, or ``own`` ones numbered from 0, the buckets of its n-grams (with marks at both ends) and of itself: for each size
        the words' numbers in ascending order and the buckets."""
        first, length = self._starts[own], self._stops[own] - self._starts[own] + 2
        begins = np.cumsum(length) - length
        total = int(length.sum())
        text = np.empty(total, np.uint32)
        word = np.repeat(np.arange(len(length)), length)
        place = np.arange(total) - begins[word]
        inner = (place > 0) & (place < length[word] - 1)
        text[place == 0], text[place == length[word] - 1] = _OPEN, _CLOSE
        text[inner] = self._codes[(first[word] + place - 1)[inner]]
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(_values()[text] * _powers_for(max(1, total), True)[:total], out=sums[1:])
        down = _powers_for(total + 1, False)
        mask = np.uint64(buckets - 1)
        yield np.arange(len(length)), (mix64((sums[begins + length] - sums[begins]) * down[begins] + np.uint64(99)) & mask).astype(np.int64)
        for n in sizes:
            at = np.flatnonzero(place + n <= length[word]) if total else np.zeros(0, np.int64)
            yield word[at], (mix64((sums[at + n] - sums[at]) * down[at] + np.uint64(n)) & mask).astype(np.int64)

    def features(self, sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """All features: word numbers in ascending order, and buckets (a power of two of them).

        Of some words at a time, each part goes straight to its places: nothing is sorted."""
        counts, blocks = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for low in range(0, self.n_distinct, WORDS_AT_A_TIME):
            own = slice(low, min(low + WORDS_AT_A_TIME, self.n_distinct))
            parts = [(np.bincount(w, minlength=own.stop - low), b.astype(np.int32)) for w, b in self._features(sizes, buckets, own)]
            total = sum(n for n, _ in parts)
            found, begin = np.empty(int(total.sum()), np.int32), np.cumsum(total) - total
            for n, bucket in parts:
                found[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(bucket))] = bucket
                begin += n
            counts.append(total)
            blocks.append(found)
        return np.repeat(np.arange(self.n_distinct, dtype=np.int32), np.concatenate(counts)), np.concatenate(blocks)

    def mean_of(self, weights: np.ndarray, sizes: tuple[int, ...], rows: np.ndarray | None = None) -> np.ndarray:
        """For each distinct word the mean of ``weights[bucket]`` over its features; ``weights``: buckets x columns, or the
        ``rows`` of buckets x columns."""
        n, total = np.zeros(self.n_distinct, np.int64), np.zeros((self.n_distinct, weights.shape[1]))
        for word, bucket in self._features(sizes, len(weights) if rows is None else len(rows)):
            n += np.bincount(word, minlength=self.n_distinct)
            at = bucket if rows is None else rows[bucket]
            for j in range(weights.shape[1]):
                total[:, j] += np.bincount(word, weights[at, j], self.n_distinct)
        return total / np.maximum(n, 1)[:, None]
