"""Words and word shingles of Arrow text columns, in numpy, a bounded chunk of text at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
WIDTH = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_VALUE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACES = np.random.default_rng(2).integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the offsets of each text in them; null is the empty text."""
    column = column.cast(pa.large_string()) if isinstance(column, pa.Array) else column.combine_chunks().cast(pa.large_string())
    column = pc.fill_null(column, "") if column.null_count else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def tidy(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``made``, after which what Arrow and the C library hold for later goes back to the system: a worker waits between
    tasks without it."""
    yield from made
    give_back()


def give_back() -> None:
    """Memory that Arrow and the C library hold for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``size`` bytes each; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factors = np.full(max(n, CHUNK_BYTES + 1), _BASE if kind == "up" else _UNBASE, np.uint64)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors, dtype=np.uint64)
    return _powers[kind][:n]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts, and how many words each text has.

    Words are runs of bytes other than white space, with A-Z in lower case; ``offsets`` start at any byte of ``data``.
    """
    low = offsets[0]
    part, ends_of = data[low : offsets[-1]], offsets - low
    inside = np.ones(len(part) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[part], out=inside[1:-1])
    start = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cut = ends_of[1:-1]
    cut = cut[(cut > 0) & (cut < len(part))]
    touching = cut[inside[cut] & inside[cut + 1]]  # one text ends in a word and the next begins with one
    start[touching] = True
    stop[touching] = True
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[_LOWER[part]] * _power("up", len(part)), out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _power("down", len(part) + 1)[starts]
    hashes = mix64(hashes + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.diff(np.searchsorted(starts, ends_of))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's five-word shingles, one text after the other, and their counts.

    A text with one to four words has its whole word sequence as its only shingle; one without words has none.
    """
    words, n_words = word_hashes(data, offsets)
    counts = np.where(n_words >= WIDTH, n_words - WIDTH + 1, np.minimum(n_words, 1))
    first = np.concatenate([[0], np.cumsum(n_words)])
    out = np.empty(int(counts.sum()), np.uint64)
    long_text = np.repeat(n_words >= WIDTH, counts)
    if len(words) >= WIDTH:
        text_of = np.repeat(np.arange(len(n_words)), n_words)
        whole = text_of[: len(words) - WIDTH + 1] == text_of[WIDTH - 1 :]
        total = np.zeros(len(words) - WIDTH + 1, np.uint64)
        for j in range(WIDTH):
            total += words[j : j + len(total)] * _PLACES[j]
        out[long_text] = mix64(total[whole])
    short = np.flatnonzero((n_words > 0) & (n_words < WIDTH))
    if len(short):
        total = n_words[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for j in range(WIDTH - 1):
            there = n_words[short] > j
            total[there] += words[first[short[there]] + j] * _PLACES[j]
        out[~long_text] = mix64(total)
    at = np.concatenate([[0], np.cumsum(counts)])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    keep[at[:-1][counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[at]
    return out[keep], np.diff(kept)
