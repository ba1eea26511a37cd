"""Minimal perfect hash of 128-bit keys, with what is held about each key in arrays by its slot."""

from __future__ import annotations

import struct

import numpy as np

from florilege.llm.shingles import mix64

#: Bits of a level for each key that is still without a place: fewer make it smaller and give it more levels.
SPREAD = 2.0
_HEAD = struct.Struct("<QQQ")
_LEVEL = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = keys[:, 1] + np.uint64(level + 1) * _LEVEL
    return (mix64(keys[:, 0] ^ mix64(salted)) % np.uint64(size)).astype(np.int64)


class CountIndex:
    """Counts of ``n`` distinct keys (two 64-bit numbers each), found through a minimal perfect hash.

    Level by level every key is hashed into a bit array; a key that is alone at its place sets that bit and is done, the
    others go to the next level. The number of set bits before its own is a key's slot from 0 to n - 1. At the slot stand
    the key's fingerprint (its second number) and its count. A key that is not among the ``n`` mostly finds no bit, or
    else another key's slot, where the fingerprint differs but for a chance of 2^-64.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, prints: np.ndarray, counts: np.ndarray):
        self.words, self.sizes, self.prints, self.counts = words, sizes, prints, counts
        ones = np.bitwise_count(words).astype(np.uint32)
        self.before = np.cumsum(ones, dtype=np.uint32) - ones

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> CountIndex:
        """``keys`` as ``(n, 2)`` unsigned 64-bit numbers, no two rows equal; counts above 2^32 - 1 are held as that."""
        keys = np.asarray(keys, np.uint64).reshape(-1, 2)
        left, sizes, words = keys, [], []
        while len(left):
            size = -(-int(len(left) * SPREAD + 1) // 64) * 64
            at = _places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys must be distinct")
        index = cls(np.concatenate(words) if words else np.zeros(0, np.uint64), np.array(sizes, np.int64), np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint32))
        slots = index._slots(keys)
        index.prints[slots] = keys[:, 1]
        index.counts[slots] = np.minimum(counts, np.iinfo(np.uint32).max)
        return index

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(open_):
                break
            bit = _places(keys[open_], level, size) + base
            word, own = bit >> 6, np.uint64(1) << (bit & 63).astype(np.uint64)
            there = (self.words[word] & own) != 0
            w, below = word[there], own[there] - np.uint64(1)
            out[open_[there]] = self.before[w] + np.bitwise_count(self.words[w] & below)
            open_ = open_[~there]
            base += size
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; 0 for one that is not among those of the index."""
        keys = np.asarray(keys, np.uint64).reshape(-1, 2)
        slots = self._slots(keys)
        out = np.zeros(len(keys), np.int64)
        some = np.flatnonzero(slots >= 0)
        some = some[self.prints[slots[some]] == keys[some, 1]]
        out[some] = self.counts[slots[some]]
        return out

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.before.nbytes + self.prints.nbytes + self.counts.nbytes

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(len(self.words), len(self.sizes), len(self.prints))
        return b"".join([head, *(x.tobytes() for x in (self.words, self.sizes, self.prints, self.counts))])

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> CountIndex:
        n_words, n_levels, n = _HEAD.unpack_from(data)
        found, at = [], _HEAD.size
        for kind, k in ((np.uint64, n_words), (np.int64, n_levels), (np.uint64, n), (np.uint32, n)):
            found.append(np.frombuffer(data, kind, k, at))
            at += k * np.dtype(kind).itemsize
        return cls(*found)
