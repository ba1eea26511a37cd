"""Elias-Fano code of a non-decreasing sequence of non-negative numbers."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQB7xQQQ")
SAMPLE = 256


class EliasFano:
    """``n`` numbers up to ``bound`` in about ``2 + log2(bound / n)`` bits each, with select by position.

    The low bits of each number are stored side by side; its high part is a unary code in a bit array, where the i-th
    set bit stands at ``high(i) + i``. The place of every 256th set bit is kept, so select reads a bounded stretch of
    the array around it (more only where few numbers span a wide range).
    """

    def __init__(self, n: int, bound: int, width: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.bound, self.width, self.lows, self.highs, self.samples = n, bound, width, lows, highs, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, bound = len(values), int(values[-1]) if len(values) else 0
        if n and (values[0] < 0 or (np.diff(values) < 0).any()):
            raise ValueError("values must be non-negative and non-decreasing")
        width = max(0, (bound // n).bit_length() - 1) if n else 0
        lows = np.packbits(((values[:, None] >> np.arange(width)) & 1).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> width) + np.arange(n)
        bits = np.zeros(n + (bound >> width) + 1, np.uint8)
        bits[places] = 1
        return cls(n, bound, width, lows, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<i8"))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.bound, self.width, len(self.lows), len(self.highs), len(self.samples))
        return head + self.lows.tobytes() + self.highs.tobytes() + self.samples.astype("<i8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes | memoryview) -> EliasFano:
        n, bound, width, n_lows, n_highs, n_samples = _HEAD.unpack_from(data)
        at = _HEAD.size
        lows = np.frombuffer(data, np.uint8, n_lows, at)
        highs = np.frombuffer(data, np.uint8, n_highs, at + n_lows)
        return cls(n, bound, width, lows, highs, np.frombuffer(data, "<i8", n_samples, at + n_lows + n_highs))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for b in range(self.width):
            bit = i * self.width + b
            out |= ((self.lows[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64) << b
        return out

    def select(self, i: int) -> int:
        """The i-th number, from 0."""
        return int(self.span(i, i + 1)[0])

    def span(self, first: int, last: int) -> np.ndarray:
        """The numbers from ``first`` to ``last - 1``: the sampled place before the first one tells where the bit array is
        read from, and it is read up to the last one."""
        if not 0 <= first < last <= self.n:
            raise IndexError(first, last)
        place, left = int(self.samples[first // SAMPLE]), first % SAMPLE
        byte = at = place >> 3
        before = int(np.unpackbits(self.highs[byte : byte + 1], bitorder="little")[: place & 7].sum())  # of earlier numbers
        found, seen, wanted = [], -before, left + last - first
        while seen < wanted:
            bits = self.highs[at : at + max(64, (wanted - seen) // 4)]
            ones = np.flatnonzero(np.unpackbits(bits, bitorder="little")) + 8 * at
            found.append(ones)
            seen, at = seen + len(ones), at + len(bits)
        places = np.concatenate(found)[before + left : before + wanted]
        i = np.arange(first, last)
        return ((places - i) << self.width) | self._low(i)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return ((places - i) << self.width) | self._low(i)
