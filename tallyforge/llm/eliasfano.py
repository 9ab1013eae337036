"""Elias-Fano form of a non-decreasing sequence, with selection in place (operator 12).

A value is parted at bit ``l``: the low bits are packed side by side, the high
parts are counted in unary in one bit vector, in which value ``i`` is the one at
``(value >> l) + i``. With ``l = log2(largest / n)`` this takes two bits and
``l`` for each value. For every ``SAMPLE``-th one its place is kept in 32 bits, so a
value is found by reading the bits between two samples; there is no table of
64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

#: ones between two kept places
SAMPLE = 256
HEADER = struct.Struct("<QQBxxxxxxxQQQ")
#: values packed at once, a multiple of eight
STEP = 1 << 14


def _pack(values: np.ndarray, bits: int) -> bytes:
    """The ``bits`` low bits of each value, side by side."""
    if not bits:
        return b""
    places = np.arange(bits, dtype=np.uint64)
    parts = (values[k : k + STEP, None] >> places & np.uint64(1) for k in range(0, len(values), STEP))
    return b"".join(np.packbits(p.astype(np.uint8).ravel(), bitorder="little").tobytes() for p in parts)


class EliasFano:
    """Reads the form that ``encoded`` gives, without unpacking it."""

    def __init__(self, data: bytes | memoryview):
        self.n, self.largest, self.l, high, low, samples = HEADER.unpack_from(data)
        at = HEADER.size
        self.high = np.frombuffer(data, np.uint8, high, at)
        self.low = np.frombuffer(data, np.uint8, low, at + high)
        self.samples = np.frombuffer(data, "<u4", samples, at + high + low)

    @staticmethod
    def encoded(values: np.ndarray) -> bytes:
        """``values``: unsigned and non-decreasing; ValueError otherwise."""
        v = np.asarray(values, np.uint64)
        if (v[1:] < v[:-1]).any():
            raise ValueError("values fall")
        n, largest = len(v), int(v[-1]) if len(v) else 0
        bits = max(0, (largest // n).bit_length() - 1) if n else 0
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = int(ones[-1]) + 1 if n else 0
        if size >= 1 << 32:
            raise ValueError("too many values for 32-bit places; use several files")
        high = np.zeros(-(-size // 8), np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        low, samples = _pack(v, bits), ones[::SAMPLE].astype("<u4").tobytes()
        return HEADER.pack(n, largest, bits, len(high), len(low), len(samples) // 4) + high.tobytes() + low + samples

    def __len__(self) -> int:
        return self.n

    def between(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` (without it) as unsigned 64-bit integers."""
        if not 0 <= first <= last <= self.n:
            raise IndexError(f"{first}:{last} of {self.n}")
        if first == last:
            return np.empty(0, np.uint64)
        k, end = first // SAMPLE, -(-last // SAMPLE)
        start = int(self.samples[k]) >> 3
        stop = (int(self.samples[end]) >> 3) + 1 if end < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + 8 * start
        skipped = int(np.searchsorted(ones, self.samples[k]))  # ones of the first byte that come before the sample
        ones = ones[skipped + first - k * SAMPLE :][: last - first]
        found = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self.l)
        return found | self._low(first, last) if self.l else found

    def _low(self, first: int, last: int) -> np.ndarray:
        a, b = first * self.l, last * self.l
        bits = np.unpackbits(self.low[a >> 3 : -(-b // 8)], bitorder="little")[a & 7 :][: b - a]
        weights = np.uint64(1) << np.arange(self.l, dtype=np.uint64)
        return (bits.reshape(-1, self.l).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The value at ``i``."""
        return int(self.between(i, i + 1)[0])

    def find(self, value: int) -> int:
        """How many values are smaller than ``value``."""
        a, b = 0, self.n
        while a < b:
            middle = (a + b) // 2
            if self.select(middle) < value:
                a = middle + 1
            else:
                b = middle
        return a
