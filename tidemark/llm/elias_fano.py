"""Elias-Fano coding of a non-decreasing sequence, with select over its upper bits.

Each value's lowest bits are stored as they are; the rest are unary differences in a bit vector with one set
bit per value. The place of every ``SAMPLE``-th set bit is kept in 32 bits, relative to the number of values
seen, so ``value(i)`` reads one sample and a few bytes.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = "<QQBQQ"
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    def __init__(self, count: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.count, self.base, self.low_bits, self.low, self.high = count, base, low_bits, low, high
        ones = np.cumsum(_ONES[high], dtype=np.int64)
        wanted = np.arange(0, count, SAMPLE)
        self.samples = np.searchsorted(ones, wanted, side="right").astype(np.uint32)  # the byte of the bit
        self.before = np.where(self.samples > 0, ones[np.maximum(self.samples.astype(np.int64) - 1, 0)], 0).astype(np.uint32) if count else wanted

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if n and (np.diff(values.view(np.uint64) - values[:1].view(np.uint64)).astype(np.int64) < 0).any():
            raise ValueError("the values must not decrease")
        base = int(values[0]) if n else 0
        rest = values.view(np.uint64) - np.uint64(base % 2**64)
        top = int(rest[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shift = np.uint64(low_bits)
        low = ((rest[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).reshape(-1)
        marks = np.zeros(n + (top >> low_bits) + 1 if n else 0, np.uint8)
        marks[(rest >> shift).astype(np.int64) + np.arange(n)] = 1
        return cls(n, base, low_bits, np.packbits(low), np.packbits(marks))

    def low_of(self, i: np.ndarray) -> np.ndarray:
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 if self.low_bits else np.zeros((len(i), 0), np.uint8)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The place of the i-th set bit."""
        byte, seen = int(self.samples[i // SAMPLE]), int(self.before[i // SAMPLE])
        while seen + (ones := int(_ONES[self.high[byte]])) <= i:
            seen += ones
            byte += 1
        return 8 * byte + int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1]))[i - seen])

    def value(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return self.base + ((self.select(i) - i) << self.low_bits | int(self.low_of(np.array([i]))[0]))

    def values(self) -> np.ndarray:
        at = np.arange(self.count)
        upper = (np.flatnonzero(np.unpackbits(self.high))[: self.count] - at).astype(np.uint64)
        rest = upper << np.uint64(self.low_bits) | self.low_of(at)
        return (rest + np.uint64(self.base % 2**64)).view(np.int64)

    def to_bytes(self) -> bytes:
        head = struct.pack(_HEAD, self.count, self.base % 2**64, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        count, base, low_bits, n_low, n_high = struct.unpack_from(_HEAD, raw)
        at = struct.calcsize(_HEAD)
        low = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        return cls(count, base - 2**64 if base >= 2**63 else base, low_bits, low, high)
