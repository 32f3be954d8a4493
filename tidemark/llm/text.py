"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Two different words (or shingles) share a hash with a chance of 2**-64 for each pair compared; no
comparison across the corpus relies on more than a pair of texts or one key at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
_LONG_WORD = 512
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a batch of texts: maximal runs of bytes outside space and 0x09-0x0D.

    ``starts``/``ends`` are byte positions in ``data``; the words of text i are ``bounds[i]:bounds[i + 1]``.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if n else None
        size = int(offsets[-1] - offsets[0])
        self.data = np.zeros(size + 8, np.uint8)
        if size:
            self.data[:size] = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
        self.raw = self.data if not lower else self.data.copy()
        self.offsets = offsets - offsets[0]
        body = self.data[:size]
        if lower:
            body += ((body >= 65) & (body <= 90)).view(np.uint8) << 5
        inside = np.zeros(size + 2, bool)
        inside[1:-1] = ~((body == 32) | ((body >= 9) & (body <= 13)))
        begin = inside[1:-1] & ~inside[:-2]
        finish = inside[1:-1] & ~inside[2:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < size)]
        begin[edges] |= inside[1:-1][edges]
        finish[edges - 1] |= inside[1:-1][edges - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        out = lengths.astype(np.uint64) * _C1
        eights = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        rows, k = np.arange(len(lengths)), 0
        long_words = np.flatnonzero(lengths > _LONG_WORD)
        while len(rows := rows[lengths[rows] > k]) and k < _LONG_WORD:
            left = np.minimum(lengths[rows] - k, 8)
            out[rows] = mix((out[rows] + _C1) ^ (eights[self.starts[rows] + k] & _LOW_BYTES[left]))
            k += 8
        for i in long_words:
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes())
        return out


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and each text's bounds in them.

    A text with fewer words has one shingle, its whole sequence; a text without words has none.
    """
    h, counts = words.hashes(), words.counts
    n = len(h)
    full = np.zeros(n, np.uint64)
    if n >= size:
        run = h[: n - size + 1].copy()
        for k in range(1, size):
            run = mix(run * _C1 + h[k : n - size + 1 + k])
        full[: n - size + 1] = run
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        a = int(words.bounds[i])
        x = h[a : a + 1] ^ np.uint64(counts[i])
        for k in range(1, int(counts[i])):
            x = mix(x * _C2 + h[a + k : a + k + 1])
        full[a] = x[0]
    keep = np.zeros(n, bool)
    first = np.arange(n) - np.repeat(words.bounds[:-1], counts)
    keep[first < np.repeat(per_text, counts)] = True
    bounds = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(per_text, out=bounds[1:])
    return full[keep], bounds


def distinct_in_texts(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and the new bounds."""
    if not len(values):
        return values, bounds
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros(len(bounds), np.int64)
    np.cumsum(np.bincount(owner[new], minlength=len(bounds) - 1), out=out[1:])
    return values[new], out
