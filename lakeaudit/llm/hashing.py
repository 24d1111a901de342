"""Vectorised hashes of byte ranges, words and word windows of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes of text that are hashed together, few enough for a processor's cache; a longer text is a run of its own.
RUN_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit number for each byte value.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    if base not in _powers or len(_powers[base]) < n:
        size = 1 << max(19, n.bit_length())
        _powers[base] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))])
    return _powers[base][:n]


class Ranges:
    """Hashes of any ranges of a byte buffer: differences of one running sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * _power(_BASE, len(data)), out=self.sums[1:])
        self.back = _power(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def all_of(self, size: int) -> np.ndarray:
        """Hashes of all ranges of one size, by their start."""
        n = max(0, len(self.sums) - size)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_numpy(zero_copy_only=False).tolist()):
        held += size
        if held >= limit:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def joined(texts: pa.Array, separator: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one buffer, each followed by the separator, and where each begins (and the last ends)."""
    parts = texts.cast(pa.large_binary()).to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(x) + len(separator) for x in parts])]).astype(np.int64)
    return np.frombuffer(separator.join([*parts, b""]), np.uint8), bounds


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased, split at blanks), and where each text's words begin (and the last end)."""
    data, bounds = joined(texts, b" ")
    data = _LOWER[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[data]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    return Ranges(data).hash(start, end), np.searchsorted(start, bounds)


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words within each text, in order, and their bounds.

    A text of fewer words, but at least one, has one window: all its words.
    """
    n = np.diff(bounds)
    per_text = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per_text)])
    first = np.repeat(bounds[:-1] - out_bounds[:-1], per_text) + np.arange(out_bounds[-1])
    have = np.repeat(np.minimum(n, size), per_text)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = have.astype(np.uint64)
    for i in range(size):
        total = np.where(i < have, total * np.uint64(0xC2B2AE3D27D4EB4F) + padded[first + i], total)
    return mix(total), out_bounds
