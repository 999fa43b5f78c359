"""Words of many texts at once, as positions and hashes in one buffer of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
STEP = U(0x9E3779B97F4A7C15)
VALUE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
VALUE[ord("A") : ord("Z") + 1] = VALUE[ord("a") : ord("z") + 1]  # letter case does not count
BACK = U(pow(int(STEP), -1, 2**64))
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP^i and its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            for i, base in enumerate((STEP, BACK)):
                row = np.full(max(n, 1 << 20), base, U)
                row[0] = 1
                _powers[i] = np.cumprod(row)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (the finish of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def slices(texts: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of about ``limit`` bytes; a longer text comes alone.  Null is empty."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + limit, side="right")) - 1)
        b = min(b, len(column))
        yield a, b, bounds[a : b + 1] - bounds[a], data[bounds[a] : bounds[b]]
        a = b


class Words:
    """doc, start, end (bytes) and hash of every word; ``prefix(n)`` hashes its first bytes."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        n = len(data)
        self.data, self.offsets = data, offsets
        solid = ~SPACE[data]
        opens, closes = solid.copy(), solid.copy()
        if n:
            opens[1:] &= ~solid[:-1]
            closes[:-1] &= ~solid[1:]
            full = offsets[:-1] < offsets[1:]
            first, last = offsets[:-1][full], offsets[1:][full] - 1
            opens[first], closes[last] = solid[first], solid[last]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        forward, self.back = powers(n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, U), np.cumsum(VALUE[data] * forward[:n])])

    def hashed(self, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[self.start]) * self.back[self.start] + (end - self.start).astype(U))
