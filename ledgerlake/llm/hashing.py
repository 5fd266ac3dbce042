"""Vectorised hashes of spans of bytes and of runs of words, for use inside tasks.

A span's hash is a difference of prefix sums of a polynomial modulo 2^64, so the hashes of all
windows of a text cost a few array operations, whatever the window's length.
"""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Cache(dict):
    """Filled anew in each process; what is in it does not travel with tasks."""

    def __reduce__(self):
        return _Cache, ()


_powers = _Cache()


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTES = _table(20)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse, n + 1 of each."""
    up, down = _powers.get(which, (np.empty(0, np.uint64),) * 2)
    if len(up) <= n:
        size = max(n + 1, 1 << 16)
        steps = [np.full(size, b, dtype=np.uint64) for b in (_BASES[which], pow(_BASES[which], -1, 2**64))]
        for s in steps:
            s[0] = 1
        up, down = (np.multiply.accumulate(s) for s in steps)
        if size <= 1 << 24:  # what one huge text needs is not kept
            _powers[which] = up, down
    return up, down


class Spans:
    """Hashes of spans [start, end) of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self._down = _power(which, len(values))
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """The hash of every run of ``size`` values."""
        n = len(self._sums) - size
        return mix((self._sums[size:] - self._sums[:n]) * self._down[:n] + np.uint64(size)) if n > 0 else np.empty(0, np.uint64)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are no white space."""
    solid = np.concatenate(([False], ~SPACE[data], [False]))
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    return turns[::2], turns[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(byte_values(data)).of(starts, ends)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` values."""
    if len(values) < size:
        return values[:0]
    out, width = values, 1
    while 2 * width <= size:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    return np.minimum(out[: len(values) - size + 1], out[size - width :]) if width < size else out


def leftmost_min(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the leftmost minimum of every run of ``size`` hashes, by their upper 32 bits."""
    tagged = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    return (sliding_min(tagged, size) & np.uint64(0xFFFFFFFF)).astype(np.int64)
