"""A minimal perfect hash of 128-bit keys: n distinct keys to the slots 0 .. n-1.

Level by level, keys that alone hit a bit of the level's bit array take it; the others go on to
the next level. A key's slot is the rank of its bit. About three bits for each key.
"""

from __future__ import annotations

import numpy as np

from ledgerlake.llm.hashing import mix

GAMMA = 1.7
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(a + b * (_STEP * np.uint64(2 * level + 1))) % np.uint64(size)).astype(np.int64)


def build(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes and packed bits for distinct keys (a, b)."""
    sizes, bits, left = [], [], np.arange(len(a))
    while len(left):
        size = max(64, -(-int(GAMMA * len(left)) // 8) * 8)
        at = _place(a[left], b[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        left = left[~alone[at]]
    return np.array(sizes, dtype=np.int64), np.concatenate(bits) if bits else np.empty(0, np.uint8)


def slots(sizes: np.ndarray, bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The slot of each key; a key that was not built in gets any slot, or -1."""
    out = np.full(len(a), -1, dtype=np.int64)
    left, at_bit, before = np.arange(len(a)), 0, 0
    for level, size in enumerate(sizes):
        own = np.unpackbits(bits[at_bit // 8 : (at_bit + size) // 8]).astype(bool)
        rank = np.cumsum(own)
        at = _place(a[left], b[left], level, int(size))
        hit = own[at]
        out[left[hit]] = before + rank[at[hit]] - 1
        left, at_bit, before = left[~hit], at_bit + int(size), before + int(rank[-1])
    return out
