"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than space and \\t to \\r. In UTF-8 these bytes are never part of another
character. A word's 64-bit hash is a sum of random values per byte times powers of an odd base, brought
to a common place and mixed; two different words share one with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240101)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEPS = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 19)
        up, down = np.full(n, _BASE), np.full(n, _BACK)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


@dataclass
class Words:
    """``begin`` and ``end`` are byte places in ``data``; text i has words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the offsets of its texts in them."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = bytes_of(column)
    n = len(data)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    # a text's first byte starts a word even if the byte before, of another text, is in one
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    starts = inside[1:-1] & ~inside[:-2]
    starts[cut] = inside[1:-1][cut]
    stops = inside[1:-1] & ~inside[2:]
    stops[cut - 1] = inside[1:-1][cut - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    up, down = _powers_to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    value = (sums[end] - sums[begin]) * down[begin]
    hashed = mix(value ^ mix((end - begin).astype(np.uint64) * _BASE))
    return Words(data, offsets, begin, end, hashed, np.searchsorted(begin, offsets))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbouring words; the runs don't know where a text ends."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * _STEPS[k]
    return mix(out)


def counted(marks: np.ndarray) -> np.ndarray:
    """Sums of marks before each place, so that a span's sum is a difference."""
    out = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=out[1:])
    return out
