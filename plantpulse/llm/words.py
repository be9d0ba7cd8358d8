"""Words of many texts at once: NumPy over the UTF-8 bytes of Arrow columns.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z: ASCII digits, ASCII letters and
everything beyond ASCII. All bytes of a character beyond ASCII are 128 or more, so bytes tell words apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a group of its own.
GROUP_BYTES = 2 << 20

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

_rng = np.random.default_rng(20)
SALT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full((1 << 16) - 1, BASE, np.uint64))])


class Words(NamedTuple):
    data: np.ndarray  # lowered bytes
    start: np.ndarray  # of each word, in bytes
    end: np.ndarray
    hash: np.ndarray  # 64 bits of each word
    first: np.ndarray  # of each text, its first word; one more at the end


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def groups(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds of the texts in them) of groups of rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def words(data: np.ndarray, bounds: np.ndarray) -> Words:
    low = LOWERED[data]
    inside = IS_WORD[low]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(low):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[bounds[:-1][bounds[:-1] < len(low)]] = False
        after[bounds[1:][bounds[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    h = np.zeros(len(start), np.uint64)
    if len(start):
        length = end - start
        at = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(at, length)
        h = mixed(np.add.reduceat(SALT[low[inside]] * POWERS[place & 0xFFFF], at) + length.astype(np.uint64))
    return Words(low, start, end, h, np.searchsorted(start, bounds))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words, across texts too; the caller leaves those out."""
    n = max(0, len(h) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += h[i : i + n] * POWERS[i + 1]
    return mixed(total)


def spelled(w: Words, at: int, k: int) -> bytes:
    """k words from the at-th, joined by single blanks."""
    return b" ".join(w.data[w.start[i] : w.end[i]].tobytes() for i in range(at, at + k))
