"""Words, shingles and their 64-bit hashes over whole Arrow columns, in NumPy.

A word is a maximal run of bytes other than ASCII white space, with A-Z in lower
case.  Equal words have equal hashes; two different ones share a hash with a
chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at a time; a longer word is hashed alone.
_BLOCK = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and its row offsets into them; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0]:starts[-1]], starts - starts[0]


def row_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut a column into runs of rows of about ``most`` bytes; a longer row is alone."""
    _, offsets = text_buffer(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = max(at + 1, min(end, len(column)))
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes in order, and per row the place of its first word (and the end)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, side="right")))
        low, high = int(starts[at]), int(ends[to - 1])
        powers = np.full(high - low + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_CODES[data[low:high]] * powers[:-1], out=sums[1:])
        back = np.full(high - low + 1, _INVERSE, np.uint64)
        back[0] = 1
        back = np.cumprod(back)
        s, e = starts[at:to] - low, ends[at:to] - low
        hashes[at:to] = (sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64)
        at = to
    return mixed(hashes), np.searchsorted(starts, offsets, side="left")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its word shingles.

    A row of fewer words than ``width`` has its whole sequence as one shingle,
    a row without words has none.
    """
    words, firsts = word_hashes(data, offsets)
    spread = [mixed(words + np.uint64(0x51_7CC1 * (k + 1))) for k in range(width)]
    full = len(words) - width + 1
    if full > 0:
        rolled = spread[0][:full].copy()
        for k in range(1, width):
            rolled += spread[k][k:full + k] * np.uint64(2 * k + 1)
        rolled = mixed(rolled)
    sets = []
    for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if high - low >= width:
            sets.append(np.unique(rolled[low:high - width + 1]))
        elif high > low:
            short = np.uint64(high - low)
            for k in range(high - low):
                short = mixed(np.array([short ^ spread[k][low + k]]))[0]
            sets.append(np.array([short], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
