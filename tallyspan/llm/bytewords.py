"""Words of many texts at once: numpy over the bytes of an Arrow string column.

A word class is a table of 256 booleans over UTF-8 bytes. All classes used here treat the
bytes above 0x7F alike, so splitting bytes equals splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # two odd multipliers, any will do


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the given inclusive byte ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: ``[^\x20\x09-\x0D]``
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ASCII letters and digits once lower-cased, and everything beyond ASCII.
LOWER_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Texts:
    """The bytes of neighbouring rows, and where each row begins and ends."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Runs of whole rows of about ``limit`` bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, values = column.buffers()
    ends = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(ends, ends[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield Texts(row, data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row])
        row = stop


def find_words(texts: Texts, table: np.ndarray, data: np.ndarray | None = None):
    """Starts and ends of all words, and the index of each row's first word.

    Words never reach over the end of a row. The last array has one more entry than rows.
    """
    data = texts.data if data is None else data
    inside = table[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, texts.offsets)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(which: int, n: int):
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(_ODD[which], -1, 1 << 64)
        both = []
        for factor in (_ODD[which], inverse):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[which] = tuple(both)
    return _powers[which]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0):
    """A 64-bit hash of each span of bytes; ``starts`` ascend.

    Works through stretches of about ``SLICE_BYTES``, so that a text of any length needs
    little memory besides its own bytes.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = int(np.searchsorted(starts, base + SLICE_BYTES))
        stop = max(stop, at + 1)
        top = int(ends[at:stop].max())
        up, down = _powers_of(which, top - base)
        sums = np.zeros(top - base + 1, dtype=np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up[: top - base], out=sums[1:])
        a, b = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = (sums[b] - sums[a]) * down[a]
        at = stop
    return mixed(out)


def window_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes, over all words as one sequence."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    factor = np.uint64(_ODD[1 - which])
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total *= factor
        total += words[k : k + n]
    return mixed(total)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
