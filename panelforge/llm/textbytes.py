"""Arrow text columns as flat byte arrays, and words in them as hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier of the word hash, and its powers by place in a word.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(256, MULTIPLIER, np.uint64), dtype=np.uint64)


def powers(place: np.ndarray, longest: int) -> np.ndarray:
    """The multiplier to the power of each place plus one."""
    if longest <= 256:
        return POWERS[place]
    steps = np.cumprod(np.full(longest // 256 + 1, POWERS[255], np.uint64), dtype=np.uint64)
    return POWERS[place & 255] * np.concatenate(([np.uint64(1)], steps))[place >> 8]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    filled = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), at


def row_runs(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have limit bytes at most together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads the high bits of products over all bits."""
    h = hashes ^ (hashes >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs in which inside is true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order, not empty and don't overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(own * powers(place, int(lengths.max())), np.cumsum(lengths) - lengths))
