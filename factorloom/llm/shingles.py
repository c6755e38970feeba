"""Word shingles of many texts at once, as sorted 64-bit hashes, straight from Arrow's text buffers."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xD1342543DE82EF95)
#: Bytes of text that are handled at a time; a longer text is handled alone.
SLICE = 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """Each value scattered over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, A-Z like a-z, and whether it is white space."""
    value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_SEED))
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return value, space


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    out = []
    for base in (int(_STEP), pow(int(_STEP), -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def text_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows, their bytes, and where each row's bytes begin and end; NULL is empty. ``most`` bytes but for the first row."""
    column = column.fill_null("").cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield slice(start, end), raw[at[start] : at[end]], at[start : end + 1] - at[start]
        start = end


def shingle_sets(raw: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingles of each row, sorted, one row after the other, and where each row's begin.

    Words are runs of other than ASCII white space, A-Z lowered. A row of fewer words has its whole sequence
    as its only shingle, a row without words has none.
    """
    rows = len(at) - 1
    value, space = _bytes()
    inside = np.concatenate(([False], ~space[raw], [False]))
    edge = inside[1:] != inside[:-1]  # before each byte, and after the last
    cut = np.unique(at)
    starts = np.flatnonzero(edge & inside[1:])
    ends = np.flatnonzero(edge & inside[:-1])
    both = cut[inside[cut] & inside[cut + 1]]  # rows that touch without white space between
    if len(both):
        starts, ends = np.sort(np.concatenate((starts, both))), np.sort(np.concatenate((ends, both)))
    up, down = _powers(1 << max(20, int(len(raw)).bit_length()))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(value[raw] * up[: len(raw)], dtype=np.uint64)))
    word = mixed((sums[ends] - sums[starts]) * down[starts])
    row = np.searchsorted(at, starts, "right") - 1
    n_words = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(n_words)))[:-1]
    size = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    where = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(where[-1], np.uint64)

    def joined(begin: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(begin), n, np.uint64)
        for j in range(n):
            h = mixed(h * _STEP + word[begin + j])
        return h

    long = n_words >= k
    begin = np.flatnonzero(np.arange(len(word)) + k <= (first + n_words)[row]) if len(word) else np.zeros(0, np.int64)
    out[np.repeat(long, size)] = joined(begin, k)
    for n in range(1, k):
        short = np.flatnonzero(n_words == n)
        out[where[short]] = joined(first[short], n)
    for a, b in zip(where[:-1].tolist(), where[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    owner = np.repeat(np.arange(rows), size)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=rows))))
