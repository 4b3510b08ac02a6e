"""Word tables of Arrow text columns with numpy: no Python object per word.

Texts are handled as the UTF-8 bytes Arrow holds. A chunk is a run of rows of
half a MB; word starts, ends and 64-bit hashes of all its rows come from a few
array passes. Texts larger than a segment are cut only between words, so memory
stays bounded by the segment and by 24 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
SEGMENT_BYTES = 1 << 19

_P = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_Q = np.uint64(0xD6E8FEB86659FD93)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data, offsets


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of row runs of about ``most`` bytes; a longer text stands alone."""
    data, offsets = utf8(column)
    rows, lo = len(offsets) - 1, 0
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


class TaskCache(dict):
    """What a task keeps for its next batches. It is empty again wherever it is sent, so what the driver worked
    out does not travel with every task."""

    def __reduce__(self):
        return TaskCache, ()


_TABLES = TaskCache()


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64; the longest table so far is kept for the task."""
    if len(_TABLES.get(base, ())) < n:
        out = np.full(max(n, SEGMENT_BYTES), base, np.uint64)
        out[:1] = 1
        _TABLES[base] = np.multiply.accumulate(out)
    return _TABLES[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _segment(data: np.ndarray, row_starts: np.ndarray, classes: np.ndarray, hashed: bool):
    kind = classes[data]
    first, last = kind > 0, kind > 0
    change = kind[1:] != kind[:-1]
    first[1:] &= change
    last[:-1] &= change
    first[row_starts] = kind[row_starts] > 0
    before = row_starts[row_starts > 0] - 1
    last[before] = kind[before] > 0
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not hashed:
        return starts, ends, None
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(data)), out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * _powers(_P_INV, len(data))[starts])


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray, hashed: bool = True):
    """Byte starts and ends of every word, its hash, and per row the number of the first word (n+1 values).

    ``classes`` has the class of each byte: 0 stands between words, and a word is a run of one class.

    Equal words have equal hashes wherever they stand; different words may collide.
    """
    row_starts = np.unique(offsets[:-1][offsets[:-1] < len(data)])
    found, lo = [], 0
    while lo < len(data):
        hi = lo + SEGMENT_BYTES
        while hi < len(data):  # up to the next byte that no word holds
            gap = np.flatnonzero(classes[data[hi:hi + SEGMENT_BYTES]] == 0)
            if len(gap):
                hi += int(gap[0])
                break
            hi += SEGMENT_BYTES
        hi = min(hi, len(data))
        a, b = np.searchsorted(row_starts, (lo, hi))
        starts, ends, hashes = _segment(data[lo:hi], row_starts[a:b] - lo, classes, hashed)
        found.append((starts + lo, ends + lo, hashes))
        lo = hi
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = (np.concatenate([x[i] for x in found]) for i in (0, 1))
    hashes = np.concatenate([x[2] for x in found]) if hashed else None
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` consecutive word hashes."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for k in range(1, n):
        out *= _Q
        out += hashes[k:k + count]
    return mix(out)


def byte_class(delimiters: bytes, apart: bytes = b"") -> np.ndarray:
    """Class of each byte: 0 for delimiters, 2 for bytes that make up words of their own, else 1."""
    table = np.ones(256, np.uint8)
    table[np.frombuffer(delimiters, np.uint8)] = 0
    table[np.frombuffer(apart, np.uint8)] = 2
    return table


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, also those of longer UTF-8 characters, stay."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]
