"""Vectorised words and shingles over Arrow text columns.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII
characters of the lower-cased text.  Words become 64-bit hashes in numpy,
for all rows of a batch at once, so no Python code runs per word.  Null
texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_SEGMENT = 1 << 20  # bytes hashed at a time; bounds the scratch arrays
SHINGLE_BITS = 52  # a row number and a shingle share one sortable 64-bit key
MAX_ROWS = (1 << (64 - SHINGLE_BITS)) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

_IS_WORD = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IS_WORD[_lo:_hi + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seed(n: int) -> np.uint64:
    """The n-th of a fixed sequence of odd 64-bit multipliers."""
    return mix(np.array([n + 1], dtype=U) * U(_BASE))[0] | U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0) of a text column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch at rows so that each part's text has about ``max_bytes``
    (a longer text is a part of its own) and it has at most MAX_ROWS rows."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > lo and (held + n > max_bytes or i - lo >= MAX_ROWS):
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def _segments(word: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Cuts of the byte buffer that never fall inside a word."""
    lo = 0
    while lo < n:
        hi = min(lo + _SEGMENT, n)
        if hi < n and word[hi - 1] and word[hi]:
            gap = np.flatnonzero(~word[lo:hi])
            if len(gap):
                hi = lo + int(gap[-1]) + 1
        while hi < n and word[hi - 1] and word[hi]:  # a word longer than a segment
            gap = np.flatnonzero(~word[hi:hi + _SEGMENT])
            hi = hi + int(gap[0]) if len(gap) else min(hi + _SEGMENT, n)
        yield lo, hi
        lo = hi


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and, per row, where its words begin (rows + 1)."""
    data, offsets = text_buffers(pc.utf8_lower(column.cast(pa.large_string())))
    n = len(data)
    word = _IS_WORD[data]
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = word
    before[offsets] = False
    starts = np.flatnonzero(word & ~before[:-1])
    after = np.zeros(n + 1, dtype=bool)
    after[:-1] = word
    after[offsets] = False
    ends = np.flatnonzero(word & ~after[1:]) + 1
    out = np.empty(len(starts), dtype=U)
    with np.errstate(over="ignore"):
        for lo, hi in _segments(word, n):
            a, b = np.searchsorted(starts, (lo, hi))
            if a == b:
                continue
            up, down = _tables(max(_SEGMENT, hi - lo))
            total = np.zeros(hi - lo + 1, dtype=U)
            np.cumsum(data[lo:hi].astype(U) * up[:hi - lo], out=total[1:])
            s, e = starts[a:b] - lo, ends[a:b] - lo
            out[a:b] = (total[e] - total[s]) * down[s] + (e - s).astype(U)
        out = mix(out)
    return out, np.searchsorted(starts, offsets).astype(np.int64)


def rolled(hashes: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One hash per start position over the words at ``places`` from there."""
    n = len(hashes) - places[-1]
    if n <= 0:
        return np.zeros(0, dtype=U)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=U)
        for j, p in enumerate(places):
            out += hashes[p:p + n] * seed(j)
        return mix(out)


def row_of(ptr: np.ndarray) -> np.ndarray:
    """Row number of every item, from the row pointers."""
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def starts_inside(ptr: np.ndarray, span: int) -> np.ndarray:
    """Which start positions leave ``span`` items before their row ends
    (for the positions that ``rolled`` returns)."""
    total = int(ptr[-1])
    room = np.repeat(ptr[1:], np.diff(ptr)) - np.arange(total)
    return room[:max(0, total - span + 1)] >= span


def shingle_sets(column: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` words per row, ascending in each row.

    Returns (``SHINGLE_BITS``-bit hashes, row pointers), for at most
    ``MAX_ROWS`` rows.  A text of fewer than ``k`` words has one shingle,
    all its words; one of no words has none.
    """
    h, ptr = words(column)
    rows = len(ptr) - 1
    if rows > MAX_ROWS:
        raise ValueError(f"at most {MAX_ROWS} rows at a time")
    count = np.diff(ptr)
    parts, owner = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    at = np.flatnonzero(starts_inside(ptr, k))
    if len(at):
        parts.append(rolled(h, tuple(range(k)))[at])
        owner.append(row_of(ptr)[at])
    for short in range(1, k):
        who = np.flatnonzero(count == short)
        if len(who):
            with np.errstate(over="ignore"):
                x = np.full(len(who), short, dtype=U)
                for j in range(short):
                    x += h[ptr[who] + j] * seed(j)
                parts.append(mix(x))
            owner.append(who)
    key = (np.concatenate(owner).astype(U) << U(SHINGLE_BITS)) | (np.concatenate(parts) >> U(64 - SHINGLE_BITS))
    key.sort()
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = key[1:] != key[:-1]
    key = key[keep]
    ends = np.cumsum(np.bincount((key >> U(SHINGLE_BITS)).astype(np.int64), minlength=rows))
    return key & U((1 << SHINGLE_BITS) - 1), np.concatenate(([0], ends)).astype(np.int64)
