"""Byte-level BPE of many texts at once, piece by piece.

The byte-level split (letters, numbers, others, each with the blank before
it; contractions; white space) is found in numpy for all texts of a batch:
classes of code points, then the places where a piece begins.  A piece of up to
16 bytes is two 64-bit numbers and a length, and its ids are looked up in a
table of fixed size that lives as long as the worker; all three are compared, so
a hit is exact.  What isn't there is encoded by the tokenizer, and takes
its slot if that is free.  Only speed depends on the table.

Texts that the split can't judge (code points without a category, special
strings) or that would take much memory (over ``LONGEST`` characters) are left to the
caller.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

LONGEST = 1 << 20  # characters
TOGETHER = 1 << 19  # characters split at a time, or one text
SLOT_BITS, WIDTH = 19, 6  # the table holds 2 ** SLOT_BITS pieces of up to WIDTH ids: 22 MB
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
# Code points with the property White_Space (fixed values).
BLANK = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_U = np.uint64
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=_U)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point; those without a category are unknown."""
    of = {"L": LETTER, "N": NUMBER}
    out = np.array([UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else of.get(c[0], OTHER)
                    for i in range(0x110000)], dtype=np.uint8)
    out[list(BLANK)] = SPACE
    return out


def begins(cp: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts set one behind another, which begin at ``first``."""
    n = len(cp)
    run = np.empty(n, dtype=bool)  # the first of its class
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run[first] = True
    ends = np.ones(n, dtype=bool)
    ends[:-1] = run[1:]
    last = np.zeros(n, dtype=bool)
    last[first[1:] - 1] = last[-1] = True
    # The last of several blanks stands apart, and a space joins what follows it.
    tail = (kind == SPACE) & ends & ~last
    cut = run | tail
    cut[1:] &= ~(tail & (cp == 0x20))[:-1]
    at = np.flatnonzero(cp == 0x27)
    at = at[cut[at] & ends[at] & ~last[at]]
    if len(at):
        one = cp[at + 1]
        two = np.where(last[at + 1], 0, cp[np.minimum(at + 2, n - 1)])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        cut[at[short | long] + 1] = False
        rest = np.concatenate((at[short] + 2, at[long] + 3))
        cut[rest[rest < n]] = True
    return np.flatnonzero(cut)


class Pieces:
    """Ids of many texts under a byte-level BPE: ``encode`` gives those of one piece's bytes,
    and texts with one of the strings ``special`` aren't judged."""

    def __init__(self, encode: Callable[[bytes], list[int]], special: tuple[str, ...] = (), slot_bits: int = SLOT_BITS):
        self.encode, self.special, self.shift = encode, special, _U(64 - slot_bits)
        slots = 1 << slot_bits
        self.low, self.high = np.zeros(slots, dtype=_U), np.zeros(slots, dtype=_U)
        self.size, self.count = np.zeros(slots, dtype=np.uint8), np.zeros(slots, dtype=np.uint8)
        self.ids = np.zeros((slots, WIDTH), dtype=np.uint32)

    def ids_of(self, texts: list[str]) -> tuple[list[bool], list[np.ndarray]]:
        """(whether each text can be judged, the ids of those that can)."""
        kinds, known = classes(), []
        for text in texts:
            good = 0 < len(text) <= LONGEST and not any(x in text for x in self.special)
            if good and not text.isascii():
                good = kinds[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].max() < UNKNOWN
            known.append(bool(good))
        out, held, size = [], [], 0
        for text in (text for text, good in zip(texts, known) if good):
            if held and size + len(text) > TOGETHER:
                out += self._ids(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        return known, out + self._ids(held) if held else out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = "".join(texts)
        data = whole.encode()
        first = np.cumsum([0, *map(len, texts)])
        if len(data) == len(whole):
            cp = np.frombuffer(data, dtype=np.uint8)
            place = None
        else:
            cp = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
            wide = (cp >= 0x80).astype(np.uint8)
            wide += cp >= 0x800
            wide += cp >= 0x10000
            place = np.zeros(len(cp) + 1, dtype=np.int64)
            np.cumsum(wide + np.uint8(1), out=place[1:])
        at = begins(cp, classes()[cp], first[:-1])
        owner = np.searchsorted(at, first)  # pieces before each text
        lo = at if place is None else place[at]
        hi = np.append(lo[1:], len(data))
        size = hi - lo
        # Sixteen bytes from each place on, as two numbers.
        padded = data + bytes(16)
        low = np.ndarray(len(data) + 8, dtype="<u8", buffer=padded, strides=(1,))
        a = low[lo] & _MASK[np.minimum(size, 8)]
        b = low[np.minimum(lo + 8, len(data))] & _MASK[np.clip(size - 8, 0, 8)]
        with np.errstate(over="ignore"):
            key = (a ^ (b * _U(0xC2B2AE3D27D4EB4F)) ^ size.astype(_U)) * _U(0x9E3779B97F4A7C15)
        slot = (key >> self.shift).astype(np.int64)
        hit = (self.low[slot] == a) & (self.high[slot] == b) & (self.size[slot] == size) & (size <= 16)
        # What isn't in the table, equal pieces together.
        miss = np.flatnonzero(~hit)
        miss = miss[np.argsort(key[miss], kind="stable")]
        new = np.ones(len(miss), dtype=bool)
        new[1:] = ((a[miss][1:] != a[miss][:-1]) | (b[miss][1:] != b[miss][:-1])
                   | (size[miss][1:] != size[miss][:-1]) | (size[miss][1:] > 16))
        one = miss[new]
        found = [self.encode(data[x:y]) for x, y in zip(lo[one].tolist(), hi[one].tolist())]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum()))
        behind = np.cumsum(lengths) - lengths
        group = np.cumsum(new) - 1
        count = self.count[slot].astype(np.int64)
        count[miss] = lengths[group]
        offset = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(offset[-1], dtype=np.uint32)
        good = np.flatnonzero(hit)
        known = slot[good]
        for j in range(WIDTH):
            more = count[good] > j
            good, known = good[more], known[more]
            out[offset[good] + j] = self.ids[known, j]
        step = np.arange(int(count[miss].sum())) - np.repeat(np.cumsum(count[miss]) - count[miss], count[miss])
        out[np.repeat(offset[miss], count[miss]) + step] = flat[np.repeat(behind[group], count[miss]) + step]
        # They take the slots that are free.
        fits = np.flatnonzero((size[one] <= 16) & (lengths <= WIDTH) & (self.size[slot[one]] == 0))
        taken, last = np.unique(slot[one[fits]], return_index=True)
        fits = fits[last]
        kept = one[fits]
        self.low[taken], self.high[taken], self.size[taken] = a[kept], b[kept], size[kept]
        self.count[taken] = lengths[fits]
        for j in range(WIDTH):
            more = lengths[fits] > j
            self.ids[taken[more], j] = flat[behind[fits[more]] + j]
        cuts = offset[owner]
        return [out[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
