"""Runs of consecutive words that repeat with a short period, and texts without the repeats.

Words are what stands between ASCII white space.  A run is a stretch of words
with smallest period q (words q apart are identical) of at least
``max(least, copies * q)`` words that no neighbouring word extends.  Its first
q words are its unit; the collapsed text drops every word that some run holds
after its unit.

Method: recursive frequency splitting.  Every word of a run stands at least
``copies`` times in it, so a word that is rarer than that within its segment
is in no run that lies in the segment, and splits it.  Splitting goes on,
with counts taken anew in each part, until no word is too rare; parts shorter
than ``least`` words go.  The surviving segments are scanned by lag: a run of
period q makes at least ``(copies - 1) * q`` words in a row equal to the word
q later, so it covers ``copies - 1`` consecutive multiples of q; only where
that many probes agree are the words between them compared.  A probe inside a
run already found, at a multiple of its period, is explained by it and not
asked again (two different runs of periods q and t share fewer than q + t
words).  So a lag costs m / q probes in a segment of m words, all lags
m log m, and each run its length once; the result is exact.

Scale: one pass over the table that moves no rows; a task holds one slice of
2 MB of text, or one longer text, with its words.  All segments of a slice
are split together in numpy.

Defined results: null and empty texts have no words, no runs and an empty
collapsed text; repeated rows and rows with null ids are treated alike, each
on its own; runs of one text are in the order of start, then period; an empty
table gives no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import slices

LEAST, COPIES = 6, 4
RUNS = "array<struct<start: long, length: long, period: long>>"


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a text column and, per row, where its words begin (rows + 1)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
    flat, begin = parts.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))))
    real = np.asarray(pc.binary_length(flat)) > 0  # white space at either end leaves an empty part
    return flat.filter(pa.array(real)), np.concatenate(([0], np.cumsum(real)))[begin].astype(np.int64)


def surviving(ids: np.ndarray, segment: np.ndarray, least: int = LEAST, copies: int = COPIES) -> tuple[np.ndarray, np.ndarray]:
    """(positions, segment of each) that are left when no word is too rare in its segment."""
    at, span = np.arange(len(ids)), int(ids.max(initial=0)) + 1
    while len(at):
        _, which, count = np.unique(segment * span + ids[at], return_inverse=True, return_counts=True)
        keep = count[which] >= copies
        whole = bool(keep.all())
        at, segment = at[keep], segment[keep]
        if not len(at):
            break
        cut = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(segment) != 0)))
        segment = np.cumsum(cut) - 1
        long = np.bincount(segment)[segment] >= least
        at, segment = at[long], segment[long]
        if whole:
            break
    return at, segment


def _streaks(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every stretch of true flags."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def scan(x: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment."""
    m, found = len(x), {}
    owner = np.full(m, -1)  # a run that holds the position
    periods: list[int] = []
    low, last = 1, m // copies
    while low <= last:
        lags = np.arange(low, min(2 * low, last + 1))  # none is a multiple of another
        low *= 2
        probes = (m - 1) // lags
        first = np.concatenate(([0], np.cumsum(probes)))
        lag = np.repeat(lags, probes)
        j = np.arange(len(lag)) - np.repeat(first[:-1], probes)
        at = j * lag
        same = x[at] == x[at + lag]
        if periods:
            o = owner[at]
            known = same & (o >= 0) & (o == owner[at + lag])
            k = np.flatnonzero(known)
            same[k[lag[k] % np.array(periods)[o[k]] == 0]] = False
        row = same.copy()
        for d in range(1, copies - 1):
            row[:-d] &= same[d:]
            row[-d:] = False
        row &= j + copies - 2 < np.repeat(probes, probes)
        a, b = _streaks(row)
        # The streak of a lag ends where the next lag's probes begin.
        for s, e in zip(a.tolist(), b.tolist()):
            while s <= e:
                t = int(lag[s])
                end = min(e, int(first[t - int(lags[0]) + 1]) - 1)
                _compare(x, t, int(at[s]), int(at[end]) + (copies - 2) * t, least, copies, found, owner, periods)
                s = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def _compare(x, t, p, q, least, copies, found, owner, periods) -> None:
    """Runs of lag t that cover the probes from p to q."""
    lo, hi = max(0, p - t + 1), min(len(x) - t, q + t)
    a, b = _streaks(x[lo:hi] == x[lo + t:hi + t])
    for s, e in zip((a + lo).tolist(), (b + lo + 1).tolist()):
        length = e - s + t
        if length < max(least, copies * t) or (s, length) in found:
            continue  # too short, or a multiple of the period it was found with
        if (s > 0 and x[s - 1] == x[s - 1 + t]) or (e + t < len(x) and x[e] == x[e + t]):
            continue  # goes on under a probe that a shorter period explains
        found[s, length] = t
        owner[s:s + length] = len(periods)
        periods.append(t)


def runs_of(ids: np.ndarray, ptr: np.ndarray, least: int = LEAST, copies: int = COPIES) -> np.ndarray:
    """(row, start, length, period) of every run of the texts whose words have
    these ids; start counts words from the text's first."""
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    at, segment = surviving(ids, row, least, copies)
    out = []
    if len(at):
        cut = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1, [len(at)]))
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            r, begin = int(row[at[lo]]), int(at[lo])
            out += [(r, begin + s - int(ptr[r]), n, q) for s, n, q in scan(ids[begin:begin + hi - lo], least, copies)]
    return np.array(sorted(out, key=lambda f: (f[0], f[1], f[3])), dtype=np.int64).reshape(-1, 4)


def _collapse(flat: pa.Array, ptr: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Texts of the words outside the repeats, joined by one space."""
    begin = ptr[runs[:, 0]] + runs[:, 1]
    held = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(held, begin + runs[:, 3], 1)
    np.add.at(held, begin + runs[:, 2], -1)
    keep = np.cumsum(held)[:-1] <= 0
    kept = np.concatenate(([0], np.cumsum(keep)))[ptr]
    parts = pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), flat.filter(pa.array(keep)))
    return pc.binary_join(parts, pa.scalar(" ", pa.large_string())).cast(pa.string())


def find_runs(df: DataFrame, id_col: str, text_col: str, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row; runs holds (start, length, period)."""
    if copies < 3 or least < 1:
        raise ValueError("copies must be at least 3 and least at least 1")
    kind = dict(df.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                flat, ptr = words(batch.column(1))
                ids = np.asarray(flat.dictionary_encode().indices).astype(np.int64)
                runs = runs_of(ids, ptr, least, copies)
                places = np.searchsorted(runs[:, 0], np.arange(len(ptr)))
                spans = pa.StructArray.from_arrays([pa.array(runs[:, c].copy()) for c in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(ptr)), pa.ListArray.from_arrays(pa.array(places, pa.int32()), spans),
                     _collapse(flat, ptr, runs)], names=["id", "n_words", "runs", "collapsed"])

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, n_words long, runs {RUNS}, collapsed string"))
