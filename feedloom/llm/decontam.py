"""Benchmark decontamination by spaced seeds.

A seed reads six words of a span of eight; what stands at the positions its
mask ignores may differ.  Hashes of all seeds of the benchmark are joined with
the seeds of the texts; around each hit the item and the text are aligned and
compared word by word.  A leak is a window of ``window`` item words of which
at least ``share`` agree with the text; a shorter item is one window, and one
of fewer than ``WHOLE`` words must stand whole.  The two masks together hit every
window of 13 words with up to two substitutions, wherever they stand (tested
exhaustively).  For each length below that which the benchmark has, masks are
chosen until every allowed set of substitutions is hit (``masks_for``).

Scale: texts are read once.  A bitmap of the benchmark's seed hashes, of a
size fixed by a parameter, drops the seeds that no item has before anything
moves, so only the surroundings of possible hits are written and shuffled;
the exact join on hashes follows.  A fuller bitmap (a larger benchmark) only
lets more through.  Candidates are (passage, item, alignment) triples, made
distinct before the words are fetched for comparison.

Defined results: one row per (id, item) with the best alignment, the earliest
of equally good ones; rows with one id are one document; a null id is a
document of its own name; items with equal words are reported as the smallest
id, items that have no id together as null; items or texts that are null, empty
or without words match nothing; empty
tables give no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import U, mix, rolled, row_of, seed, slices, starts_inside, words
from feedloom.operators.fetch import join_on_key
from feedloom.session import fresh_dir

SPAN = 8
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
WINDOW = 13
SHARE = 0.8
WHOLE = 5  # items of fewer words must stand whole
FILTER_BITS = (24, 27)  # log2 of the bitmap's least and largest number of bits (16 MB at most)


def _least(width: int, share: float) -> int:
    """Words of a window that must agree."""
    return math.ceil(share * width - 1e-9) if width >= WHOLE else width


@lru_cache(maxsize=64)
def masks_for(n: int, wrong: int, most: int = 4) -> tuple[tuple[int, ...], ...]:
    """Masks of which one, somewhere in ``n`` words, meets none of any ``wrong``
    substituted ones: the heaviest that take at most ``most`` masks."""
    if wrong == 0:
        return (tuple(range(n)),)
    sets = list(itertools.combinations(range(n), wrong))
    for weight in range(n - wrong, 0, -1):
        shapes = [(0, *rest) for rest in itertools.combinations(range(1, min(n, SPAN)), weight - 1)]
        hits = {m: {w for w in sets for o in range(n - m[-1]) if not {p + o for p in m} & set(w)} for m in shapes}
        chosen, left = [], set(sets)
        while left and len(chosen) < most:
            best = max(shapes, key=lambda m: (len(hits[m] & left), [-p for p in m]), default=None)
            if best is None or not hits[best] & left:
                break
            chosen.append(best)
            left -= hits[best]
        if not left:
            return tuple(chosen)
    raise ValueError(f"no masks for {n} words with {wrong} substitutions")


def _masks(lengths: list[int], window: int, share: float) -> dict[tuple[int, ...], set[int] | None]:
    """Seed masks with the item lengths they are for; the general ones are for all."""
    out: dict[tuple[int, ...], set[int] | None] = {m: None for m in MASKS}
    for n in lengths:
        if n < window:
            for m in masks_for(n, n - _least(n, share)):
                if m not in MASKS:
                    out.setdefault(m, set()).add(n)
    return out


def _seeds(h: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(rolled(h, mask) ^ seed(1000 + sum(1 << p for p in mask)))


def _items(bench: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(key, item, n, words) of each distinct sequence of words; the key is
    fixed by landing the rows."""
    kind = dict(bench.select(item_col).dtypes)[item_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, ptr = words(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(ptr), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(h.view(np.int64)))],
                    names=["item", "n", "words"])

    rows = (bench.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(read, f"item {kind}, n int, words array<long>").where(F.col("n") > 0))
    return (rows.groupBy("words").agg(F.min("item").alias("item"), F.first("n").alias("n"))
            .select(F.monotonically_increasing_id().alias("key"), "item", "n", "words"))


def _item_seeds(items: DataFrame, masks) -> DataFrame:
    """(hash, key, at) of every seed of the benchmark."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            h = np.asarray(lists.flatten()).view(U)
            ptr = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths())))).astype(np.int64)
            owner, size = row_of(ptr), np.diff(ptr)
            for mask, lengths in masks.items():
                at = np.flatnonzero(starts_inside(ptr, mask[-1] + 1))
                if lengths is not None:
                    at = at[np.isin(size[owner[at]], list(lengths))]
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_seeds(h, mask)[at].view(np.int64)), batch.column(0).take(pa.array(owner[at])),
                         pa.array((at - ptr[owner[at]]).astype(np.int32))], names=["hash", "key", "at"])

    return items.select("key", "words").mapInArrow(read, "hash long, key long, at int")


def _probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h >> U(64 - bits), (h * U(0x9E3779B97F4A7C15)) >> U(64 - bits)


def _bitmap(seeds: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bit array with two bits set per seed hash, and log2 of its length."""
    low, high = FILTER_BITS
    bits = min(high, max(low, math.ceil(math.log2(64 * max(1, count)))))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                at = np.unique(np.concatenate(_probes(np.asarray(batch.column(0)).view(U), bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> U(6)).view(np.int64)), pa.array((U(1) << (at & U(63))).view(np.int64))],
                names=["place", "bit"])

    set_ = (seeds.select("hash").mapInArrow(probe, "place long, bit long")
            .groupBy("place").agg(F.bit_or("bit").alias("word")).toArrow())  # at most 2**(bits - 6) rows
    out = np.zeros(1 << (bits - 6), dtype=U)
    out[np.asarray(set_.column("place"))] = np.asarray(set_.column("word")).view(U)
    return out, bits


def _passages(ids: pa.Array, h: np.ndarray, ptr: np.ndarray, masks, bitmap: np.ndarray, bits: int, around: int):
    """Record batch of the passages that hold possible hits."""
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for mask in masks:
        if len(h) <= mask[-1]:
            continue
        s = _seeds(h, mask)
        ok = starts_inside(ptr, mask[-1] + 1)
        with np.errstate(over="ignore"):
            a, b = _probes(s, bits)
        ok &= (bitmap[a >> U(6)] >> (a & U(63))) & U(1) != 0
        hit = np.flatnonzero(ok)
        hit = hit[(bitmap[b[hit] >> U(6)] >> (b[hit] & U(63))) & U(1) != 0]
        at.append(hit)
        hashes.append(s[hit])
    at, hashes = np.concatenate(at), np.concatenate(hashes)
    if not len(at):
        return None
    order = np.argsort(at, kind="stable")
    at, hashes = at[order], hashes[order]
    row = np.searchsorted(ptr, at, side="right") - 1
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (np.diff(at) > 2 * around)
    cut = np.append(np.flatnonzero(fresh), len(at))
    first, last, owner = at[cut[:-1]], at[cut[1:] - 1], row[cut[:-1]]
    begin = np.maximum(first - around, ptr[owner])
    end = np.minimum(last + SPAN + around, ptr[owner + 1])
    size = end - begin
    inside = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
    which = np.repeat(np.arange(len(first)), np.diff(cut))
    uid = [os.urandom(16) for _ in range(len(first))]
    lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
    return pa.RecordBatch.from_arrays(
        [pa.array(uid, pa.binary()), ids.take(pa.array(owner)), pa.array((begin - ptr[owner]).astype(np.int64)),
         lists(np.concatenate(([0], np.cumsum(size))), h[inside].view(np.int64)),
         lists(cut, (at - begin[which]).astype(np.int32)), lists(cut, hashes.view(np.int64))],
        names=["uid", "id", "start", "words", "at", "hash"])


def _compare(window: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, items, keep, rows = batch.column(0), batch.column(1), [], []
            starts, shifts = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            for i in range(batch.num_rows):
                text, item = (np.asarray(batch.column(c)[i].values) for c in (4, 5))
                shift = int(shifts[i])
                lo, hi = max(0, -shift), min(len(item), len(text) - shift)
                if hi <= lo:
                    continue
                same = np.zeros(len(item), dtype=np.int64)
                same[lo:hi] = item[lo:hi] == text[lo + shift:hi + shift]
                width = min(window, len(item))
                least = _least(width, share)
                total = np.concatenate(([0], np.cumsum(same)))
                good = np.flatnonzero(total[width:] - total[:-width] >= least)
                if not len(good):
                    continue
                covered = np.zeros(len(item) + 1, dtype=np.int64)
                np.add.at(covered, good, 1)
                np.add.at(covered, good + width, -1)
                covered = np.cumsum(covered[:-1]) > 0
                agreed = np.flatnonzero(covered & (same > 0))
                keep.append(i)
                rows.append((int(agreed[0]), int(agreed[-1]) + 1, int(starts[i]) + shift + int(agreed[0]),
                             len(agreed), len(item)))
            if keep:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(keep)), items.take(pa.array(keep)), *[pa.array(c, pa.int64()) for c in cols]],
                    names=["id", "item", "item_start", "item_end", "text_start", "matched", "item_words"])
    return run


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(id, item, matched, item_words, overlap, text_start, text_end,
    item_start, item_end): positions in words, ends exclusive."""
    spark = docs.sparkSession
    folder = fresh_dir(spark, "decontam")
    id_kind, item_kind = dict(docs.select(id_col).dtypes)[id_col], dict(bench.select(item_col).dtypes)[item_col]
    _items(bench, item_col, item_text_col).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    short = sorted(r["n"] for r in items.where(F.col("n") < window).select("n").distinct().collect())
    around = items.agg(F.max("n")).first()[0] or 0
    masks = _masks(short, window, share)
    _item_seeds(items, masks).write.parquet(f"{folder}/seeds")
    seeds = spark.read.parquet(f"{folder}/seeds")
    bitmap, bits = _bitmap(seeds, seeds.count())
    shared = spark.sparkContext.broadcast(bitmap)  # 2**FILTER_BITS[1] bits at most

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, ptr = words(batch.column(1))
                found = _passages(batch.column(0), h, ptr, masks, shared.value, bits, around)
                if found is not None:
                    yield found

    (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
     .mapInArrow(look, f"uid binary, id {id_kind}, start long, words array<long>, at array<int>, hash array<long>")
     .write.parquet(f"{folder}/passages"))  # fixes the random uids
    passages = spark.read.parquet(f"{folder}/passages")
    hits = (passages.select("uid", F.explode(F.arrays_zip(F.col("at").alias("hit"), F.col("hash").alias("hash"))).alias("s"))
            .select("uid", F.col("s.hit").alias("hit"), F.col("s.hash").alias("hash")))
    candidates = (hits.join(seeds, "hash").select("uid", "key", (F.col("hit") - F.col("at")).alias("shift")).distinct())
    pairs = (candidates.join(passages.select("uid", "id", "start", "words"), "uid")
             .join(items.select("key", "item", F.col("words").alias("item_words")), "key")
             .select("id", "item", "start", "shift", "words", "item_words"))
    found = pairs.mapInArrow(_compare(window, share), f"id {id_kind}, item {item_kind}, item_start long, item_end long, "
                                                      "text_start long, matched long, item_words long")
    best = F.max(F.struct("matched", (-F.col("text_start")).alias("place"), (-F.col("item_start")).alias("begin"),
                          "item_end", "item_words")).alias("b")
    return (found.groupBy("id", "item").agg(best)
            .select("id", "item", F.col("b.matched").alias("matched"), F.col("b.item_words").alias("item_words"),
                    (F.col("b.matched") / F.col("b.item_words")).alias("overlap"),
                    (-F.col("b.place")).alias("text_start"),
                    (-F.col("b.place") + F.col("b.item_end") + F.col("b.begin")).alias("text_end"),
                    (-F.col("b.begin")).alias("item_start"), F.col("b.item_end").alias("item_end")))


def without_leaks(docs: DataFrame, bench: DataFrame, text_col: str, item_col: str = "item_id",
                  item_text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no leak, with all their columns."""
    key = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256))
    own = "key"
    while own in docs.columns:  # a name of no column
        own += "_"
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    leaked = (find_leaks(texts, bench, "key", "text", item_col, item_text_col, **options)
              .select(F.col("id").alias(f"{own}_leaked")).distinct())
    return join_on_key(docs.withColumn(own, key), leaked, [own], [f"{own}_leaked"], "left_anti").drop(own)
