"""N-gram Jaccard self-join by chosen paths.

A document is its set of shingles of ``k`` words; documents link when the
Jaccard similarity of their sets is at least ``threshold``.  Documents with
equal sets form one class, and classes are joined by chosen-path search: in
every run a set follows the shingles whose hash under the run is below
1 / (threshold * size), so similar sets follow a common shingle with a
probability of at least 1 - 1/e.  Sets that followed the same path share a
bucket; a bucket larger than ``recurse_at`` is split by further sampled
shingles, to ``depth`` levels.  Small buckets are compared pair by pair,
larger ones that cannot be split (copies) in blocks.  Runs are repeated until
a pair at the threshold itself is met with probability ``recall`` (the
buckets' depth raises the number of runs for the sets concerned); pairs above
the threshold are met more often.  Every link reported is exact: its
similarity is computed from the shingle sets.

Pairs are never listed.  A pair that meets in several buckets is counted in
the one with the smallest key, so buckets return per member its number of
links and one link to the smallest member of its local component; components
are then joined by alternating large-star and small-star steps.

Scale: texts are read once for the sets' digests, sampled paths and sketches
(128 bytes), and again only for sets that have a plausible partner: a bitmap
of bounded size keeps all other texts from leaving their task.  Sketches
decide plausibility (five standard deviations below the threshold).  Hot
classes are one row; hot buckets are cut into blocks and block pairs of at
most 2 * ``block`` members, spread over tasks.

Defined results: texts without words have the empty set and form one class;
texts of fewer than ``k`` words have one shingle, all their words.  Repeated
rows are documents of their own.  ``class_id`` is the smallest id of the
component, null ids last.  An empty table gives no rows; extra columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.text import SHINGLE_BITS, U, mix, row_of, seed, shingle_sets, slices
from feedloom.operators.fetch import join_on_key
from feedloom.session import fresh_dir

BINS = 128
RECALL = 0.9999
DEPTH = 3
RECURSE_AT = 4096
BLOCK = 256
FILTER_BITS = (20, 27)  # log2 of the text bitmap's least and largest number of bits


def runs_needed(depth: int, recall: float) -> int:
    """Runs after which two sets at the threshold share a bucket of this depth
    with probability ``recall``: each run is a branching process whose mean is
    at least one common shingle per step."""
    survives = 1.0
    for _ in range(depth):
        survives = 1 - math.exp(-survives)
    return math.ceil(math.log(1 - recall) / math.log(1 - survives))


# --- sets of a batch ------------------------------------------------------------------


def _digests(s: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """16 bytes that name each row's set."""
    out = np.zeros((len(ptr) - 1, 2), dtype=U)
    some = np.flatnonzero(np.diff(ptr))
    with np.errstate(over="ignore"):
        for half in range(2):
            if len(some):
                out[some, half] = np.add.reduceat(mix(s ^ seed(50 + half)), ptr[:-1][some])
            out[:, half] = mix(out[:, half] + np.diff(ptr).astype(U) * seed(60 + half))
    return [r.tobytes() for r in out]


def _sketches(s: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """One-permutation sketch: a byte of the least shingle of each bin, 0 if empty."""
    out = np.zeros((len(ptr) - 1, BINS), dtype=np.uint8)
    if len(s):
        row, bin_ = row_of(ptr), (s >> U(SHINGLE_BITS - BINS.bit_length() + 1)).astype(np.int64)
        first = np.ones(len(s), dtype=bool)
        first[1:] = (row[1:] != row[:-1]) | (bin_[1:] != bin_[:-1])
        at = np.flatnonzero(first)
        out[row[at], bin_[at]] = (s[at] % U(255)).astype(np.uint8) + 1
    return out


def _chances(ptr: np.ndarray, threshold: float) -> np.ndarray:
    """Per row, the hash below which a shingle is followed."""
    size = np.maximum(np.diff(ptr), 1)
    share = np.minimum(1 / (threshold * size), 1.0)
    return np.where(share >= 1, U(0xFFFFFFFFFFFFFFFF), (share * 2.0 ** 64 * (1 - 2.0 ** -53)).astype(U))


def _followed(s: np.ndarray, below: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Places of the shingles followed under a salt."""
    x = s * (salt | U(1))
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    return np.flatnonzero(x <= below)


def _root(run: int) -> np.uint64:
    return seed(100 + run)


def _child(path: np.uint64, shingles: np.ndarray) -> np.ndarray:
    return mix((shingles ^ path) * U(0x9E3779B97F4A7C15))


def _paths(s: np.ndarray, below: np.ndarray, starts: list[np.uint64], depth: int) -> list[np.uint64]:
    """Buckets ``depth`` steps beyond the given paths, for one set."""
    now = starts
    for _ in range(depth):
        now = [c for p in now for c in _child(p, s[_followed(s, below, mix(np.array([p]))[0])])]
    return now


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float, runs: int) -> DataFrame:
    """(id, th, key, size, buckets, sketch) of every document."""
    kind = dict(docs.select(id_col).dtypes)[id_col]
    salts = [_root(r) for r in range(runs)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                s, ptr = shingle_sets(batch.column(2), k)
                row, buckets, owner = row_of(ptr), [np.zeros(0, U)], [np.zeros(0, np.int64)]
                with np.errstate(over="ignore"):
                    below = _chances(ptr, threshold)[row]
                    for root in salts:
                        at = _followed(s, below, mix(np.array([root]))[0])
                        buckets.append(_child(root, s[at]))
                        owner.append(row[at])
                owner, buckets = np.concatenate(owner), np.concatenate(buckets)
                order = np.argsort(owner, kind="stable")
                ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))))
                sketch = _sketches(s, ptr)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(_digests(s, ptr), pa.binary()),
                     pa.array(np.diff(ptr), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(buckets[order].view(np.int64))),
                     pa.array([r.tobytes() for r in sketch], pa.binary())],
                    names=["id", "th", "key", "size", "buckets", "sketch"])

    return (_texts(docs, text_col, F.col(id_col).alias("id"))
            .mapInArrow(read, f"id {kind}, th long, key binary, size long, buckets array<long>, sketch binary"))


def _texts(docs: DataFrame, text_col: str, *cols: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(*cols, F.xxhash64(text).alias("th"), text.alias("text"))


# --- fetching the sets of some classes -----------------------------------------------------


def _fetch(docs: DataFrame, text_col: str, wanted: DataFrame, k: int) -> DataFrame:
    """(key, shingles) of the classes in ``wanted`` (key, th)."""
    low, high = FILTER_BITS
    bits = min(high, max(low, math.ceil(math.log2(16 * max(1, wanted.count())))))
    place = F.shiftrightunsigned("th", 64 - bits)
    held = (wanted.groupBy(F.shiftright(place, 6).alias("place"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(th, {}) & 63 as int))".format(64 - bits)))
                 .alias("word")).toArrow())  # at most 2**(bits - 6) rows
    bitmap = np.zeros(1 << (bits - 6), dtype=U)
    bitmap[np.asarray(held.column("place"))] = np.asarray(held.column("word")).view(U)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies leave a task once
        for whole in batches:
            th = np.asarray(whole.column(0)).view(U)
            at = th >> U(64 - bits)
            keep = []
            for i in np.flatnonzero((shared.value[at >> U(6)] >> (at & U(63))) & U(1)).tolist():
                if int(th[i]) not in seen:
                    seen.add(int(th[i]))
                    keep.append(i)
            if not keep:
                continue
            for batch in slices(whole.take(pa.array(keep)), "text"):
                s, ptr = shingle_sets(batch.column(1), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(s, ptr), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(s.view(np.int64)))],
                    names=["key", "shingles"])

    found = _texts(docs, text_col).mapInArrow(read, "key binary, shingles array<long>")
    return (found.join(wanted.select("key"), "key", "left_semi")
            .groupBy("key").agg(F.first("shingles").alias("shingles")))


# --- buckets ---------------------------------------------------------------------------------


def _split(members: DataFrame, sets: DataFrame, threshold: float, depth: int, more: range) -> DataFrame:
    """(bucket, key) one step below the members' buckets, and ``more`` whole
    runs of ``depth`` steps for every set concerned."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = [], []
            for i in range(batch.num_rows):
                s = np.asarray(batch.column(2)[i].values).view(U)
                with np.errstate(over="ignore"):
                    below = _chances(np.array([0, len(s)]), threshold)[0]
                    starts = list(np.asarray(batch.column(1)[i].values).view(U))
                    found = _paths(s, below, starts, 1) + _paths(s, below, [_root(r) for r in more], depth)
                keys += [batch.column(0)[i].as_py()] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, dtype=U).view(np.int64)), pa.array(keys, pa.binary())],
                                             names=["bucket", "key"])

    grouped = members.groupBy("key").agg(F.collect_set("bucket").alias("starts"))  # a set's own paths, a few
    return (grouped.join(sets, "key").select("key", "starts", "shingles")
            .mapInArrow(read, "bucket long, key binary").distinct())


def _buckets(spark: SparkSession, folder: str, classes: DataFrame, fetch, threshold: float, recall: float,
             depth: int, recurse_at: int) -> DataFrame:
    """(bucket, n, key): members of all final buckets of two or more."""
    nodes = classes.select(F.explode(F.array_distinct("buckets")).alias("bucket"), "key")
    done = []
    for level in range(1, depth + 1):
        sizes = (nodes.groupBy(F.col("bucket").alias("counted")).agg(F.count("*").alias("n")).where("n > 1"))
        (join_on_key(nodes, sizes, ["bucket"], ["counted"], "inner").select("bucket", "n", "key")
         .write.parquet(f"{folder}/level{level}"))
        shared = spark.read.parquet(f"{folder}/level{level}")
        if level == depth:
            done.append(shared)
            break
        done.append(shared.where(F.col("n") <= recurse_at))
        large = shared.where(F.col("n") > recurse_at).select("bucket", "key")
        if large.isEmpty():
            break
        wanted = large.select("key").distinct().join(classes.select("key", "th"), "key")
        more = range(runs_needed(level, recall), runs_needed(level + 1, recall))
        _split(large, fetch(wanted), threshold, level + 1, more).write.parquet(f"{folder}/split{level}")
        nodes = spark.read.parquet(f"{folder}/split{level}")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _blocks(buckets: DataFrame, block: int) -> DataFrame:
    """Members with their block; a bucket of b blocks is compared as its
    b (b + 1) / 2 pairs of blocks (i, j), each a group of rows."""
    count = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("key", "bucket"), count.cast("long")).cast("int")
    return (buckets.select("bucket", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), count - 1)).alias("x"))
            .select("bucket", F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"), "own", "key"))


def _groups(batches: Iterator[pa.RecordBatch], most: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups (columns 0-2 equal) from sorted batches."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, most))
            rows += held[-1].num_rows
            batch = batch.slice(most)
            if rows < most:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            new = _group_starts(t)
            if len(new) > 1:  # the last group may go on
                yield t.slice(0, int(new[-1]))
                t = t.slice(int(new[-1]))
            held, rows = t.to_batches(), t.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_starts(t: pa.Table) -> np.ndarray:
    change = np.zeros(t.num_rows, dtype=bool)
    change[0] = True
    for c in range(3):
        x = np.asarray(t.column(c))
        change[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def _padded(lists, fill: int = 0) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.full((len(size), int(size.max(initial=1))), fill, dtype=np.int64)
    flat = np.asarray(lists.flatten())
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _meet_first(buckets: list[np.ndarray], here: int) -> np.ndarray:
    """n x n: pairs that share no bucket with a smaller key than ``here``."""
    flat = np.concatenate(buckets)
    row = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    row, flat = row[flat < here], flat[flat < here]
    seen, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[col] > 1
    if not keep.any():
        return np.ones((len(buckets), len(buckets)), dtype=bool)
    cols = np.cumsum(count > 1) - 1
    m = np.zeros((len(buckets), int((count > 1).sum())), dtype=np.float32)
    m[row[keep], cols[col[keep]]] = 1
    return m @ m.T == 0


def _allowed(own: np.ndarray, size: np.ndarray, threshold: float, within: bool) -> np.ndarray:
    """n x n: pairs to compare here, by block and by size."""
    ok = np.ones((len(own), len(own)), dtype=bool) if within else own[:, None] != own[None, :]
    np.fill_diagonal(ok, False)
    big, small = np.maximum(size[:, None], size[None, :]), np.minimum(size[:, None], size[None, :])
    return ok & (small >= threshold * big * (1 - 1e-12))


def _alike(sketch: np.ndarray, threshold: float) -> np.ndarray:
    """n x n: pairs whose sketches don't rule the threshold out."""
    n = len(sketch)
    full = (sketch > 0).astype(np.float32)
    both = full @ full.T
    either = full.sum(1)[:, None] + full.sum(1)[None, :] - both
    same = np.zeros((n, n), dtype=np.int16)
    for b in range(sketch.shape[1]):
        x = sketch[:, b]
        same += (x[:, None] == x[None, :]) & (x[:, None] > 0)
    return same >= threshold * either - 5 * np.sqrt(threshold * (1 - threshold) * either)


def _plausible(threshold: float):
    """Per group, the members with a plausible partner that is first met here."""
    least = lambda m: threshold * m - 5 * np.sqrt(threshold * (1 - threshold) * m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            begin = np.append(_group_starts(t), t.num_rows)
            bucket, own, size = (np.asarray(t.column(c)) for c in ("bucket", "own", "size"))
            within = np.asarray(t.column("i")) == np.asarray(t.column("j"))
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, BINS)
            lists = t.column("buckets").combine_chunks()
            keep = np.zeros(t.num_rows, dtype=bool)
            n = np.diff(begin)
            # Groups of one size at a time, all their pairs at once.
            for width in np.unique(n[(n > 1) & (n <= 32)]).tolist():
                a, b = np.triu_indices(width, 1)
                starts = begin[:-1][n == width]
                step = max(1, (1 << 16) // len(a))
                for lo in range(0, len(starts), step):
                    x = (starts[lo:lo + step, None] + a).ravel()
                    y = (starts[lo:lo + step, None] + b).ravel()
                    ok = np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]) * (1 - 1e-12)
                    ok &= within[x] | (own[x] != own[y])
                    x, y = x[ok], y[ok]
                    p, q = sketch[x], sketch[y]
                    ok = ((p == q) & (p > 0)).sum(1) >= least(((p > 0) | (q > 0)).sum(1))
                    x, y = x[ok], y[ok]
                    for i, j in zip(x.tolist(), y.tolist()):
                        if not (keep[i] and keep[j]):
                            common = np.intersect1d(np.asarray(lists[i].values), np.asarray(lists[j].values))
                            if len(common) and common[0] == bucket[i]:
                                keep[i] = keep[j] = True
            for lo, hi in zip(begin[:-1][n > 32].tolist(), begin[1:][n > 32].tolist()):
                ok = _allowed(own[lo:hi], size[lo:hi], threshold, bool(within[lo]))
                if ok.any():
                    ok &= _alike(sketch[lo:hi], threshold)
                    if ok.any():
                        ok &= _meet_first([np.asarray(lists[r].values) for r in range(lo, hi)], int(bucket[lo]))
                        keep[lo:hi] = ok.any(1)
            if keep.any():
                for b in t.select(["bucket", "i", "j", "own", "key"]).filter(pa.array(keep)).to_batches():
                    yield b
    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """n x n sizes of the intersections."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.float64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    col = np.cumsum(new) - 1
    shared = np.bincount(col)[col] > 1
    row, col = row[shared], col[shared]
    if not len(col):
        return out
    col = np.cumsum(np.concatenate(([0], (np.diff(col) != 0).astype(np.int64))))
    width = max(64, (1 << 21) // n)  # columns at a time
    for lo in range(0, int(col[-1]) + 1, width):
        a, b = np.searchsorted(col, (lo, lo + width))
        m = np.zeros((n, width), dtype=np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        out += m @ m.T
    return out


def _links(threshold: float):
    """Per group and member: links first met here, and a smaller linked key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 512):
            begin = np.append(_group_starts(t), t.num_rows).tolist()
            keys, docs = t.column("key").to_pylist(), np.asarray(t.column("n_docs"))
            own, bucket = np.asarray(t.column("own")), np.asarray(t.column("bucket"))
            within = np.asarray(t.column("i")) == np.asarray(t.column("j"))
            lists, sets = t.column("buckets").combine_chunks(), t.column("shingles").combine_chunks()
            out = []
            for lo, hi in zip(begin[:-1], begin[1:]):
                if hi - lo < 2:
                    continue
                mine = [np.asarray(sets[r].values) for r in range(lo, hi)]
                size = np.array([len(s) for s in mine], dtype=np.float64)
                ok = _allowed(own[lo:hi], size, threshold, bool(within[lo]))
                both = _overlaps(mine)
                ok &= both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                if not ok.any():
                    continue
                met = ok & _meet_first([np.asarray(lists[r].values) for r in range(lo, hi)], int(bucket[lo]))
                sets_linked, docs_linked = met.sum(1), met @ docs[lo:hi]
                # Local components by repeated minimum over linked members.
                rank = np.empty(hi - lo, dtype=np.int64)
                rank[sorted(range(hi - lo), key=lambda r: keys[lo + r])] = np.arange(hi - lo)
                label = rank.copy()
                while True:
                    new = np.minimum(label, np.where(ok, label[None, :], hi - lo).min(1))
                    if (new == label).all():
                        break
                    label = new
                name = dict(zip(rank.tolist(), keys[lo:hi]))
                out += [(keys[lo + r], name[int(label[r])], int(sets_linked[r]), int(docs_linked[r]))
                        for r in np.flatnonzero(ok.any(1)).tolist()]
            if out:
                a, b, c, d = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                                                  pa.array(c, pa.int64()), pa.array(d, pa.int64())],
                                                 names=["key", "least", "sets", "docs"])
    return run


# --- components -----------------------------------------------------------------------------------


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(v, least): the smallest vertex of each vertex's component, from (u, v) edges."""
    spark = edges.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    now = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "e0")
    for step in range(1, 200):
        if now.isEmpty():
            break
        # Large star: every neighbour above u links to the least of u's neighbourhood.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # Small star: u and its smaller neighbours link to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = kept(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"e{step}")
        if new.count() == now.count() and new.exceptAll(now).isEmpty():
            now = new
            break
        now = new
    return now.select(F.col("u").alias("v"), F.col("v").alias("least"))


# --- the join -------------------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, k: int = 5, threshold: float = 0.8,
                    recall: float = RECALL, depth: int = DEPTH, recurse_at: int = RECURSE_AT,
                    block: int = BLOCK) -> DataFrame:
    """(id, class_id, n_links, n_set_links) per document: its component, the
    other documents and the other distinct sets it links to."""
    spark, folder = docs.sparkSession, fresh_dir(docs.sparkSession, "jaccard")
    _sets(docs, id_col, text_col, k, threshold, runs_needed(1, recall)).write.parquet(f"{folder}/sets")
    rows = spark.read.parquet(f"{folder}/sets")
    (rows.groupBy("key").agg(F.min("id").alias("least_id"), F.count("*").alias("n_docs"), F.min("th").alias("th"),
                             F.first("size").alias("size"), F.first("buckets").alias("buckets"),
                             F.first("sketch").alias("sketch")).write.parquet(f"{folder}/classes"))
    classes = spark.read.parquet(f"{folder}/classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        return _fetch(docs, text_col, wanted, k)

    buckets = _buckets(spark, folder, classes, fetch, threshold, recall, depth, recurse_at)
    own = buckets.groupBy("key").agg(F.collect_set("bucket").alias("buckets"))  # a set's own paths, a few dozen
    own.join(classes.select("key", "size", "n_docs", "sketch", "th"), "key").write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    grid = _blocks(buckets, block)
    group = ["bucket", "i", "j"]
    looked = (grid.join(members.select("key", "size", "sketch", "buckets"), "key")
              .select(*group, "own", "key", "size", "sketch", "buckets").repartition(*group).sortWithinPartitions(*group)
              .mapInArrow(_plausible(threshold), "bucket long, i int, j int, own int, key binary"))
    looked.write.parquet(f"{folder}/plausible")
    likely = spark.read.parquet(f"{folder}/plausible")
    sets = fetch(likely.select("key").distinct().join(members.select("key", "th"), "key"))
    linked = (likely.join(members.select("key", "n_docs", "buckets").join(sets, "key"), "key")
              .select(*group, "own", "key", "n_docs", "buckets", "shingles")
              .repartition(*group).sortWithinPartitions(*group)
              .mapInArrow(_links(threshold), "key binary, least binary, sets long, docs long"))
    linked.write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    least = components(links.select(F.col("key").alias("u"), F.col("least").alias("v")), f"{folder}/components")
    counts = links.groupBy("key").agg(F.sum("sets").alias("sets"), F.sum("docs").alias("docs"))
    of = (classes.select("key", "least_id", "n_docs").join(counts, "key", "left")
          .join(least.withColumnRenamed("v", "key"), "key", "left")
          .withColumn("least", F.coalesce("least", "key")))
    names = of.groupBy("least").agg(F.min("least_id").alias("class_id"))
    facts = (of.join(names, "least")
             .select("key", "class_id", (F.col("n_docs") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
                     F.coalesce("sets", F.lit(0)).alias("n_set_links")))
    return rows.select("id", "key").join(facts, "key").select("id", "class_id", "n_links", "n_set_links")


def keep_one(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """One row of each class of near-duplicates, with all its columns: of the
    text with the least digest, the row with the smallest id (nulls last)."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256))
    texts = docs.select(digest.alias("digest"), F.col(text_col).alias("text"))
    chosen = near_duplicates(texts, "digest", "text", **options).select(F.col("class_id").alias("__digest")).distinct()
    row = F.struct(*[F.col(c) for c in docs.columns])
    order = F.struct(F.col(id_col).isNull(), F.col(id_col))
    each = docs.groupBy(digest.alias("__digest")).agg(F.min_by(row, order).alias("__row"))
    return each.join(chosen, "__digest", "left_semi").select("__row.*")
