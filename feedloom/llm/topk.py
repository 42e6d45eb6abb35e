"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors become integers floor(scale * x).  Rows are dealt into blocks by a
hash of their id; a block's index keeps, for every dimension, its postings by
descending |component|; postings of equal quantised size are one segment.
For a query the segments of all dimensions are processed in rounds of falling
impact |q_d| * level: each adds its quantised product to its rows'
accumulators.  What is still open - the largest unread level of each
dimension, and what quantisation cut off - bounds every score on both sides;
rows whose upper bound is below the k-th largest lower bound are proven out.
Processing stops when few enough rows are possible; these are scored exactly.

Scale: a grid, not a cross join: each query goes once to each block, as one
row, and a task holds one block and one batch of queries.  A block returns at
most k rows for a query; Spark ranks these with a partial top-k before its
shuffle.  Blocks are filled by a hash, so a common vector spreads over all.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without id; vectors with an integer component beyond
2**26 are scored in integers of any length beside the index, and a score
beyond the ends of a long is that end; vectors of unequal length are compared as if
padded with zeros; equal scores rank the smaller id first; repeated ids are
each a candidate (never for the query of that id), and of query rows with one
id the one with the smallest vector asks; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
LEVEL_BITS = 8  # a block's impacts are quantised to so many bits
ROUND = 3  # each round goes down to this part of the last round's impact
LARGEST = 1 << 26  # vectors within it are summed in 64 bits, others in Python's integers
FIRST, LAST = -(1 << 63), (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, v) of the rows that take part; v holds whole numbers as doubles,
    which are exact at every size."""
    v = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * scale)
    real = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))  # NaN and null fail
    # Beyond 2**53 a double is whole; floor would not fit a long.
    whole = F.transform(v, lambda x: F.when(F.abs(x) >= float(1 << 53), x).otherwise(F.floor(x).cast("double")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & real)
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v")))


def _rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(components, row of each, place of each in its row) of a list column."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = np.asarray(lists.value_lengths()).astype(np.int64)
    flat = np.asarray(lists.flatten()).astype(np.float64)
    row = np.repeat(np.arange(len(lists)), size)
    return flat, row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)


def _matrix(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as int64, padded with zeros or cut at ``width``, and
    which rows are wide: these are all zero."""
    flat, row, col = _rows(lists)
    wide = np.zeros(len(lists), dtype=bool)
    wide[row[np.abs(flat) > LARGEST]] = True
    out = np.zeros((len(lists), width), dtype=np.int64)
    inside = (col < width) & ~wide[row]  # a longer vector's further components meet zeros
    out[row[inside], col[inside]] = flat[inside].astype(np.int64)
    return out, wide


def _long(score: int) -> int:
    return min(max(score, FIRST), LAST)


def _product(a: list[int], b: list[int]) -> int:
    return _long(sum(x * y for x, y in zip(a, b)))


class Index:
    """The impact-ordered index of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        size = np.abs(self.vectors)
        self.shift = max(0, int(size.max(initial=0)).bit_length() - LEVEL_BITS)
        # Postings of each dimension by descending |component|; equal levels are one segment.
        self.order = np.ascontiguousarray(np.argsort(-size, axis=0, kind="stable").T)
        ranked = np.take_along_axis(self.vectors.T, self.order, axis=1)
        self.level = np.abs(ranked) >> self.shift
        self.impact = np.sign(ranked) * (self.level << self.shift)
        self.falling = -self.level

    def possible(self, q: np.ndarray, k: int, enough: int) -> np.ndarray:
        """Rows that may be among the k best; every other is proven out."""
        n = len(self.ids)
        if n <= enough:
            return np.arange(n)
        dims = [d for d in np.argsort(-np.abs(q), kind="stable").tolist() if q[d]]
        w = np.abs(q[dims])
        unit, cut_off = 1 << self.shift, (1 << self.shift) - 1
        read = np.zeros(len(dims), dtype=np.int64)  # postings of each dimension processed
        got, alive = np.zeros(n, dtype=np.int64), np.arange(n)
        least = int((w * (self.level[dims, 0] << self.shift)).max(initial=0))
        while len(alive) > enough and least:
            least = least // ROUND if least > 64 else 0  # the segments of impact >= least come next
            open_ = 0
            for j, d in enumerate(dims):
                # Smallest level whose impact w * level * unit reaches ``least``.
                floor = -(-least // int(w[j] * unit)) if least else 0
                end = int(np.searchsorted(self.falling[d], -floor, side="right"))
                if end > read[j]:
                    at = slice(read[j], end)
                    got[self.order[d, at]] += self.impact[d, at] * q[d]
                    read[j] = end
                ahead = int(self.level[d, end]) * unit + cut_off if end < n else 0
                open_ += int(w[j]) * max(ahead, cut_off)
            # Scores lie within got +- open_.
            if len(alive) > k:
                kth = np.partition(got[alive], len(alive) - k)[len(alive) - k]
                alive = alive[got[alive] + 2 * open_ >= kth]
        return alive

    def best(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than the query's own."""
        if not len(self.ids):
            return self.ids, np.zeros(0, dtype=np.int64)
        own = int(np.searchsorted(self.ids, query_id, "right") - np.searchsorted(self.ids, query_id, "left"))
        rows = self.possible(q, k + own, max(4 * (k + own), len(self.ids) // 64))
        rows = rows[self.ids[rows] != query_id]
        score = self.vectors[rows] @ q
        if len(rows) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            keep = score >= kth
            rows, score = rows[keep], score[keep]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]


class Block:
    """A block's index, and beside it the rows whose sums may not fit 64 bits."""

    def __init__(self, ids: np.ndarray, lists: pa.Array):
        flat, row, col = _rows(lists)
        v, wide = _matrix(lists, int(col.max(initial=-1)) + 1)
        self.index = Index(ids[~wide], v[~wide])
        self.wide = [(int(ids[r]), [int(x) for x in flat[row == r]]) for r in np.flatnonzero(wide).tolist()]

    def best(self, query_ids: np.ndarray, lists: pa.Array, k: int):
        """(ids, scores) of each query's k best rows."""
        flat, row, _ = _rows(lists)
        q, wide = _matrix(lists, self.index.vectors.shape[1])
        for i, query_id in enumerate(query_ids.tolist()):
            if not wide[i] and not self.wide:
                yield self.index.best(query_id, q[i], k)
                continue
            asked = [int(x) for x in flat[row == i]]
            if wide[i]:
                found = [(_product(asked, v), c) for c, v in zip(self.index.ids.tolist(), self.index.vectors.tolist()) if c != query_id]
            else:
                found = [(s, c) for c, s in zip(*(a.tolist() for a in self.index.best(query_id, q[i], k)))]
            found += [(_product(asked, v), c) for c, v in self.wide if c != query_id]
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
            yield np.array([c for _, c in found], dtype=np.int64), np.array([s for s, _ in found], dtype=np.int64)


def search(df: DataFrame, id_col: str, vector_col: str, is_query: Column, k: int = 10, scale: int = 1024,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of every query row."""
    rows = integer_vectors(df, id_col, vector_col, scale)
    queries = (integer_vectors(df.where(is_query), id_col, vector_col, scale)
               .groupBy("id").agg(F.min("v").alias("v")))
    blocks = max(1, -(-rows.count() // block_rows))
    # The row's number deals repeated rows over the blocks.
    place = F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(blocks))
    dealt = rows.select(place.alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                           F.lit(1).alias("kind"), "id", "v")
    # A block's vectors come first, its queries after them, in batches.
    grid = dealt.unionByName(asked).repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "kind", "id")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, index, ids, lists = None, None, [], []
        for batch in batches:
            key, kind = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(key)]):
                if hi == lo:
                    continue
                if key[lo] != now:
                    now, index, ids, lists = key[lo], None, [], []
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    ids.append(np.asarray(part.column(2)))
                    lists.append(part.column(3))
                    continue
                if index is None and ids:
                    index = Block(np.concatenate(ids), pa.chunked_array(lists))
                    ids, lists = [], []
                if index is None:
                    continue
                found = list(index.best(np.asarray(part.column(2)), part.column(3), k))
                size = [len(a) for a, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.asarray(part.column(2)), size)),
                     pa.array(np.concatenate([a for a, _ in found])), pa.array(np.concatenate([b for _, b in found]))],
                    names=["query_id", "vec_id", "score"])

    found = grid.mapInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
