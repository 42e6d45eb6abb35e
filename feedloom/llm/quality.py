"""Quality scores by a factorisation machine.

A text is a sparse vector of hashed words (term frequencies of length 1),
structure statistics and metadata (both cut into bins at the quantiles of the
training rows).  The model is y = w0 + <w, x> + sum of <v_i, v_j> x_i x_j over
pairs i < j; the pair term is computed in linear time, per factor, as half of
(sum of v x) squared less the sum of (v x) squared.  The score is the
logistic of y.

Scale: the model has a fixed size (``2**WORD_BITS`` buckets and the bins) and
is broadcast; scoring is one pass over the table that moves no rows.  It is
fitted on at most ``max_rows`` labelled rows with at most ``max_nonzeros``
feature values, taken in the order of a hash of their id: two documented
bounds, so the driver's part doesn't grow with the corpus.

Defined results: null and empty texts are scored (they have no words, zero
statistics); a null number in the metadata counts as 0; rows with a null id
are scored and never used for training; repeated rows are scored alike; of
conflicting labels of one id the smallest holds; rows whose label is null or
neither 0 nor 1 are no labels; with no rows of one of the labels the model is
the constant log-odds of smoothed counts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.text import row_of, slices, text_buffers, words

WORD_BITS = 16
BINS = 12
RANK = 8
STAT_VALUE = 1.0  # value of the input that marks a statistic's bin

# Byte classes whose shares are structure statistics.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"?.,;:", b"#$%&*@", b"|<>{}[]()=", b"\n", b" \t")
STATS = len(_CLASSES) + 9


def _sums(flags: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (total[ptr[1:]] - total[ptr[:-1]]).astype(np.float64)


def _line_repeats(data: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Share of lines that stand earlier in the same text."""
    out = np.zeros(len(ptr) - 1)
    raw = data.tobytes()
    for i in np.flatnonzero(_sums(data == 10, ptr) > 0):
        lines = [x for x in raw[ptr[i]:ptr[i + 1]].split(b"\n") if x]
        out[i] = 1 - len(set(lines)) / len(lines) if lines else 0.0
    return out


def features(text: pa.Array, extra: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, values, row pointers, dense statistics) of some rows."""
    h, ptr = words(text)
    rows = len(ptr) - 1
    key = (row_of(ptr).astype(np.uint64) << np.uint64(WORD_BITS)) | (h & np.uint64((1 << WORD_BITS) - 1))
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(key)]))).astype(np.float32)
    owner = (key[first] >> np.uint64(WORD_BITS)).astype(np.int64)
    bucket = (key[first] & np.uint64((1 << WORD_BITS) - 1)).astype(np.int32)
    distinct = np.bincount(owner, minlength=rows)
    square = np.bincount(owner, weights=counts.astype(np.float64) ** 2, minlength=rows)
    value = (counts / np.sqrt(np.maximum(square, 1))[owner]).astype(np.float32)
    out_ptr = np.concatenate(([0], np.cumsum(distinct))).astype(np.int64)

    again = np.zeros(len(h), dtype=bool)
    again[1:] = h[1:] == h[:-1]
    again[ptr[:-1][np.diff(ptr) > 0]] = False

    data, offsets = text_buffers(text)
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    n_words = np.diff(ptr).astype(np.float64)
    some = np.maximum(n_words, 1)
    most = np.zeros(rows)
    np.maximum.at(most, owner, counts)
    stats = []
    for group in _CLASSES:
        member = np.zeros(256, dtype=bool)
        member[list(group)] = True
        stats.append(_sums(member[data], offsets) / size)
    stats += [_sums(data >= 0x80, offsets) / size, np.log1p(np.diff(offsets)), np.log1p(n_words),
              size / some, distinct / some, most / some, np.sqrt(square) / some, _sums(again, ptr) / some,
              _line_repeats(data, offsets)]
    return bucket, value, out_ptr, np.column_stack(stats + extra) if rows else np.zeros((0, STATS + len(extra)))


@dataclass
class Model:
    """A fitted machine: weights of word buckets, then of the statistics' bins."""
    bias: float
    linear: np.ndarray   # (inputs,)
    factors: np.ndarray  # (inputs, RANK)
    cuts: np.ndarray     # (statistics, BINS - 1)

    def inputs(self, bucket, value, ptr, stats):
        """Word buckets and statistic bins of each row as one sparse matrix."""
        rows, n_stats = stats.shape
        bins = np.empty((rows, n_stats), dtype=np.int32)
        for s in range(n_stats):
            bins[:, s] = (1 << WORD_BITS) + s * BINS + np.searchsorted(self.cuts[s], stats[:, s], side="right")
        count = np.diff(ptr)
        index = np.empty(len(bucket) + bins.size, dtype=np.int32)
        x = np.empty(len(index), dtype=np.float32)
        out = np.concatenate(([0], np.cumsum(count + n_stats))).astype(np.int64)
        at = np.arange(len(bucket)) + np.repeat(np.arange(rows) * n_stats, count)
        index[at], x[at] = bucket, value
        tail = (out[1:, None] - n_stats + np.arange(n_stats)).ravel()
        index[tail], x[tail] = bins.ravel(), np.float32(STAT_VALUE)
        return index, x, out

    def margin(self, index, x, ptr, keep: bool = False):
        """y of each row; every row has at least its statistics, so no segment is empty."""
        begin = ptr[:-1]
        if not len(begin):
            return np.zeros(0), None, None
        vx = self.factors[index] * x[:, None]
        total = np.add.reduceat(vx, begin, axis=0)
        pairs = 0.5 * (total ** 2 - np.add.reduceat(vx ** 2, begin, axis=0)).sum(axis=1)
        y = self.bias + np.add.reduceat(self.linear[index] * x, begin) + pairs
        return y, vx if keep else None, total

    def score(self, *parts) -> np.ndarray:
        y, _, _ = self.margin(*self.inputs(*parts))
        return 1 / (1 + np.exp(-np.clip(y.astype(np.float64), -30, 30)))


def train(bucket, value, ptr, stats, label, rank: int = RANK, epochs: int = 8, batch: int = 128,
          rate: float = 0.1, penalty: float = 1e-5, seed: int = 7) -> Model:
    """Adagrad on the logistic loss."""
    label = np.asarray(label, dtype=np.float64)
    inputs = (1 << WORD_BITS) + stats.shape[1] * BINS
    rng = np.random.default_rng(seed)
    good = label.sum()
    model = Model(float(np.log((good + 1) / (len(label) - good + 1))), np.zeros(inputs, np.float32),
                  np.zeros((inputs, rank), np.float32), np.zeros((stats.shape[1], BINS - 1)))
    if not 0 < good < len(label):
        return model
    model.factors = rng.normal(0, 0.05, (inputs, rank)).astype(np.float32)
    model.cuts = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    index, x, out = model.inputs(bucket, value, ptr, stats)
    g_lin, g_fac, g_bias = np.full(inputs, 1e-2, np.float32), np.full((inputs, rank), 1e-2, np.float32), 1.0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for lo in range(0, len(order), batch):
            mine = np.sort(order[lo:lo + batch])
            span = np.concatenate([np.arange(out[r], out[r + 1]) for r in mine])
            p = np.concatenate(([0], np.cumsum(out[mine + 1] - out[mine])))
            ix, xx = index[span], x[span]
            y, vx, total = model.margin(ix, xx, p, keep=True)
            error = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[mine]) / len(mine)
            per = np.repeat(error, np.diff(p)).astype(np.float32) * xx
            seen, back = np.unique(ix, return_inverse=True)
            grad = np.bincount(back, weights=per, minlength=len(seen)).astype(np.float32) + penalty * model.linear[seen]
            # d y / d v_i = x_i (sum of v x) - v_i x_i^2
            each = per[:, None] * (np.repeat(total, np.diff(p), axis=0) - vx)
            fac = np.zeros((len(seen), rank), np.float32)
            for f in range(rank):
                fac[:, f] = np.bincount(back, weights=each[:, f], minlength=len(seen))
            fac += penalty * model.factors[seen]
            g_lin[seen] += grad ** 2
            g_fac[seen] += fac ** 2
            model.linear[seen] -= rate * grad / np.sqrt(g_lin[seen])
            model.factors[seen] -= rate * fac / np.sqrt(g_fac[seen])
            g_bias += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(g_bias)
    return model


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _numbers(batch: pa.RecordBatch, first: int) -> list[np.ndarray]:
    return [np.log1p(np.maximum(np.nan_to_num(np.asarray(pc.fill_null(c, 0), dtype=np.float64), posinf=0.0), 0))
            for c in batch.columns[first:]]


def _metadata(df: DataFrame, metadata: tuple[str, ...]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(metadata)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
        metadata: tuple[str, ...] = (), max_rows: int = 10_000, max_nonzeros: int = 4_000_000) -> Model:
    """Fit on labelled rows outside the held-out third."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("label").alias("label"))
             .select("id", "label", F.xxhash64("id").alias("turn"))
             .orderBy("turn", "id").limit(max_rows))  # the documented bound of the sample
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *_metadata(docs, metadata))
    chosen = rows.join(F.broadcast(known), "id").select("turn", "id", "label", "text",
                                                        *[f"m{i}" for i in range(len(metadata))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                bucket, value, ptr, stats = features(batch.column(3), _numbers(batch, 4))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ptr), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(bucket, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(value, pa.float32())),
                     pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1]).cast(
                         pa.list_(pa.float64()))],
                    names=["turn", "id", "label", "n", "bucket", "value", "stats"])

    kind = dict(rows.dtypes)["id"]
    found = chosen.mapInArrow(extract, f"turn long, id {kind}, label int, n long, bucket array<int>, "
                                       "value array<float>, stats array<double>")
    # Copies of a row share its turn; the running sums keep the collected part within both bounds.
    # Each task hands on at most max_rows of them, however often an id repeats.
    by = ["turn", "id", "n", F.xxhash64("bucket", "value")]
    order = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    sample = (found.orderBy(*by).limit(max_rows).withColumns({"held": F.sum("n").over(order), "nth": F.count("*").over(order)})
              .where((F.col("held") <= max_nonzeros) & (F.col("nth") <= max_rows))
              .orderBy("nth").select("label", "bucket", "value", "stats").toArrow().combine_chunks())
    n_stats = STATS + len(metadata)
    lists = [sample.column(c).combine_chunks() if sample.num_rows else None for c in ("bucket", "value", "stats")]
    if not sample.num_rows:
        return train(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, np.int64), np.zeros((0, n_stats)), [])
    count = np.asarray(pc.list_value_length(lists[0]))
    return train(np.asarray(lists[0].flatten()), np.asarray(lists[1].flatten()),
                 np.concatenate(([0], np.cumsum(count))).astype(np.int64),
                 np.asarray(lists[2].flatten()).reshape(-1, n_stats), np.asarray(sample.column("label")))


def score(docs: DataFrame, model: Model, id_col: str, text_col: str, metadata: tuple[str, ...] = ()) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # fixed size: buckets and bins
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                got = shared.value.score(*features(batch.column(1), _numbers(batch, 2)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *_metadata(docs, metadata))
    return (rows.mapInArrow(run, f"id {kind}, score double")
            .select("id", held_out(F.col("id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, text_col: str, metadata: tuple[str, ...] = (),
              least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            names = [f"c{i}" for i in range(whole.num_columns)]  # by place: names may repeat
            named = pa.RecordBatch.from_arrays(whole.columns, names=names)
            for batch in slices(named, f"c{width}"):
                good = shared.value.score(*features(batch.column(width), _numbers(batch, width + 1))) >= least
                kept = batch.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays(kept.columns[:width], names=whole.schema.names[:width])

    return (docs.select("*", F.col(text_col).cast("string").alias("__text"), *_metadata(docs, metadata))
            .mapInArrow(run, docs.schema))
