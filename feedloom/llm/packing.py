"""Packing documents into training sequences by lexical retrieval.

Documents become token ids and are dealt into shards of about
``shard_tokens`` tokens, lexically close documents together.  Each shard has a
BM25 inverted index over its token ids, weighted by the document frequencies,
document number and mean length of the whole corpus.  A seed document opens a window of
``window`` tokens; the index returns its unused neighbours by score over all
the seed's distinct tokens, which fill the window greedily; the one that
doesn't fit is cut, and its rest seeds
the next window.  Only a shard's last window can be short; it is cut into
sequences whose lengths are powers of two, so there is no padding at all.

A document's place in the order of shards is its token of least
exponential draw divided by its id (ids are in the order of merges, so rare
tokens have large ones): a weighted min-hash that copies share and that
documents with common rare tokens often share.

Scale: each text is encoded once and its ids are written compactly before the
one exchange.  Shards are laid out by the exact number of tokens at each
place (at most one row per vocabulary entry); a place with more tokens than a
shard, such as that of a large group of copies or of equal rows, is dealt into
several shards by the hash of the id and of a row number taken when the ids
are landed.  A task holds one shard at a time, and the frequencies
(one number per vocabulary entry).  Neighbours are looked up among the
documents of the seed's own shard; close documents in other shards never meet
(the README has their measured share).

Defined results: a null or empty text has the end token only; repeated rows
and rows with null ids are documents of their own; ties in score go to the
earlier document of the shard's order; an empty table gives no rows; extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import U, mix, slices
from feedloom.llm.tokenizer import encoder
from feedloom.session import fresh_dir

WINDOW = 1024
SHARD_TOKENS = 4_000_000
K1, B = 1.2, 0.75
SQUARE, OFTEN = 4096, 16  # documents of a shard with a score matrix; a share of them that is many
GRAIN = 1 << 20


def _draws(n: int) -> np.ndarray:
    """Order of token ids by exponential draw over id."""
    with np.errstate(over="ignore"):
        u = (mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)) >> U(11)).astype(np.float64) / 2.0 ** 53
    value = -np.log1p(-u) / np.arange(1, n + 1)
    out = np.empty(n, dtype=np.int64)
    out[np.argsort(value, kind="stable")] = np.arange(n)
    return out


def encode(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """(id, place, digest, n, wide, ids) of every document: ids as bytes of
    16-bit numbers, or of 32-bit numbers where one needs it (``wide``)."""
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, draws = encoder(tokenizer).many, _draws(1 << 16)
        for whole in batches:
            for batch in slices(whole, "text"):
                place, digest, n, wide, ids = [], [], [], [], []
                for found in many([text or "" for text in batch.column(1).to_pylist()]):
                    x = np.append(found, np.uint32(end_id))
                    big = int(x.max()) >= 1 << 16
                    if big and int(x.max()) >= len(draws):
                        draws = _draws(1 << int(x.max()).bit_length())
                    raw = x.astype("<u4" if big else "<u2").tobytes()
                    place.append(int(draws[x].min()))
                    digest.append(zlib.crc32(raw))
                    n.append(len(x))
                    wide.append(big)
                    ids.append(raw)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(place, pa.int64()), pa.array(digest, pa.int64()), pa.array(n, pa.int64()),
                     pa.array(wide, pa.bool_()), pa.array(ids, pa.binary())],
                    names=["id", "place", "digest", "n", "wide", "ids"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, place long, digest long, n long, wide boolean, ids binary"))


class Statistics(NamedTuple):
    """What BM25 weights need to know of a corpus."""

    documents: int
    mean: float  # tokens a document
    df: np.ndarray  # documents with each token id


class Bm25:
    """Inverted index of one shard; without ``corpus``, the shard is the whole corpus.

    Tokens that stand in many documents have their impacts in a matrix instead
    of postings, and their part of all scores is one matrix product, in shards
    of up to ``SQUARE`` documents (shorter documents have few such tokens).
    Impacts are multiples of ``1 / GRAIN``, so both ways give the same sums.
    """

    def __init__(self, docs: list[np.ndarray], corpus: Statistics | None = None):
        n = len(docs)
        length = np.array([len(d) for d in docs], dtype=np.float64)
        row = np.repeat(np.arange(n), [len(d) for d in docs])
        flat = np.concatenate([np.sort(d) for d in docs])
        key = row.astype(np.int64) << 32 | flat
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        tf = np.diff(np.append(first, len(key))).astype(np.float64)
        doc, term = key[first] >> 32, key[first] & 0xFFFFFFFF
        held = np.bincount(term)
        total, mean, df = corpus or Statistics(n, length.mean(), held)
        idf = np.log1p((total - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / mean)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        # Multiples of a power of two: sums are exact, in whatever order they are taken.
        weight = np.rint(weight * GRAIN) / GRAIN
        self.n, self.common = n, None
        if n <= SQUARE:
            often = np.flatnonzero(held >= max(2, n // OFTEN))
            place = np.full(len(held), -1)
            place[often] = np.arange(len(often))
            dense = place[term] >= 0
            seeds, impacts = np.zeros((n, len(often))), np.zeros((n, len(often)))
            seeds[doc[dense], place[term[dense]]] = 1
            impacts[doc[dense], place[term[dense]]] = weight[dense]
            self.common = seeds @ impacts.T
            doc, term, weight = doc[~dense], term[~dense], weight[~dense]
            held = np.bincount(term, minlength=len(held))
        self.terms = term.astype(np.int32)
        self.begin = np.searchsorted(doc, np.arange(n + 1))
        order = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[order], weight[order]
        self.posting = np.concatenate(([0], np.cumsum(held)))

    def forget(self, free: np.ndarray) -> None:
        """Leave documents that aren't free out of the postings; they can still be seeds."""
        keep = free[self.doc] > 0
        self.posting = np.concatenate(([0], np.cumsum(keep)))[self.posting]
        self.doc, self.impact = self.doc[keep], self.impact[keep]

    def neighbours(self, seed: int, free: np.ndarray, most: int = 32) -> list[int]:
        """Free documents with a positive score over all the seed's terms, best first."""
        terms = self.terms[self.begin[seed]:self.begin[seed + 1]]
        spans = [slice(a, b) for a, b in zip(self.posting[terms].tolist(), self.posting[terms + 1].tolist())]
        score = np.zeros(self.n) if self.common is None else self.common[seed]
        if spans:
            score = score + np.bincount(np.concatenate([self.doc[s] for s in spans]),
                                        np.concatenate([self.impact[s] for s in spans]), self.n)
        score = score * free
        found = np.flatnonzero(score)
        if len(found) > most:
            kth = np.partition(score[found], len(found) - most)[len(found) - most]
            found = found[score[found] >= kth]
        return found[np.argsort(-score[found], kind="stable")].tolist()


def pack_shard(docs: list[np.ndarray], window: int = WINDOW,
               corpus: Statistics | None = None) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    index, free = Bm25(docs, corpus), np.ones(len(docs), dtype=np.float32)
    size = [len(d) for d in docs]
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence, used, following, rest, left, listed = 0, 0, 0, None, len(docs), len(docs)
    while True:
        if rest is None:  # a new seed: the first document not yet used
            while following < len(docs) and not free[following]:
                following += 1
            if following == len(docs):
                break
            rest, free[following], left = (following, 0), 0, left - 1
        seed, start = rest
        rest = None
        while size[seed] - start >= window:
            pieces.append((seed, start, window, sequence, 0))
            sequence, start = sequence + 1, start + window
        if start == size[seed]:
            continue
        pieces.append((seed, start, size[seed] - start, sequence, 0))
        used = size[seed] - start
        if 4 * left < 3 * listed:
            index.forget(free)
            listed = left
        # Neighbours by score; when they are used up, the next documents in order.
        asked = index.neighbours(seed, free)
        turn = 0
        while used < window:
            if turn < len(asked):
                doc, turn = asked[turn], turn + 1
            elif asked:
                asked, turn = index.neighbours(seed, free), 0
                continue
            else:
                while following < len(docs) and not free[following]:
                    following += 1
                if following == len(docs):
                    break
                doc = following
            if not free[doc]:
                continue
            take = min(size[doc], window - used)
            pieces.append((doc, 0, take, sequence, used))
            free[doc], left = 0, left - 1
            used += take
            if take < size[doc]:
                rest = (doc, take)
        if used < window:
            break  # every document is used
        sequence, used = sequence + 1, 0
    return _powers(pieces, sequence, used)


def _powers(pieces, sequence: int, used: int):
    """Cut the last, short window into sequences of power-of-two lengths."""
    if not used:
        return pieces
    last = [p for p in pieces if p[3] == sequence]
    out = pieces[:len(pieces) - len(last)]
    room, offset = 1 << (used.bit_length() - 1), 0
    for doc, start, length, _, _ in last:
        while length:
            take = min(length, room - offset)
            out.append((doc, start, take, sequence, offset))
            start, length, offset, used = start + take, length - take, offset + take, used - take
            if offset == room and used:
                sequence, offset, room = sequence + 1, 0, 1 << (used.bit_length() - 1)
    return out


def _statistics(rows: DataFrame) -> Statistics:
    """Statistics of all rows of ``encode``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for wide, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.sort(np.frombuffer(raw, dtype="<u4" if wide else "<u2"))
                if x[-1] >= len(df):
                    df = np.append(df, np.zeros((1 << int(x[-1]).bit_length()) - len(df), dtype=np.int64))
                df[x[np.concatenate(([True], x[1:] != x[:-1]))]] += 1
        token = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(df[token])], names=["token", "df"])

    found = (rows.select("wide", "ids").mapInArrow(count, "token long, df long")
             .groupBy("token").agg(F.sum("df").alias("df")).toArrow())  # at most the vocabulary
    size = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("tokens")).first()
    token = np.asarray(found.column("token"))
    df = np.zeros(int(token.max(initial=0)) + 1, dtype=np.int64)
    df[token] = np.asarray(found.column("df"))
    return Statistics(size["documents"], (size["tokens"] or 0) / max(1, size["documents"]), df)


def _layout(rows: DataFrame, shard_tokens: int) -> tuple[DataFrame, int]:
    """(place, first, parts): the shards of each place, and their number."""
    found = rows.groupBy("place").agg(F.sum("n").alias("n")).orderBy("place").collect()  # at most the vocabulary
    out, shard, used = [], 0, 0
    for r in found:
        if used and used + r["n"] > shard_tokens:
            shard, used = shard + 1, 0
        parts = max(1, -(-r["n"] // shard_tokens))
        out.append((r["place"], shard, parts))
        if parts > 1:
            shard, used = shard + parts, 0
        else:
            used += r["n"]
    return rows.sparkSession.createDataFrame(out, "place long, first long, parts long"), max(1, shard + bool(used))


def pack(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS, end_id: int = 0) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    kind = dict(docs.select(id_col).dtypes)[id_col]
    path = fresh_dir(spark, "packing")
    # Rows get a number as they are landed: it tells equal rows apart.
    encode(docs, id_col, text_col, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    layout, shards = _layout(rows, shard_tokens)
    corpus = spark.sparkContext.broadcast(_statistics(rows))  # one number per vocabulary entry
    turn = F.xxhash64("id", "digest")
    dealt = (rows.join(F.broadcast(layout), "place").withColumn("turn", turn)
             .withColumn("shard", F.col("first") + F.pmod(F.xxhash64("turn", "row"), F.col("parts")))
             .select("shard", "place", "turn", "digest", "row", "id", "n", "wide", "ids")
             .repartitionById(shards, F.col("shard").cast("int"))
             .sortWithinPartitions("shard", "place", "turn", "digest", "row"))

    def packed(t: pa.Table) -> pa.RecordBatch:
        ids = [np.frombuffer(raw, dtype="<u4" if wide else "<u2")
               for raw, wide in zip(t.column("ids").to_pylist(), t.column("wide").to_pylist())]
        pieces = pack_shard(ids, window, corpus.value)
        doc, start, length, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces))
        crc = [zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in pieces]
        first = np.int64(t.column("shard")[0].as_py()) << np.int64(32)
        return pa.RecordBatch.from_arrays(
            [t.column("id").combine_chunks().take(pa.array(doc)), pa.array(start), pa.array(length),
             pa.array(crc, pa.int64()), t.column("n").combine_chunks().take(pa.array(doc)),
             pa.array(first + sequence), pa.array(offset)],
            names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                if held and held[0].column(0)[0].as_py() != shard[lo]:
                    yield packed(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield packed(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                 "sequence_id long, offset long")
