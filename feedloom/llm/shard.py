"""Balanced shards by histogram sort.

Rows are ordered by (hash of the text, hash of the id and of a row number taken
when they are landed), so equal texts are neighbours and no two rows are one.  The splitters between shards are found as a histogram sort finds
them: count the exact bytes below candidate boundaries across all partitions,
keep the interval that holds each splitter's target, probe that interval more
finely, and stop when a boundary is within the tolerance.  Then the rows are
exchanged once.  Law: ``bytes`` (sizes near equal).  A group of equal texts is
only cut where it is larger than the tolerance, at a boundary of id hashes.

Scale: the rows are written once; probing rounds reread (size, two hashes);
each round is one partially aggregated group-by that returns at most
``shards * 2**PROBE_BITS`` rows.  Row numbers inside a shard come from cells of
a bounded number of rows, hot texts being cut into more cells by id hash, so
no task holds a shard or a group of copies.  DataFrame functions only.

Defined results: a null or empty text has size 1; null ids and repeated rows
are kept, cut and numbered like any others; with fewer rows than shards some shards are
empty; an empty table gives no rows.  Kept columns come back in the struct
``row``, so their names can't clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import fresh_dir

PROBE_BITS = 12
LOW = -(1 << 63)
CELL_ROWS = 100_000  # rows numbered by one task, about


@dataclass(frozen=True)
class Edge:
    """Rows with (k1, k2) below it belong to the left; ``k1`` None: all rows."""
    k1: int | None
    k2: int = LOW

    def passed(self) -> Column:
        """1 for rows at or beyond the edge, else 0."""
        if self.k1 is None:
            return F.lit(0)
        a, b = F.col("k1"), F.col("k2")
        beyond = a >= self.k1 if self.k2 == LOW else (a > self.k1) | ((a == self.k1) & (b >= self.k2))
        return beyond.cast("int")


@dataclass
class _Search:
    """One splitter's interval: keys that begin with ``prefix`` (``bits`` of 128)."""
    target: float
    bits: int = 0
    prefix: int = 0   # of unsigned 128-bit keys
    below: int = 0    # exact bytes of keys below the interval
    edge: Edge | None = None


def _edge(prefix: int, bits: int) -> Edge:
    key = prefix << (128 - bits)
    if key >> 128:
        return Edge(None)
    return Edge((key >> 64) + LOW, (key & ((1 << 64) - 1)) + LOW)


def _prefix(bits: int) -> list[Column]:
    """The first ``bits`` of a row's key, as columns that group it."""
    first = F.shiftright("k1", 64 - min(bits, 64)).alias("p1")
    second = F.shiftright("k2", 128 - bits) if bits > 64 else F.lit(0).cast("long")
    return [first, second.alias("p2")]


def _inside(bits: int, prefix: int) -> Column:
    if bits == 0:
        return F.lit(True)
    if bits <= 64:
        return F.shiftright("k1", 64 - bits) == prefix - (1 << (bits - 1))
    head, tail = prefix >> (bits - 64), prefix & ((1 << (bits - 64)) - 1)
    return (F.col("k1") == head + LOW) & (F.shiftright("k2", 128 - bits) == tail - (1 << (bits - 65)))


def _number(p1: int, p2: int, bits: int) -> int:
    """Unsigned prefix from the signed group columns."""
    if bits <= 64:
        return p1 + (1 << (bits - 1))
    return ((p1 - LOW) << (bits - 64)) + p2 + (1 << (bits - 65))


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[Edge]:
    """Edges between ``shards`` parts of near equal bytes, from (k1, k2, size) rows."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    open_ = [_Search(total * i / shards) for i in range(1, shards)]
    done = list(open_)
    while open_:
        groups = {(s.bits, s.prefix) for s in open_}
        bits = open_[0].bits
        finer = bits + PROBE_BITS if bits + PROBE_BITS <= 64 or bits >= 64 else 64
        finer = min(finer, 128)
        wanted = F.lit(False)
        for _, p in sorted(groups):
            wanted = wanted | _inside(bits, p)
        counted = (keys.where(wanted).groupBy(*_prefix(finer)).agg(F.sum("size").alias("bytes")).collect())
        bins = sorted((_number(r["p1"], r["p2"], finer), r["bytes"]) for r in counted)
        for s in open_:
            mine = [(p, n) for p, n in bins if p >> (finer - bits) == s.prefix]
            below = s.below
            if not mine:
                s.edge = _edge(s.prefix, bits) if bits else Edge(None)
                continue
            for p, n in mine:
                if below + n >= s.target or p == mine[-1][0]:
                    left, right = abs(s.target - below), abs(below + n - s.target)
                    if min(left, right) <= slack or finer == 128:
                        s.edge = _edge(p, finer) if left <= right else _edge(p + 1, finer)
                    else:
                        s.bits, s.prefix, s.below = finer, p, below
                    break
                below += n
        open_ = [s for s in open_ if s.edge is None]
    return [s.edge for s in done]


def shard_rows(df: DataFrame, id_col: str, text_col: str, shards: int = 8, tolerance: float = 0.001,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, text_crc32, shard, slot, row) of every row."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.col(id_col), F.monotonically_increasing_id()).alias("k2"),
        *([F.struct(*keep).alias("row")] if keep else []))
    path = fresh_dir(spark, "shard")
    rows.write.parquet(path)  # fixes the row numbers
    wide = spark.read.parquet(path)
    keys = wide.select("size", "k1", "k2")
    edges = find_splitters(keys, shards, tolerance)

    shard = F.lit(0)
    for e in edges:
        shard = shard + e.passed()
    n = keys.count()
    bits = min(20, max(4, math.ceil(math.log2(max(1, n) / CELL_ROWS)) + 1 if n > CELL_ROWS else 4))
    c1 = F.shiftright("k1", 64 - bits).alias("c1")
    placed = keys.select("k2", shard.alias("shard"), c1)
    # A cell with more rows than CELL_ROWS (a hot text) is cut by the id's hash.
    sizes = (placed.groupBy("shard", "c1").agg(F.count("*").alias("n"))
             .select("shard", "c1", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL_ROWS)))
                     .cast("int").alias("cut")))
    hot = F.broadcast(sizes.where("cut > 0"))  # at most 2**20 cells and one more a shard
    c2 = F.coalesce(F.expr("shiftright(k2, 64 - cut)"), F.lit(0).cast("long")).alias("c2")
    counts = placed.join(hot, ["shard", "c1"], "left").groupBy("shard", "c1", c2).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("c1", "c2").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "c1", "c2", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "c1", "c2").orderBy("k1", "k2", "id")
    numbered = (wide.select("*", shard.alias("shard"), c1).join(hot, ["shard", "c1"], "left")
                .withColumn("c2", c2).withColumn("place", F.row_number().over(within) - 1))
    return (numbered.join(begins, ["shard", "c1", "c2"])  # both sides lie by these columns already
            .select("id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("base") + F.col("place")).cast("long").alias("slot"), *(["row"] if keep else [])))
