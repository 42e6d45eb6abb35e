"""Prefix trie of conversations by whole-sequence collapse.

A node is a distinct sequence of the first d turns of some conversation, from
the textless root (d = 0); its members are the conversations that begin with
it.  Identical conversations are first grouped into weighted sequences, each
named after its smallest member, with a list of the members that end there.
A sequence that is a proper prefix of another one is told by an anti-join
with all proper prefixes; the others are the leaves.  Prefixes of the
sequences, weighted, are then aggregated into nodes.

A sequence is identified by its length and the exclusive or of two 64-bit
hashes of (position, SHA-256 of role and text) over its turns: 128 bits, which
running totals give for every prefix.

What a subtree sums.  Of bytes weighted by members: each sequence below a node
adds its weight times its bytes from the node on.  Of bytes counted once a
node: every node belongs to the sequence that its smallest member names; what a
sequence owns is the tail of its path, so below a node each sequence adds all
that it owns, but for the node's own sequence, which adds what lies from the
node on.  So one aggregate over (sequence, depth) rows gives every sum, and no
row is made per pair of node and ancestor.

Scale: turns move as (conversation, order, digest, bytes), never as texts. They
are numbered by ranges (``operators.numbering``), so a conversation of any
length is dealt over many tasks; joins by conversation or by parent can be split
at hot keys; everything else is an aggregate that tasks combine first.  Member
lists are digested in pieces of ``PIECE`` members; one task then reads the
pieces of a sequence one by one.

Defined results: null roles and texts are empty; rows without a conversation id
are no conversation's; turns of equal order stand in the order of the digest
of role and text, repeated rows one after the other; an empty table has no
nodes, not even a root; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import slices
from feedloom.operators.fetch import join_on_key
from feedloom.operators.numbering import running
from feedloom.session import fresh_dir

PIECE = 1 << 16
KEY = ["depth", "x1", "x2"]


def turns(df: DataFrame, id_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """(id, at, digest, bytes): the turns of every conversation, numbered from
    1; ``bytes`` is the size of the text in UTF-8."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(order_col).alias("ord"),
        F.substring(F.unhex(F.sha2(said.cast("binary"), 256)), 1, 16).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    return running(slim, ["id"], ["ord", "digest"], fresh_dir(df.sparkSession, "trie-turns")).drop("ord")


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, f"trie-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def paths(rows: DataFrame) -> DataFrame:
    """(id, depth, x1, x2, up1, up2, bytes, total): every prefix of every
    conversation of ``rows`` (id, at, digest, bytes), with its identity, that
    of its parent, and the bytes up to its last turn."""
    keyed = rows.select("id", "at", "bytes", F.xxhash64("digest", "at").alias("h1"),
                        F.xxhash64("at", "digest").alias("h2"))
    got = running(keyed, ["id"], ["at"], fresh_dir(rows.sparkSession, "trie-paths"), "depth", {"total": "bytes"},
                  {"x1": "h1", "x2": "h2"})
    return got.select("id", "depth", "x1", "x2", F.col("x1").bitwiseXOR(F.col("h1")).alias("up1"),
                      F.col("x2").bitwiseXOR(F.col("h2")).alias("up2"), "bytes", "total")


def collapse(path_rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ends, sequences): each conversation's whole sequence, and the distinct
    sequences with their smallest member (``seq``) and number of members.
    Conversations of ``ids`` without any turn are the empty sequence."""
    whole = path_rows.groupBy("id").agg(F.max(F.struct("depth", "x1", "x2", "total")).alias("w"))
    empty = F.lit(0).cast("long")
    ends = _landed(ids.select(F.col("id").alias("conv")).join(whole, F.col("conv") == whole["id"], "left").select(
        "conv", *[F.coalesce(F.col(f"w.{c}"), empty).alias(c) for c in ("depth", "x1", "x2", "total")]), "ends")
    sequences = _landed(ends.groupBy(*KEY, "total").agg(F.min("conv").alias("seq"), F.count("*").alias("weight")), "sequences")
    return ends, sequences


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256): SHA-256 of the ids that end at a node, in
    numeric order, joined by commas."""
    numbered = running(ends.select(*KEY, "conv"), KEY, ["conv"], fresh_dir(ends.sparkSession, "trie-members"), "nth")
    pieces = (numbered.groupBy(*KEY, F.expr(f"(nth - 1) div {PIECE}").alias("piece"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("text")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for whole in batches:
            for batch in slices(whole, "text"):
                done = []
                for *now, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                    if now != key:
                        if key:
                            done.append((*key, state.hexdigest()))
                        key, state = now, hashlib.sha256(text.encode())
                    else:
                        state.update(b"," + text.encode())
                if done:
                    yield _rows(done)
        if key:
            yield _rows([(*key, state.hexdigest())])

    def _rows(done):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])

    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "piece", "text")
            .mapInArrow(digest, "depth long, x1 long, x2 long, ends_sha256 string"))


def prefix_trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie over the conversations ``rows`` (id, at, digest,
    bytes, as ``turns`` returns them) and ``ids`` (id, each once): (conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256).  A node is (smallest member, depth)."""
    path_rows = paths(rows)
    ends, sequences = collapse(path_rows, ids)

    # Prefixes of the distinct sequences, the root included.
    of = sequences.select("seq", "weight", F.col("depth").alias("length"), F.col("total").alias("whole"))
    below = join_on_key(path_rows, of, ["id"], ["seq"], "inner").drop("id")
    zero = F.lit(0).cast("long")
    roots = of.select(*[(F.col(c) if c in of.columns else zero).alias(c) for c in below.columns])
    prefixes = _landed(below.unionByName(roots), "prefixes")

    proper = prefixes.where("depth < length").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select(F.col("seq").alias("leaf_seq"), F.lit(1).cast("long").alias("leaf"))
    first = prefixes.groupBy(*KEY).agg(F.min("seq").alias("seq"), F.first("bytes").alias("bytes"))
    owned = first.groupBy(F.col("seq").alias("own_seq")).agg(F.sum("bytes").alias("own"))
    facts = (sequences.select(F.col("seq").alias("fact_seq")).join(owned, F.col("fact_seq") == F.col("own_seq"), "left")
             .join(leaves, F.col("fact_seq") == F.col("leaf_seq"), "left")
             .select("fact_seq", *[F.coalesce(c, zero).alias(c) for c in ("own", "leaf")]))
    least = F.min(F.struct("seq", "own", "whole", (F.col("total") - F.col("bytes")).alias("above"), "up1", "up2"))
    nodes = (join_on_key(prefixes, facts, ["seq"], ["fact_seq"], "inner").groupBy(*KEY)
             .agg(least.alias("m"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
                  F.sum(F.col("weight") * F.col("whole")).alias("weighted"), F.sum("own").alias("once")))
    nodes = _landed(nodes.select(
        F.col("m.seq").alias("conv_id"), *KEY, F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"),
        F.col("m.up1").alias("up1"), F.col("m.up2").alias("up2"), "n_convs", "n_leaves",
        (F.col("weighted") - F.col("n_convs") * F.col("m.above")
         - (F.col("once") - F.col("m.own") + F.col("m.whole") - F.col("m.above"))).alias("saved_tokens")), "nodes")

    parents = nodes.select(F.col("conv_id").alias("parent_conv_id"), *[F.col(k).alias(f"parent_{k}") for k in KEY])
    kids = (nodes.where("depth > 0").groupBy(F.col("up_depth").alias("kid_depth"), F.col("up1").alias("kid_x1"), F.col("up2").alias("kid_x2"))
            .agg(F.count("*").alias("n_children")))
    listed = end_digests(ends).withColumnsRenamed({k: f"end_{k}" for k in KEY})
    out = join_on_key(nodes, parents, ["up_depth", "up1", "up2"], [f"parent_{k}" for k in KEY], "left")
    out = join_on_key(out, kids, KEY, [f"kid_{k}" for k in KEY], "left")
    out = join_on_key(out, listed, KEY, [f"end_{k}" for k in KEY], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def with_texts(nodes: DataFrame, df: DataFrame, id_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """Nodes of the trie over ``df`` itself with the role and text of their last turn."""
    said = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("said_id"), F.col(order_col).alias("ord"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    said = running(said.withColumn("digest", digest), ["said_id"], ["ord", "digest"],
                   fresh_dir(df.sparkSession, "trie-said"), "said_at").drop("ord", "digest")
    return join_on_key(nodes, said, ["conv_id", "depth"], ["said_id", "said_at"], "left").drop("said_id", "said_at")
