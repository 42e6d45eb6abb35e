"""A training corpus from ``documents``: rejected documents go, one document of
each group of near copies stays, documents with benchmark passages go, and
the rest is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all
but the last return the columns of their input.  ``run`` writes every stage's
rows into the shared folder and rereads them, so a lost executor costs at
most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm import decontam, jaccard, packing, quality
from feedloom.llm.queries import byte_bpe
from feedloom.llm.registry import table
from feedloom.session import fresh_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labelled ones among them, doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", ("n_chars",))
    return quality.keep_good(docs, model, "text", ("n_chars",))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    return jaccard.keep_one(docs, "doc_id", "text", k=5, threshold=0.8)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"), "text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of 1024 tokens."""
    return packing.pack(docs, "doc_id", "text", byte_bpe(), window=1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained model and a greedy packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
