"""Token counts through a digest cache.

``count_tokens`` keeps a table (tokenizer version, content digest) -> token
count in a shared folder.  It looks up the digest of every text, encodes only
the distinct texts that the cache lacks, appends their counts and joins the
counts back.  The content digest is the SHA-256 of the text, null being
empty; the tokenizer version is the SHA-256 of its file and library version,
so a changed tokenizer never meets old counts.

Scale: each task first drops the copies it has already seen (one digest per
distinct text of its split), so a hot text leaves a task once; the remaining
texts move once, by digest, are anti-joined with the cache and encoded there.
The join that returns counts carries (id, bytes, digest) only; Spark may split
its hot keys.  The cache is appended through Spark's committer: a lost
executor or failed run leaves no half-written counts, and rows that two runs
have both appended are read as one.

Defined results: every row is returned, repeated rows and null ids too; null
and empty texts have 0 tokens; an empty table gives no rows; extra columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import slices
from feedloom.llm.tokenizer import encoder, version
from feedloom.operators.fetch import join_on_key

CACHE = "digest binary, n_tokens long"


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest (column 0) this task has not seen before."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = []
        for i, d in enumerate(batch.column(0).to_pylist()):
            if d not in seen:
                seen.add(d)
                fresh.append(i)
        if fresh:
            yield batch.take(pa.array(fresh, pa.int64()))


def _counts(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = encoder(path).many
        for whole in _first_of_each(batches):
            for batch in slices(whole, "text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(x) for x in many(batch.column(1).to_pylist())], pa.int64())],
                    names=["digest", "n_tokens"])
    return count


def read_cache(spark, folder: str) -> DataFrame:
    """The cached counts of one tokenizer version, one row per digest."""
    try:
        found = spark.read.schema(CACHE).parquet(folder)
    except AnalysisException:  # no run has written it yet
        found = spark.createDataFrame([], CACHE)
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(df: DataFrame, id_col: str, text_col: str, tokenizer: str, cache: str,
                 limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row; fills the cache folder."""
    spark = df.sparkSession
    folder = f"{cache.rstrip('/')}/{version(tokenizer)}"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                     F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    texts = (df.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
             .mapInArrow(_first_of_each, "digest binary, text string")
             .repartition("digest"))
    misses = texts.join(read_cache(spark, folder), "digest", "left_anti").select("digest", "text")
    misses.mapInArrow(_counts(tokenizer), CACHE).write.mode("append").parquet(folder)
    counts = read_cache(spark, folder).withColumnRenamed("digest", "cached")
    return (join_on_key(rows, counts, ["digest"], ["cached"], "left")
            .select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
