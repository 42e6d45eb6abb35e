"""Streaming inputs: generated rows, landed snapshots, landed files.

Every stream reads from something replayable (a rate counter, or files in
the shared folder), so a restarted query resumes from its checkpoint and a
failed micro-batch is re-read, never re-fetched from a live service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.sources import fake


def fake_stream(spark, rows_per_batch: int = 3, schema=fake.DEFAULT_SCHEMA, seed: int = 0,
                partitions: int | None = None) -> DataFrame:
    """``rows_per_batch`` generated rows per micro-batch (ids count up from 0).

    Built on the ``rate-micro-batch`` source: offsets live in the checkpoint,
    so a restarted query continues the id sequence instead of restarting it.
    """
    st = fake.check_schema(schema)
    r = (spark.readStream.format("rate-micro-batch")
         .option("rowsPerBatch", int(rows_per_batch)))
    if partitions:
        r = r.option("numPartitions", int(partitions))
    return r.load().select(*fake.fake_columns(F.col("value"), st, seed))


def text_lines(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per line of newly landed text files (column ``body``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path).select(F.col("value").alias("body"))


def json_lines(spark, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def file_monitor(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files -> (name, path, content); the offset is the set of files seen."""
    r = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = r.load(path)
    return df.select(F.col("_metadata.file_name").alias("name"),
                     F.col("_metadata.file_path").alias("path"),
                     F.col("value").alias("content"))


CHUNK_BYTES = 64 << 20


def file_chunks(spark, path: str, chunk_bytes: int = CHUNK_BYTES, max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of any size -> (name, path, chunk, content), in parts of about
    ``chunk_bytes`` that several tasks read.

    A part has the characters whose first byte lies in its range of bytes, so the
    contents of a file's parts, in order, are the file; an empty file has none.  The stream itself holds names and sizes only; tasks open the files
    (with a file system that pyarrow knows).  Bytes that are no UTF-8 are replaced.
    """
    if chunk_bytes < 4:
        raise ValueError("chunk_bytes must be at least 4")
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    last = F.greatest(F.ceil(F.col("length") / chunk_bytes) - 1, F.lit(0))
    parts = (r.load(path).select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
             # a number of its own: these rows are tiny, and Spark would read all they name by one task
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "chunk"))

    def read(batches):
        import pyarrow as pa

        from feedloom.sources.arrow import _fs

        for batch in batches:
            for file, length, chunk in zip(*[c.to_pylist() for c in batch.columns]):
                fs, name = _fs(file)
                begin, end = chunk * chunk_bytes, min((chunk + 1) * chunk_bytes, length)
                with fs.open_input_file(name) as f:
                    raw = f.read_at(min(end + 3, length) - begin, begin) if length else b""
                follows = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
                skip, stop = 0, end - begin
                while chunk and skip < 3 and follows(skip):
                    skip += 1  # the rest of a character of the part before
                while stop < end - begin + 3 and follows(stop):
                    stop += 1
                yield pa.RecordBatch.from_pydict({
                    "name": [file.rsplit("/", 1)[-1]], "path": [file], "chunk": pa.array([chunk], pa.int64()),
                    "content": [raw[skip:stop].decode("utf-8", errors="replace")]})

    return parts.select("path", "length", "chunk").mapInArrow(read, "name string, path string, chunk long, content string")


def run_available(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                  mode: str = "append") -> None:
    """Process everything landed so far (``availableNow``) into files."""
    q = (stream.writeStream.format(fmt).outputMode(mode)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
