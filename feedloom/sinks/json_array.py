"""``jsonarray`` sink: one file per task holding a JSON array of row objects.

* Tasks stream their rows (Arrow batches, no whole-partition buffer) into a
  staged file ``_staging/<job>/<attempt>-part-<n>.json``: ``[``, objects
  joined by ``,``, ``]``.  Dates and timestamps are written as ISO text,
  decimals as numbers, binary as base64.
* ``write_json_array`` serialises rows on the JVM (``to_json`` inside
  whole-stage codegen) and hands the writer one text column, which it only
  streams; ``df.write.format("jsonarray")`` on any other frame serialises
  in the task's Python worker.
* ``commit`` (driver) publishes the staged files under unique names; with
  overwrite it then removes every other file in the folder, and writes
  ``_SUCCESS``.  Nothing is visible before the commit.
* ``abort`` removes the staged files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from feedloom.sources.arrow import _fs, on_threads


JSON_COLUMN = "__json__"


def _default(v):
    import base64
    import datetime
    import decimal

    if isinstance(v, (datetime.datetime, datetime.date, datetime.time)):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (bytes, bytearray)):
        return base64.b64encode(bytes(v)).decode("ascii")
    raise TypeError(f"cannot encode {type(v).__name__}")


def _remove(fs, path: str) -> None:
    try:
        fs.delete_file(path)
    except OSError:
        pass


@dataclass
class StagedFile(WriterCommitMessage):
    staged: str
    final: str
    rows: int


class JsonArrayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, job: str):
        self.path = path.rstrip("/")
        self.overwrite = overwrite
        self.job = job

    def write(self, iterator):
        import json

        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        attempt = ctx.taskAttemptId() if ctx else 0
        fs, base = _fs(self.path)
        stage_dir = f"{base}/_staging/{self.job}"
        fs.create_dir(stage_dir, recursive=True)
        name = f"part-{part:05d}-{self.job}.json"
        staged = f"{stage_dir}/{attempt}-{name}"
        rows = 0
        try:
            with fs.open_output_stream(staged) as out:
                out.write(b"[")
                for batch in iterator:
                    if batch.schema.names == [JSON_COLUMN]:
                        texts = batch.column(0).to_pylist()
                    else:
                        texts = [json.dumps(rec, default=_default, ensure_ascii=False)
                                 for rec in batch.to_pylist()]
                    for t in texts:
                        if rows:
                            out.write(b",")
                        out.write(t.encode("utf-8"))
                        rows += 1
                out.write(b"]")
        except BaseException:
            _remove(fs, staged)
            raise
        return StagedFile(staged, f"{base}/{name}", rows)

    def commit(self, messages):
        import pyarrow.fs as pafs

        fs, base = _fs(self.path)
        staged = [m for m in messages if m is not None and m.staged]
        on_threads(lambda m: fs.move(m.staged, m.final), staged)
        if self.overwrite:
            finals = {m.final for m in staged}
            old = [i.path for i in fs.get_file_info(pafs.FileSelector(base, recursive=False))
                   if i.type == pafs.FileType.File and i.path not in finals]
            on_threads(fs.delete_file, old)
        try:
            fs.delete_dir(f"{base}/_staging/{self.job}")
        except OSError:
            pass
        with fs.open_output_stream(f"{base}/_SUCCESS") as out:
            out.write(b"success")

    def abort(self, messages):
        # every staged file of this job, including those of failed attempts
        fs, base = _fs(self.path)
        try:
            fs.delete_dir(f"{base}/_staging/{self.job}")
        except OSError:
            pass


class JsonArraySink(DataSource):
    """``df.write.format("jsonarray").mode("append" | "overwrite").save(path)``."""

    @classmethod
    def name(cls):
        return "jsonarray"

    def writer(self, schema: StructType, overwrite: bool):
        path = self.options.get("path")
        if not path:
            raise ValueError("path (the output folder) is required")
        fs, base = _fs(path)
        fs.create_dir(base, recursive=True)
        return JsonArrayWriter(path, overwrite, uuid.uuid4().hex[:12])


def register(spark) -> None:
    spark.dataSource.register(JsonArraySink)


def json_rows(df):
    """One JSON object text per row, built on the JVM: dates / timestamps as
    ISO text at every depth, null fields written as ``null`` (like ``json.dumps``)."""
    from pyspark.sql import functions as F

    cols = [_iso(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(JSON_COLUMN))


def _iso(c, t):
    """The value with dates and timestamps as ISO text, at every depth."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType, MapType

    from feedloom.functions.safe import iso_text

    if not _has_time(t):
        return c
    if isinstance(t, StructType):
        return F.when(c.isNotNull(), F.struct(*[_iso(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: _iso(x, t.elementType))
    if isinstance(t, MapType):
        return F.transform_values(c, lambda _, v: _iso(v, t.valueType))
    return iso_text(c, t)


def _has_time(t) -> bool:
    from pyspark.sql.types import ArrayType, MapType

    if isinstance(t, StructType):
        return any(_has_time(f.dataType) for f in t.fields)
    if isinstance(t, (ArrayType, MapType)):
        return _has_time(t.elementType if isinstance(t, ArrayType) else t.valueType)
    return t.typeName() in ("date", "timestamp", "timestamp_ntz")


def write_json_array(df, path: str, mode: str = "append") -> None:
    register(df.sparkSession)
    json_rows(df).write.format("jsonarray").mode(mode).save(path)


def read_json_array(spark, path: str, schema=None):
    """Read the files back.  Each file is one array (``multiLine``), which
    Spark cannot split: a file is read by one task."""
    r = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)
