"""Arrow IPC files in and out, as Spark Python data sources.

``arrowfiles`` (reader): ``path`` is a file, a directory (its ``*.arrow``
files, sorted) or a glob; nothing matching is an error.  The schema comes
from the first file's IPC footer (no batch is read on the driver).  Input
partitions are (file, range of record batches) of about ``maxPartitionBytes``
(default 128 MB, estimated from file size / batch count), so a large file is
read by several tasks; every batch is cast to the schema handed to the
reader.  A failing file is named in the error.  Conditions skip batches by
their zone maps (``sources.zones``).

``arrowdataset`` (writer): append-only dataset of IPC fragments.  Tasks
write fragments to a staging folder; the driver's ``commit`` publishes
them in one step (rename), ``abort`` removes them.  Overwrite is rejected.
Read the dataset back with ``arrowfiles``.

Paths may be local or any filesystem pyarrow knows (``s3://``, ``hdfs://``,
``gs://``): tasks open files themselves, nothing passes through the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from feedloom.sources.zones import OPERATORS, marked, possible, read_zones, write_zones, zone

SPLIT_BYTES = 128 * 1024 * 1024  # like spark.sql.files.maxPartitionBytes


# Hadoop's names of stores that pyarrow knows by another name.
HADOOP_SCHEMES = {"s3a": "s3", "s3n": "s3"}
DRIVER_THREADS = 32  # file calls the driver makes at once


def on_threads(call, items) -> list:
    """``call`` of every item, in order, many at a time (file system calls)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(DRIVER_THREADS) as pool:
        return list(pool.map(call, items))


def store_uri(uri: str) -> str:
    """A Hadoop URI as pyarrow names the same store."""
    scheme, _, rest = uri.partition("://")
    return f"{HADOOP_SCHEMES.get(scheme, scheme)}://{rest}"


def _fs(path: str):
    import pyarrow.fs as pafs

    p = path
    if p.startswith("file:"):
        p = p[len("file:"):]
        if p.startswith("//"):
            p = p[2:]
    if "://" in p:
        return pafs.FileSystem.from_uri(store_uri(p))
    return pafs.LocalFileSystem(), p


def _hidden(rel: str) -> bool:
    """Staging folders and marker files (``_x``, ``.x``) are never data."""
    return any(part.startswith(("_", ".")) for part in rel.split("/") if part)


def _children(fs, folder: str):
    import pyarrow.fs as pafs

    return fs.get_file_info(pafs.FileSelector(folder, recursive=False, allow_not_found=True))


def list_files(path: str) -> list[str]:
    """File, directory (``*.arrow`` sorted) or glob -> sorted file list."""
    import fnmatch

    import pyarrow.fs as pafs

    fs, p = _fs(path)
    if any(ch in p for ch in "*?["):
        # segment by segment: a pattern never crosses a folder, and only
        # folders that match are listed
        *folders, last = p.split("/")
        found = [""]
        for part in folders:
            if any(ch in part for ch in "*?["):
                listed = on_threads(lambda d: _children(fs, d), found)
                found = [i.path for many in listed for i in many if i.type == pafs.FileType.Directory
                         and fnmatch.fnmatchcase(i.base_name, part) and not _hidden(i.base_name)]
            else:
                found = [f"{d}{part}" if d in ("", "/") else f"{d}/{part}" for d in found]
                found = [d or "/" for d in found]
        listed = on_threads(lambda d: _children(fs, d), found)
        files = [i.path for many in listed for i in many if i.type == pafs.FileType.File
                 and fnmatch.fnmatchcase(i.base_name, last) and not _hidden(i.base_name)]
    else:
        info = fs.get_file_info(p)
        if info.type == pafs.FileType.File:
            files = [p]
        elif info.type == pafs.FileType.Directory:
            sel = pafs.FileSelector(p, recursive=False)
            files = [i.path for i in fs.get_file_info(sel)
                     if i.type == pafs.FileType.File and i.path.endswith(".arrow")
                     and not _hidden(i.path[len(p):])]
        else:
            files = []
    files = sorted(files)
    if not files:
        raise FileNotFoundError(f"No Arrow files found at {path}")
    return files


def file_schema(path: str) -> StructType:
    """Schema of the first file at ``path``."""
    import pyarrow.ipc as ipc
    from pyspark.sql.pandas.types import from_arrow_schema

    first = list_files(path)[0]
    fs, _ = _fs(path)
    r = _open(fs, first)
    if r is not None:
        return from_arrow_schema(r.schema)
    with fs.open_input_stream(first) as f:
        return from_arrow_schema(ipc.open_stream(f).schema)


def _open(fs, file: str, columns: list[str] | None = None):
    """The file's reader (of some columns only), or None for the stream format."""
    import pyarrow.ipc as ipc

    f = fs.open_input_file(file)
    try:
        r = ipc.open_file(f)
        if columns is None or set(r.schema.names) <= set(columns):
            return r
        wanted = [i for i, n in enumerate(r.schema.names) if n in set(columns)]
        return ipc.open_file(f, options=ipc.IpcReadOptions(included_fields=wanted))
    except Exception:  # noqa: BLE001 - stream format
        f.close()
        return None


@dataclass
class ArrowSplit(InputPartition):
    file: str
    first: int
    last: int  # exclusive; -1 = stream file, read all
    kept: list[int] | None = None  # the batches to read, where some are skipped


class ArrowFilesReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int = SPLIT_BYTES, some: bool = False,
                 conditions: list[tuple] = (), fill: bool = False):
        self.path = path
        self.conditions = list(conditions)  # (column, operator, value), all true of every row that is wanted
        self.fill = fill  # a column that a file lacks is null there
        self.schema = schema
        self.some = some  # the schema is a selection of the files' columns
        self.split_bytes = max(1, int(split_bytes))

    def partitions(self):
        fs, _ = _fs(self.path)

        def splits(file):
            r = _open(fs, file)
            if r is None:
                return [ArrowSplit(file, 0, -1)]
            n = r.num_record_batches
            per_batch = (fs.get_file_info(file).size or 0) / max(n, 1)
            step = max(1, int(self.split_bytes // max(per_batch, 1)))
            zones = read_zones(r) if self.conditions else None
            if zones is None:
                return [ArrowSplit(file, s, min(s + step, n)) for s in range(0, max(n, 1), step)]
            some = possible(zones, r.schema.names, self.conditions)
            return [ArrowSplit(file, k[0], k[-1] + 1, k) for k in (some[s:s + step] for s in range(0, len(some), step))]

        return [s for many in on_threads(splits, list_files(self.path)) for s in many]

    def read(self, partition: ArrowSplit):
        import pyarrow as pa
        import pyarrow.ipc as ipc
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        fs, _ = _fs(self.path)

        def project(b):
            more = [n for n in b.schema.names if n not in target.names]
            if more and not self.some:
                raise ValueError(f"columns {more} are not in the schema read from the first file; give the columns to read")
            absent = [n for n in target.names if n not in b.schema.names]
            if absent and not self.fill:
                raise ValueError(f"it lacks the columns {absent} of the first file; missing='null' reads them as null")
            cols = []
            for field in target:
                idx = b.schema.get_field_index(field.name)
                col = b.column(idx) if idx >= 0 else pa.nulls(b.num_rows, field.type)
                cols.append(col.cast(field.type))
            return pa.RecordBatch.from_arrays(cols, schema=target)

        try:
            if partition.last < 0:
                # stream format: read and hand on one batch at a time
                with fs.open_input_stream(partition.file) as f:
                    for b in ipc.open_stream(f):
                        yield project(b)
            else:
                r = _open(fs, partition.file, target.names if self.some else None)
                for i in partition.kept or range(partition.first, partition.last):
                    yield project(r.get_batch(i))
        except Exception as e:
            raise RuntimeError(f"{partition.file} cannot be read as Arrow: {e}") from e


class PushingReader(ArrowFilesReader):
    """A reader that also takes the conditions Spark pushes down (Spark asks it
    only where ``spark.sql.python.filterPushdown.enabled`` is set)."""

    def pushFilters(self, filters):
        from pyspark.sql import datasource as D

        compared = {D.EqualTo: "=", D.EqualNullSafe: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<",
                    D.LessThanOrEqual: "<=", D.In: "in", D.StringStartsWith: "starts", D.IsNull: "is null",
                    D.IsNotNull: "is not null"}
        for f in filters:
            op = compared.get(type(f))
            value = getattr(f, "value", None)
            if op is not None and len(f.attribute) == 1 and not (isinstance(f, D.EqualNullSafe) and value is None):
                self.conditions.append((f.attribute[0], op, value))
            yield f  # a batch is skipped or read whole: Spark still looks at every row


@dataclass
class StagedFragment(WriterCommitMessage):
    staged: str
    final: str
    rows: int


class ArrowDatasetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path = path.rstrip("/")
        self.job = job

    def write(self, iterator):
        import pyarrow.ipc as ipc
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        attempt = ctx.taskAttemptId() if ctx else 0
        fs, base = _fs(self.path)
        name = f"part-{part:05d}-{self.job}.arrow"
        staged = f"{base}/_staging/{self.job}/{attempt}-{name}"
        fs.create_dir(f"{base}/_staging/{self.job}", recursive=True)
        rows = 0
        writer, zones, sizes = None, [], []
        try:
            with fs.open_output_stream(staged) as out:
                for batch in iterator:
                    if writer is None:
                        schema = marked(batch.schema)
                        writer = ipc.new_file(out, schema)
                    writer.write_batch(batch.cast(schema))
                    zones.append(zone(batch))
                    sizes.append(batch.num_rows)
                    rows += batch.num_rows
                if writer is not None:
                    write_zones(writer, schema, zones, sizes)
                    writer.close()
        except BaseException:
            try:
                fs.delete_file(staged)
            except OSError:
                pass
            raise
        if writer is None:
            fs.delete_file(staged)
            return StagedFragment("", "", 0)
        return StagedFragment(staged, f"{base}/{name}", rows)

    def commit(self, messages):
        fs, base = _fs(self.path)
        on_threads(lambda m: fs.move(m.staged, m.final), [m for m in messages if m is not None and m.staged])
        try:
            fs.delete_dir(f"{base}/_staging/{self.job}")
        except OSError:
            pass

    def abort(self, messages):
        # every staged fragment of this job, including those of failed attempts
        fs, base = _fs(self.path)
        try:
            fs.delete_dir(f"{base}/_staging/{self.job}")
        except OSError:
            pass


class ArrowFilesSource(DataSource):
    """``spark.read.format("arrowfiles").load(path)``."""

    @classmethod
    def name(cls):
        return "arrowfiles"

    def _path(self) -> str:
        p = self.options.get("path")
        if not p:
            raise ValueError("path is required")
        return p

    def _columns(self) -> list[str] | None:
        import json

        given = self.options.get("columns")
        return json.loads(given) if given else None

    def schema(self):
        st = file_schema(self._path())
        columns = self._columns()
        if columns is None:
            return st
        missing = [c for c in columns if c not in st.names]
        if missing:
            raise ValueError(f"no columns {missing} in the first file; it has {st.names}")
        return StructType([st[c] for c in columns])

    def reader(self, schema: StructType):
        import json

        missing = self.options.get("missing", "error")
        if missing not in ("error", "null"):
            raise ValueError("missing must be 'error' or 'null'")
        where = self.options.get("where")
        kind = PushingReader if self.options.get("pushdown", "false").lower() == "true" else ArrowFilesReader
        return kind(self._path(), schema, int(self.options.get("maxPartitionBytes", SPLIT_BYTES)),
                    self._columns() is not None, [(c, op, _decoded(v)) for c, op, v in json.loads(where or "[]")], missing == "null")


class ArrowDatasetSink(DataSource):
    """``df.write.format("arrowdataset").mode("append").save(path)``."""

    @classmethod
    def name(cls):
        return "arrowdataset"

    def writer(self, schema: StructType, overwrite: bool):
        path = self.options.get("path")
        if not path:
            raise ValueError("path is required")
        if overwrite:
            raise ValueError("arrowdataset supports append only; overwrite is not supported")
        fs, base = _fs(path)
        fs.create_dir(base, recursive=True)
        return ArrowDatasetWriter(path, uuid.uuid4().hex[:12])


def register(spark) -> None:
    spark.dataSource.register(ArrowFilesSource)
    spark.dataSource.register(ArrowDatasetSink)


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_arrow(spark, path: str, columns: list[str] | None = None, where: list[tuple] = (), missing: str = "error"):
    """Rows of Arrow files; with ``columns`` no other column leaves the files.

    ``where`` is a list of (column, operator, value), with an operator of
    ``zones.OPERATORS``: only rows for which all are true are returned, and of
    files that ``append_arrow`` wrote only the batches are read whose zones can
    hold such rows.  Where Spark's filter push-down for Python sources is on,
    plain ``where`` conditions on the result skip batches too.  A file that
    lacks a column of the first one is an error, or null there with
    ``missing="null"``.
    """
    import json
    from functools import reduce

    from pyspark.sql import functions as F

    register(spark)
    r = spark.read.format("arrowfiles").option("missing", missing)
    if columns is not None:
        r = r.option("columns", json.dumps(list(columns)))
    if str(spark.conf.get(PUSHDOWN, "false")).lower() == "true":
        r = r.option("pushdown", "true")
    bad = [op for _, op, _ in where if op not in OPERATORS]
    if bad:
        raise ValueError(f"unknown operators {bad}; known: {list(OPERATORS)}")
    if not where:
        return r.load(path)
    df = r.option("where", json.dumps([[c, op, _encoded(v)] for c, op, v in where])).load(path)
    tests = {"=": lambda c, v: c == v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
             "<=": lambda c, v: c <= v, "in": lambda c, v: c.isin(*v), "starts": lambda c, v: c.startswith(v),
             "is null": lambda c, _: c.isNull(), "is not null": lambda c, _: c.isNotNull()}
    return df.where(reduce(lambda a, b: a & b, [tests[op](F.col(f"`{c}`"), v) for c, op, v in where]))


def _encoded(value):
    """A condition's value as JSON: a number, text, list, or {type: text}."""
    import datetime
    import decimal

    if isinstance(value, (list, tuple)):
        return [_encoded(v) for v in value]
    if isinstance(value, decimal.Decimal):
        return {"decimal": str(value)}
    if isinstance(value, datetime.datetime):
        return {"datetime": value.isoformat()}
    if isinstance(value, datetime.date):
        return {"date": value.isoformat()}
    return value


def _decoded(value):
    import datetime
    import decimal

    if isinstance(value, list):
        return [_decoded(v) for v in value]
    if isinstance(value, dict):
        (kind, text), = value.items()
        return {"decimal": decimal.Decimal, "datetime": datetime.datetime.fromisoformat, "date": datetime.date.fromisoformat}[kind](text)
    return value


def append_arrow(df, path: str) -> None:
    """Append fragments; a dataset keeps the schema of its first fragment."""
    register(df.sparkSession)
    try:
        have = file_schema(path)
    except FileNotFoundError:
        have = None
    if have is not None:
        types = lambda st: [(f.name, f.dataType.simpleString()) for f in st.fields]
        if types(have) != types(df.schema):
            raise ValueError(f"the dataset at {path} has columns {types(have)}, the rows have {types(df.schema)}")
    df.write.format("arrowdataset").mode("append").save(path)
