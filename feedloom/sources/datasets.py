"""Dataset files by handle: ``owner/name[/versions/n]`` + file name.

The handle resolves to a landed folder ``{root}/{owner}/{name}[/versions/n]``;
the file's extension picks the reader (csv, json, parquet) and extra reader
options pass through.  CSV types are inferred and then widened like a
pandas frame would hold them (int -> long, float -> double).  Credentials
must be given both or not at all.  A glob in the file name reads several
files as one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, ShortType, ByteType


def resolve(root: str, handle: str) -> str:
    parts = [p for p in (handle or "").strip("/").split("/") if p]
    if len(parts) == 2 or (len(parts) == 4 and parts[2] == "versions" and parts[3].isdigit()):
        return "/".join([root.rstrip("/"), *parts])
    raise ValueError(f"Invalid dataset handle {handle!r}; use owner/name[/versions/n]")


def check_credentials(username: str | None, key: str | None) -> None:
    if bool(username) != bool(key):
        raise ValueError("Give both username and key, or neither")


def read_file(spark, root: str, handle: str, file: str, username: str | None = None,
              key: str | None = None, schema=None, **options) -> DataFrame:
    """Read one file (or a glob) of a dataset.

    CSV types are inferred, which costs one extra pass over the files; for
    large files give ``schema`` (DDL) or a ``samplingRatio`` option.  A CSV
    row with more or fewer cells than the header is an error (``mode`` to
    change that).  Files are split by lines; give ``multiLine="true"`` where
    quoted cells hold line breaks.
    """
    check_credentials(username, key)
    folder = resolve(root, handle)
    path = f"{folder}/{file}"
    ext = file.rsplit(".", 1)[-1].lower()
    r = spark.read.options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    if ext == "csv":
        # RFC 4180 quoting (doubled quotes), as pandas reads it, unless overridden
        r = r.option("header", "true")
        if "escape" not in options:
            r = r.option("escape", '"')
        if "mode" not in options:
            r = r.option("mode", "FAILFAST")
        df = r.csv(path) if schema is not None else r.option("inferSchema", "true").csv(path)
    elif ext in ("json", "jsonl"):
        df = r.json(path)
    elif ext == "parquet":
        df = r.parquet(path)
    else:
        raise ValueError(f"Unsupported file type: {file}")
    widened = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, FloatType):
            c = c.cast("double")
        widened.append(c.alias(f.name))
    return df.select(*widened)
