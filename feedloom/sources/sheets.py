"""Spreadsheet feed: locator urls, header naming, typed reads of CSV exports.

* ``locate``: a sheet url -> spreadsheet id and ``gid`` (from the query
  string), only for ``docs.google.com/spreadsheets/d/...``; other urls get an
  error text instead.  ``export_url`` builds the CSV export / query url.
* Header naming (``header_names``): every column is a string; a blank
  header cell is named ``Unnamed: <i>``, a repeated name gets ``.1``, ``.2``
  ...  An empty sheet is an error; a sheet without a header row needs a
  user schema.
* A user schema renames columns **by position** and casts them; a width
  that differs from the sheet's is an error, and so is any row with more or
  fewer cells than the first line.
* A line break inside a quoted cell belongs to the cell, as it stands; a quote
  opens a cell at the cell's start only (``csv_records``).

Two inputs are supported: landed CSV files (``read_sheet``, a distributed
CSV scan) and landed lines (``sheet_from_lines``: one row per line with its
line number, parsed with ``from_csv``).  Only the header line (or the first
line) reaches the driver.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedloom.sources.csv_records import csv_records, record_lines  # noqa: F401

# CSV as exported (RFC 4180): a quote inside a quoted field is doubled; a
# backslash is an ordinary character (Spark's default escape is "\\").
CSV_OPTIONS = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"}

# The sheet host and path prefix, and the rejection message.
HOST = "docs.google.com"
PREFIX = "/spreadsheets/d/"
NOT_A_SHEET = "URL is not a Google Sheets URL"


# RFC 3986 appendix B: scheme, authority, path, query, fragment; as lenient
# as Python's urlsplit (no validation, raw text kept).
_URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _form_decode(c: Column) -> Column:
    """``+`` -> space, ``%XX`` decoded; with a malformed escape the text is
    kept (``+`` still read as space)."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def query_value(query: Column, key: str) -> Column:
    """First non-blank value of ``key`` in a query string, decoded, like
    ``parse_qs(query)[key][0]`` (pairs without ``=`` and blank values are
    skipped)."""
    pairs = F.filter(F.split(query, "&"), lambda p: F.instr(p, "=") > 0)
    kv = F.transform(pairs, lambda p: F.split(p, "=", 2))
    hits = F.filter(kv, lambda a: (_form_decode(F.get(a, 0)) == key) & (F.get(a, 1) != ""))
    return _form_decode(F.get(F.get(hits, 0), 1))


def locate(url: Column) -> Column:
    """struct<spreadsheet_id, sheet_id, error>."""
    netloc = F.regexp_extract(url, _URL_PARTS, 2)
    path = F.regexp_extract(url, _URL_PARTS, 3)
    query = F.regexp_extract(url, _URL_PARTS, 4)
    ok = F.coalesce((netloc == HOST) & path.startswith(PREFIX), F.lit(False))
    sid = F.get(F.split(path, "/"), 3)
    gid = query_value(query, "gid")
    return F.struct(F.when(ok, sid).alias("spreadsheet_id"),
                    F.when(ok, gid).alias("sheet_id"),
                    F.when(~ok, F.lit(NOT_A_SHEET)).alias("error"))


def export_url(spreadsheet_id: Column, sheet_id: Column, query: Column | None = None) -> Column:
    """CSV export url (``tqx=out:csv``, then ``gid``, then ``tq``)."""
    from feedloom.functions.encode import form_encode

    base = F.concat(F.lit(f"https://{HOST}{PREFIX}"), spreadsheet_id, F.lit("/gviz/tq?tqx=out%3Acsv"))
    gid = F.when(sheet_id.isNotNull() & (sheet_id != ""), F.concat(F.lit("&gid="), form_encode(sheet_id)))
    parts = [base, F.coalesce(gid, F.lit(""))]
    if query is not None:
        parts.append(F.coalesce(F.concat(F.lit("&tq="), form_encode(query)), F.lit("")))
    return F.concat(*parts)


def header_names(cells: list[str]) -> list[str]:
    """Column names of a header row, as a pandas CSV read names them.

    An empty cell becomes ``Unnamed: <position>``.  Repeats get ``.1``,
    ``.2`` ...; given names keep priority over generated ones: all given
    names are settled first, left to right, then the generated ones, and a
    suffix is skipped when that name already exists in the header.
    """
    from collections import defaultdict

    names = [c if c else f"Unnamed: {i}" for i, c in enumerate(cells)]
    generated = [i for i, c in enumerate(cells) if not c]
    given = [i for i in range(len(names)) if cells[i]]
    seen: dict[str, int] = defaultdict(int)
    for i in given + generated:
        base = name = names[i]
        k = seen[base]
        while k > 0:
            seen[base] = k + 1
            name = f"{base}.{k}"
            # a suffixed name that is itself a header keeps looking
            k = k + 1 if name in names else seen[name]
        names[i] = name
        seen[name] = k + 1
    return names


def _cells(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line, newline="")), [])


def _schema_for(first_line: str | None, has_header: bool, schema) -> StructType:
    if first_line is None:
        raise ValueError("The sheet is empty")
    width = len(_cells(first_line))
    if schema is None:
        if not has_header:
            raise ValueError("has_header is false: give a schema that names the columns")
        return StructType([StructField(n, StringType()) for n in header_names(_cells(first_line))])
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if len(st.fields) != width:
        raise ValueError(f"CSV parse error: expected {len(st.fields)} columns, got {width}")
    return st


def sheet_from_lines(lines: DataFrame, has_header: bool = True, schema=None,
                     line_col: str = "line", n_col: str = "n",
                     header_n: int | None = None) -> DataFrame:
    """Landed lines (text + line number) -> typed rows.

    The first line is found with one aggregate (a pass over the line
    numbers); give ``header_n`` when its number is known, and the lookup is
    a filter that parquet statistics can skip row groups for.
    """
    if header_n is None:
        # one aggregate row to the driver: the first line and its number
        head = lines.agg(F.min_by(line_col, n_col).alias("l"), F.min(n_col).alias("n")).first()
    else:
        first = lines.where(F.col(n_col) == F.lit(header_n)).select(line_col).limit(1).collect()
        head = {"l": first[0][0] if first else None, "n": header_n}
    st = _schema_for(head["l"] if head else None, has_header, schema)
    line = F.col(line_col)
    if has_header:
        # the header line becomes null *before* parsing, so no cast ever sees it
        line = F.when(F.col(n_col) != F.lit(head["n"]), line)
    return _typed(lines.where(line.isNotNull()).select(line.alias("line")), st)


def _typed(lines: DataFrame, st: StructType) -> DataFrame:
    """Records (column ``line``) as rows of the schema, by position."""
    width = len(st.fields)
    ddl = ", ".join([*(f"`c{i}` string" for i in range(width)), "`_bad` string"])
    parsed = lines.select(F.from_csv("line", ddl, CSV_OPTIONS | {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    # a row of another width is reported, never cut or filled up
    ragged = F.when(F.col("_r._bad").isNotNull(), F.raise_error(
        F.concat(F.lit(f"CSV parse error: expected {width} cells in "), F.col("_r._bad"))))
    return parsed.where(ragged.isNull()).select(
        *[F.col(f"_r.c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(st.fields)])


def read_sheet(spark, path: str, has_header: bool = True, schema=None) -> DataFrame:
    """Landed CSV export(s) -> typed rows, each file read by as many tasks as
    Spark splits it into (see ``csv_records``).  Every file's header counts: all
    must name the same columns, or be as wide as a given schema."""
    records, heads = csv_records(spark, path)
    heads = [h.removeprefix("\ufeff") for h in heads]
    st = _schema_for(heads[0] if heads else None, has_header, schema)
    for head in heads[1:]:
        if _schema_for(head, has_header, schema) != st:
            raise ValueError(f"CSV parse error: files have different headers: {heads[0]!r} and {head!r}")
    first = (F.col("block") == 0) & (F.col("n") == 0)
    if has_header:
        records = records.where(~first)
    else:
        records = records.withColumn("line", F.when(first, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line")))
    return _typed(records.select("line"), st)
