"""Records of CSV files whose quoted cells may hold line breaks, read by many tasks.

A quote opens a cell only at the cell's start; inside, two quotes are one;
elsewhere a quote is an ordinary character.  Whether a line break ends a
record thus depends on all that stands before it in the file.  Two scans of
the files' lines, each split wherever Spark splits them, settle it:

1. every split is read from both possible states at its first line, outside
   quotes and inside, and yields its state at the end for either: one small row
   a split, chained per file on the driver (as many rows as input splits);
2. with its true state known, every split cuts its lines into records.  A
   record that goes on over the end of a split leaves its pieces to be joined
   by an aggregate over the split it begins in.

Lines are cut at ``\\n`` only, so cells keep the line breaks they have; a
``\\r`` at a record's end is dropped, as are empty records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_WHOLE, _OPEN, _REST = 0, 1, 2  # a record; one that goes on behind the split; a part of one from before


def _closing(line: str, at: int) -> int:
    """Place of the quote that closes a cell whose content begins at ``at``, or -1."""
    while True:
        at = line.find('"', at)
        if at < 0 or line[at + 1:at + 2] != '"':
            return at
        at += 2


def inside_after(line: str, inside: bool) -> bool:
    """Whether a line's end is inside a quoted cell, given whether its start is."""
    at = 0
    while True:
        if inside or line[at:at + 1] == '"':
            end = _closing(line, at if inside else at + 1)
            if end < 0:
                return True
            inside, at = False, end + 1
        at = line.find(',"', at)
        if at < 0:
            return False
        at += 1


def _records(lines, inside: bool = False):
    """(text, closed) of the records of some lines, with the first one's rest if
    the start is inside a cell; the last may be open."""
    held: list[str] | None = [] if inside else None
    for line in lines:
        now = inside_after(line, inside) if '"' in line else inside
        if held is None and not now:
            yield line, True
        else:
            held = held or []
            held.append(line)
            if not now:
                yield "\n".join(held), True
                held = None
        inside = now
    if held is not None:
        yield "\n".join(held), False


def cut_records(text: str) -> list[str]:
    """The records of a CSV text, empty ones left out."""
    found = (r.removesuffix("\r") for r, _ in _records(text.removesuffix("\n").split("\n")))
    return [r for r in found if r]


@F.pandas_udf(ArrayType(StringType()))
def _cut(bodies):
    return bodies.map(lambda b: None if b is None else cut_records(b))


def record_lines(body: Column) -> Column:
    """The records of a CSV text as an array."""
    return _cut(body)


def _lines(spark, path) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))


def _groups(batches: Iterator[pa.RecordBatch]):
    """(file, block, lines, last): consecutive lines of one split, batch by batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(1), batch.column(2)
        new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        cuts = [0, *(np.flatnonzero(np.asarray(new)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            now = (file[lo].as_py(), block[lo].as_py())
            if held is not None:
                yield (*held[:3], held[:2] != now)
            held = (*now, batch.column(0).slice(lo, hi - lo))
    if held is not None:
        yield (*held, True)


class _Split:
    """What one split does with either state at its start."""

    def __init__(self):
        self.ends, self.closed, self.first, self.done = [False, True], False, [], False

    def read(self, lines: pa.Array, head: bool) -> None:
        quoted = np.flatnonzero(np.asarray(pc.match_substring(lines, '"')))
        if head and not self.done:
            self._head(lines.to_pylist())
        for i in quoted.tolist():  # other lines keep the state
            line = lines[i].as_py()
            self.ends = [inside_after(line, s) for s in self.ends]
            self.closed |= not self.ends[1]

    def _head(self, lines: list[str]) -> None:
        inside = bool(self.first)
        for line in lines:
            inside = inside_after(line, inside)
            if self.first or inside or line.removesuffix("\r"):
                self.first.append(line)
                if not inside:
                    self.done = True
                    return


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = _Split()
    for file, block, lines, last in _groups(batches):
        state.read(lines, block == 0)
        if last:
            head = "\n".join(state.first).removesuffix("\r") if state.done else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([state.ends[0]]), pa.array([state.ends[1]]),
                 pa.array([state.closed]), pa.array([head], pa.string())],
                names=["file", "block", "from_outside", "from_inside", "closes", "head"])
            state = _Split()


def csv_records(spark, path) -> tuple[DataFrame, list[str]]:
    """(records, heads) of the CSV files at ``path``: one row a record, (file,
    block, n, line), where (0, 0) is a file's first record; and the first
    record of every file that has any."""
    lines = _lines(spark, path)
    found = (lines.mapInArrow(_survey, "file string, block long, from_outside boolean, from_inside boolean, "
                                       "closes boolean, head string").collect())
    found.sort(key=lambda r: (r["file"], r["block"]))  # here: a sort by Spark would survey all lines twice
    # Splits that begin inside a cell, with the split that their first record begins in.
    owner: dict[tuple[str, int], int] = {}
    file, inside, begun = None, False, 0
    for r in found:
        if r["file"] != file:
            file, inside = r["file"], False
        if inside:
            owner[file, r["block"]] = begun
        begun = r["block"] if not inside or r["closes"] else begun
        inside = r["from_inside"] if inside else r["from_outside"]
    known = spark.sparkContext.broadcast(owner)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, rest = 0, None  # records of the split so far; lines of the record that is open
        for file, block, column, last in _groups(batches):
            if rest is None:
                rest, from_before = [], (file, block) in known.value
            out: list[tuple[int, int, int, str]] = []
            for text, closed in _records([*rest, *column.to_pylist()] if rest else column.to_pylist(), from_before):
                if not closed and not last:
                    rest = text.split("\n")
                    break
                rest = []
                if from_before:
                    out.append((known.value[file, block], -1, _REST, text))
                    from_before = False
                elif not closed:
                    out.append((block, n, _OPEN, text))
                elif text.removesuffix("\r"):
                    out.append((block, n, _WHOLE, text))
                    n += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(out)), pa.array([block] * len(out)), *[pa.array(c) for c in zip(*out)]],
                    names=["file", "place", "block", "n", "kind", "line"])
            if last:
                n, rest = 0, None

    rows = lines.mapInArrow(cut, "file string, place long, block long, n long, kind long, line string")
    ended = F.regexp_replace("line", "\r$", "")
    whole = rows.where(F.col("kind") == _WHOLE).select("file", "block", "n", ended.alias("line"))
    if owner:
        pieces = rows.where(F.col("kind") != _WHOLE).groupBy("file", "block").agg(
            F.max("n").alias("n"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda p: p["line"]), "\n").alias("line"))
    else:  # no record goes on over the end of a split, but a file's last may be open
        pieces = rows.where(F.col("kind") == _OPEN)
    records = whole.unionByName(pieces.select("file", "block", "n", ended.alias("line")))
    if any(r["block"] == 0 and r["head"] is None for r in found):  # longer than its split, or no record at all
        heads = records.where((F.col("block") == 0) & (F.col("n") == 0)).orderBy("file").select("line").collect()
        return records, [r["line"] for r in heads]
    return records, [r["head"] for r in found if r["head"] is not None]
