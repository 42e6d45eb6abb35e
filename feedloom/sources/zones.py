"""Zone maps: what each record batch of an Arrow file holds, kept in the file.

The writer ends a file with an empty batch whose metadata has, per batch and
column, the least and greatest value and the number of nulls (any Arrow reader
sees one more batch without rows).  A reader with conditions skips the batches
that cannot hold a matching row.  Columns that cannot be ordered, batches with
NaN and texts over ``LONGEST`` bytes have no bounds and are never skipped.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc as ipc

MARK = b"feedloom.zones"  # in the schema's metadata: the last batch holds the zones
LONGEST = 256
_OPS: dict[str, Callable] = {}


def marked(schema: pa.Schema) -> pa.Schema:
    return schema.with_metadata({**(schema.metadata or {}), MARK: b"last"})


def _ordered(t: pa.DataType) -> bool:
    return (pa.types.is_integer(t) or pa.types.is_floating(t) or pa.types.is_decimal(t) or pa.types.is_temporal(t)
            or pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_boolean(t))


def zone(batch: pa.RecordBatch) -> dict[str, tuple]:
    """{column: (least, greatest, nulls)} of a batch, bounds as scalars."""
    out = {}
    for name, column in zip(batch.schema.names, batch.columns):
        low = high = pa.scalar(None, column.type)
        if _ordered(column.type) and len(column) > column.null_count and not (
                pa.types.is_floating(column.type) and pc.any(pc.is_nan(column)).as_py()):
            low, high = pc.min(column), pc.max(column)
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                if max(len(low.as_py().encode()), len(high.as_py().encode())) > LONGEST:
                    low = high = pa.scalar(None, column.type)
        out[name] = (low, high, column.null_count)
    return out


def write_zones(writer, schema: pa.Schema, zones: list[dict[str, tuple]], rows: list[int]) -> None:
    """End a file with the zones of its batches."""
    columns, names = [pa.array(rows, pa.int64())], ["rows"]
    for i, field in enumerate(schema):
        for j, part in enumerate(("low", "high")):
            columns.append(pa.array([z[field.name][j].as_py() for z in zones], field.type))
            names.append(f"{part}{i}")
        columns.append(pa.array([z[field.name][2] for z in zones], pa.int64()))
        names.append(f"nulls{i}")
    sink = pa.BufferOutputStream()
    table = pa.table(columns, names=names)
    with ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    empty = pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
    writer.write_batch(empty, custom_metadata={"zones": sink.getvalue().to_pybytes()})


def read_zones(reader) -> pa.Table | None:
    """The zones of an open file, one row a batch; None if it has none."""
    if MARK not in (reader.schema.metadata or {}) or reader.num_record_batches == 0:
        return None
    got = reader.get_batch_with_custom_metadata(reader.num_record_batches - 1)
    held = (got.custom_metadata or {}).get(b"zones")
    return ipc.open_stream(pa.py_buffer(held)).read_all() if held is not None else None


def _op(name: str):
    def keep(fn):
        _OPS[name] = fn
        return fn
    return keep


# Whether a batch can hold a row for which "column op value" is true.
@_op("=")
def _equal(low, high, nulls, rows, value):
    return low <= value <= high


@_op("in")
def _in(low, high, nulls, rows, values):
    return any(low <= v <= high for v in values if v is not None)


@_op(">")
def _greater(low, high, nulls, rows, value):
    return high > value


@_op(">=")
def _at_least(low, high, nulls, rows, value):
    return high >= value


@_op("<")
def _less(low, high, nulls, rows, value):
    return low < value


@_op("<=")
def _at_most(low, high, nulls, rows, value):
    return low <= value


@_op("starts")
def _starts(low, high, nulls, rows, value):
    return low[:len(value)] <= value <= high[:len(value)]


OPERATORS = (*_OPS, "is null", "is not null")


def possible(zones: pa.Table, names: list[str], conditions: list[tuple]) -> list[int]:
    """Batches that can hold a row for which all conditions (column, operator,
    value) are true; a value that cannot be compared skips nothing."""
    kept = list(range(zones.num_rows))
    rows = zones.column("rows").to_pylist()
    for column, op, value in conditions:
        if column not in names:
            continue
        i = names.index(column)
        low, high, nulls = (zones.column(f"{p}{i}").to_pylist() for p in ("low", "high", "nulls"))

        def can(b):
            if op == "is null":
                return nulls[b] > 0
            if nulls[b] == rows[b]:
                return False  # only nulls: no comparison is true
            if op == "is not null" or low[b] is None or value is None:
                return True
            try:
                return _OPS[op](low[b], high[b], nulls[b], rows[b], value)
            except TypeError:
                return True
        kept = [b for b in kept if can(b)]
    return kept
