"""Zone maps of Arrow files: which batches are read, and that no row is lost."""

import datetime
import decimal
import os

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.session import ensure_dir, local_path
from feedloom.sources import arrow, zones

values = st.lists(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=6), min_size=1, max_size=8)


def _file(batches, schema):
    sink = pa.BufferOutputStream()
    with ipc.new_file(sink, zones.marked(schema)) as out:
        held = [pa.RecordBatch.from_arrays([pa.array(b, schema.field(0).type)], schema=schema) for b in batches]
        for b in held:
            out.write_batch(b.cast(zones.marked(schema)))
        zones.write_zones(out, zones.marked(schema), [zones.zone(b) for b in held], [len(b) for b in held])
    return ipc.open_file(sink.getvalue())


def _true(op, x, v):
    if op == "is null":
        return x is None
    if x is None:
        return False
    return {"=": lambda: x == v, ">": lambda: x > v, ">=": lambda: x >= v, "<": lambda: x < v, "<=": lambda: x <= v,
            "in": lambda: x in v, "starts": lambda: x.startswith(v), "is not null": lambda: True}[op]()


@settings(max_examples=200, deadline=None)
@given(values, st.sampled_from([o for o in zones.OPERATORS if o != "starts"]), st.integers(-6, 6))
def test_skipped_batches_hold_no_match(batches, op, v):
    v = [v, v + 2] if op == "in" else v
    for kind, make in ((pa.int64(), lambda x: x), (pa.string(), lambda x: None if x is None else chr(x + 100) * 3),
                       (pa.decimal128(9, 2), lambda x: None if x is None else decimal.Decimal(x)),
                       (pa.date32(), lambda x: None if x is None else datetime.date(2024, 1, 10 + x))):
        own = [make(x) for x in v] if op == "in" else make(v)
        data = [[make(x) for x in b] for b in batches]
        reader = _file(data, pa.schema([("c", kind)]))
        kept = zones.possible(zones.read_zones(reader), ["c"], [("c", op, own)])
        for i, b in enumerate(data):
            assert i in kept or not any(_true(op, x, own) for x in b)
        if op == "=":
            assert all(min(x for x in data[i] if x is not None) <= own for i in kept)
    texts = [[None if x is None else f"{'abcdefghijkl'[x + 5]}{x}" for x in b] for b in batches]
    kept = zones.possible(zones.read_zones(_file(texts, pa.schema([("c", pa.string())]))), ["c"], [("c", "starts", "e")])
    assert all(i in kept or not any(x and x.startswith("e") for x in b) for i, b in enumerate(texts))


def test_columns_without_bounds_are_never_skipped():
    for kind, data in ((pa.float64(), [[float("nan"), 1.0]]), (pa.string(), [["x" * 1000]]), (pa.list_(pa.int64()), [[[1]]]),
                       (pa.binary(), [[b"a"]])):
        z = zones.read_zones(_file(data, pa.schema([("c", kind)])))
        assert zones.possible(z, ["c"], [("c", ">", 99)]) == [0]
        assert zones.possible(z, ["c"], [("other", "=", 1)]) == [0] and zones.possible(z, ["c"], [("c", "=", None)]) == [0]
    assert zones.possible(zones.read_zones(_file([[1]], pa.schema([("c", pa.int64())]))), ["c"], [("c", "=", "text")]) == [0]


def _read_batches(reader):
    return sum(len(s.kept) if s.kept is not None else s.last - s.first for s in reader.partitions())


def test_few_batches_are_read_and_spark_pushes_its_own_conditions(spark, tmp_out):
    df = spark.range(0, 20000, 1, 2).select("id", (F.col("id") % 7).alias("r"), F.concat(F.lit("n"), "id").alias("t"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        arrow.append_arrow(df, tmp_out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    every = arrow.ArrowFilesReader(tmp_out, df.schema)
    assert _read_batches(every) >= 40
    some = arrow.ArrowFilesReader(tmp_out, df.schema, conditions=[("id", ">=", 600), ("id", "<", 1100)])
    assert _read_batches(some) == 2
    got = arrow.read_arrow(spark, tmp_out, where=[("id", ">=", 600), ("id", "<", 1100), ("t", "starts", "n7")])
    assert sorted(r["id"] for r in got.collect()) == list(range(700, 800))
    assert got.rdd.getNumPartitions() < arrow.read_arrow(spark, tmp_out).rdd.getNumPartitions() + 1
    spark.conf.set(arrow.PUSHDOWN, "true")
    try:
        pushed = arrow.read_arrow(spark, tmp_out).where((F.col("id") == 777) & (F.col("r") == 0))
        assert [r["t"] for r in pushed.collect()] == ["n777"]
        reader = arrow.PushingReader(tmp_out, df.schema)
        from pyspark.sql.datasource import EqualTo, IsNotNull
        asked = [IsNotNull(("id",)), EqualTo(("id",), 777)]
        assert list(reader.pushFilters(asked)) == asked and _read_batches(reader) == 1
    finally:
        spark.conf.unset(arrow.PUSHDOWN)
    with pytest.raises(ValueError, match="operators"):
        arrow.read_arrow(spark, tmp_out, where=[("id", "~", 1)])
    assert arrow.read_arrow(spark, tmp_out).count() == 20000


def test_a_file_without_a_column_is_an_error_unless_asked_for(spark, tmp_out):
    folder = local_path(ensure_dir(tmp_out + "/d"))
    for name, t in (("a.arrow", pa.table({"x": [1], "y": ["p"]})), ("b.arrow", pa.table({"x": [2]}))):
        with pa.OSFile(os.path.join(folder, name), "wb") as f, ipc.new_file(f, t.schema) as w:
            w.write_table(t)
    with pytest.raises(Exception, match="lacks the columns"):
        arrow.read_arrow(spark, folder).collect()
    got = arrow.read_arrow(spark, folder, missing="null").collect()
    assert sorted((r["x"], r["y"]) for r in got) == [(1, "p"), (2, None)]
    with pytest.raises(Exception, match="missing"):
        arrow.read_arrow(spark, folder, missing="drop").collect()
