"""File sources and sinks: sheets, hub, dataset files, Arrow, JSON arrays."""

import json
import os

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from pyspark.sql import functions as F

from feedloom.session import ensure_dir, local_path
from feedloom.sinks import json_array
from feedloom.sources import arrow, datasets, fake, hub, sheets


def _lines(spark, *lines):
    return spark.createDataFrame([(l, i) for i, l in enumerate(lines)], "line string, n long")


def test_header_naming():
    assert sheets.header_names(["a", "a", "", "b", "a"]) == ["a", "a.1", "Unnamed: 2", "b", "a.2"]
    assert sheets.header_names(["Unnamed: 1", "", " "]) == ["Unnamed: 1", "Unnamed: 1.1", " "]
    assert sheets.header_names(["a", "", "Unnamed: 1"]) == ["a", "Unnamed: 1.1", "Unnamed: 1"]
    assert sheets.header_names(["num", "1", "", "x"])[2] == "Unnamed: 2"


def test_sheet_header_and_schema(spark):
    df = sheets.sheet_from_lines(_lines(spark, "num,name", "1,Alice", "2,Bob"))
    assert df.columns == ["num", "name"] and df.count() == 2
    typed = sheets.sheet_from_lines(_lines(spark, "x,y", "1.5,a", "2,b"), schema="a double, b string")
    assert [tuple(r) for r in typed.collect()] == [(1.5, "a"), (2.0, "b")]
    no_head = sheets.sheet_from_lines(_lines(spark, "1,2,3", "4,5,6"), has_header=False,
                                      schema="a int, b int, c int")
    assert no_head.count() == 2


def test_sheet_errors(spark):
    with pytest.raises(ValueError, match="CSV parse error"):
        sheets.sheet_from_lines(_lines(spark, "x,y", "1,2"), schema="a double")
    with pytest.raises(ValueError, match="empty"):
        sheets.sheet_from_lines(spark.createDataFrame([], "line string, n long"))
    with pytest.raises(ValueError, match="give a schema"):
        sheets.sheet_from_lines(_lines(spark, "1,2"), has_header=False)


def test_sheet_locator(spark):
    df = spark.createDataFrame([("https://docs.google.com/spreadsheets/d/ID1/edit?gid=7#gid=9",),
                                ("https://example.com/spreadsheets/d/ID2",)], "u string")
    got = df.select(sheets.locate(F.col("u")).alias("l")).select("l.*").collect()
    assert tuple(got[0]) == ("ID1", "7", None)
    assert tuple(got[1]) == (None, None, sheets.NOT_A_SHEET)


def _ipc_file(path, table, batch=2):
    with pa.OSFile(path, "wb") as f:
        with ipc.new_file(f, table.schema) as w:
            for b in table.to_batches(max_chunksize=batch):
                w.write_batch(b)


def test_arrow_single_file_and_directory(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out))
    t = pa.table({"id": [1, 2, 3], "name": ["Alice", "Bob", "Cy"], "age": [30, 40, 50]})
    _ipc_file(os.path.join(d, "people.arrow"), t)
    df = arrow.read_arrow(spark, os.path.join(d, "people.arrow"))
    assert df.count() == 3 and len(df.columns) == 3
    assert df.orderBy("id").first().name == "Alice"
    d2 = os.path.join(d, "dir")
    os.makedirs(d2)
    for i in range(2):
        _ipc_file(os.path.join(d2, f"part{i}.arrow"),
                  pa.table({"id": [i * 2, i * 2 + 1], "name": ["a", "b"], "department": ["x", "y"]}))
    df2 = arrow.read_arrow(spark, d2)
    assert df2.count() == 4 and df2.rdd.getNumPartitions() == 2
    assert arrow.read_arrow(spark, os.path.join(d2, "*.arrow")).count() == 4
    with pytest.raises(Exception, match="No Arrow files"):
        arrow.read_arrow(spark, os.path.join(d, "nothing-*.arrow")).count()


def test_arrow_dataset_append_only(spark, tmp_out):
    df = spark.range(10).withColumn("s", F.col("id").cast("string"))
    arrow.append_arrow(df, tmp_out)
    arrow.append_arrow(df, tmp_out)
    assert arrow.read_arrow(spark, tmp_out).count() == 20
    with pytest.raises(Exception, match="append only"):
        df.write.format("arrowdataset").mode("overwrite").save(tmp_out)


def test_json_sink_overwrite_and_dates(spark, tmp_out):
    df = spark.createDataFrame([(1, "2024-01-02")], "id int, d string").withColumn("d", F.to_date("d"))
    json_array.write_json_array(df, tmp_out)
    json_array.write_json_array(spark.range(3).repartition(2), tmp_out, mode="overwrite")
    back = json_array.read_json_array(spark, tmp_out)
    assert sorted(r.id for r in back.collect()) == [0, 1, 2]
    assert os.path.exists(os.path.join(local_path(tmp_out), "_SUCCESS"))
    out2 = tmp_out + "-dates"
    json_array.write_json_array(df.coalesce(1), out2)
    files = [f for f in os.listdir(local_path(out2)) if f.endswith(".json")]
    text = open(os.path.join(local_path(out2), files[0])).read()
    assert json.loads(text) == [{"id": 1, "d": "2024-01-02"}]


def test_dataset_handles(spark, tmp_out):
    with pytest.raises(ValueError):
        datasets.resolve(tmp_out, "onlyowner")
    with pytest.raises(ValueError):
        datasets.check_credentials("u", None)
    folder = datasets.resolve(tmp_out, "o/s/versions/1")
    spark.createDataFrame([(1, 2.5, "a")], "a int, b double, c string").write.option("header", True) \
        .csv(folder + "/t.csv")
    df = datasets.read_file(spark, tmp_out, "o/s/versions/1", "t.csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string"]


def test_hub_missing_column(spark, tmp_out):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(hub.split_path(tmp_out, "ds", "train"))
    got = hub.read_split(spark, tmp_out, "ds", columns=["a", "zz"]).first()
    assert tuple(got) == ("1", None)
    typed = hub.read_split(spark, tmp_out, "ds", columns="a long, zz int").first()
    assert tuple(typed) == (1, None)


def test_fake_rows(spark):
    df = fake.fake(spark)
    assert df.count() == 3 and df.columns == ["name", "date", "zipcode", "state"]
    assert df.collect() == fake.fake(spark, partitions=3).collect()
    assert fake.fake(spark, 1000, partitions=4).rdd.getNumPartitions() == 4
    with pytest.raises(ValueError):
        fake.check_schema("nonsense string")
    with pytest.raises(ValueError):
        fake.check_schema("name int")


def test_json_sink_abort_leaves_nothing(spark, tmp_out):
    bad = spark.range(0, 20, 1, 4).select(
        "id", F.when(F.col("id") == 17, F.raise_error(F.lit("boom"))).alias("x"))
    with pytest.raises(Exception):
        json_array.write_json_array(bad, tmp_out)
    left = []
    for root, _dirs, files in os.walk(local_path(tmp_out)):
        left += [f for f in files if f.endswith(".json")]
    assert left == []


def test_placeholder_id_and_limit(spark):
    from feedloom.sources import placeholder
    df = spark.range(1, 11).select(F.col("id").cast("int").alias("id"))
    assert [r.id for r in placeholder.select_items(df, item_id=3, limit=5).collect()] == [3]
    assert [r.id for r in placeholder.select_items(df, limit=2).collect()] == [1, 2]


def test_arrow_dataset_abort_leaves_nothing(spark, tmp_out):
    bad = spark.range(0, 20, 1, 4).select(
        "id", F.when(F.col("id") == 17, F.raise_error(F.lit("boom"))).alias("x"))
    with pytest.raises(Exception):
        arrow.append_arrow(bad, tmp_out)
    left = []
    for root, _dirs, files in os.walk(local_path(tmp_out)):
        left += [f for f in files if f.endswith(".arrow")]
    assert left == []


def test_json_sink_direct_format_python_path(spark, tmp_out):
    json_array.register(spark)
    df = spark.createDataFrame([(1, None)], "id int, s string").coalesce(1)
    df.write.format("jsonarray").mode("append").save(tmp_out)
    files = [f for f in os.listdir(local_path(tmp_out)) if f.endswith(".json")]
    assert json.loads(open(os.path.join(local_path(tmp_out), files[0])).read()) == [{"id": 1, "s": None}]


def test_arrow_splits_follow_partition_bytes(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out))
    t = pa.table({"id": list(range(1000)), "s": ["x" * 50] * 1000})
    _ipc_file(os.path.join(d, "big.arrow"), t, batch=100)
    arrow.register(spark)
    one = spark.read.format("arrowfiles").load(os.path.join(d, "big.arrow"))
    assert one.rdd.getNumPartitions() == 1 and one.count() == 1000
    many = spark.read.format("arrowfiles").option("maxPartitionBytes", 20000).load(os.path.join(d, "big.arrow"))
    assert many.rdd.getNumPartitions() > 1 and many.count() == 1000
    assert sorted(r.id for r in many.select("id").collect()) == list(range(1000))


def test_arrow_glob_skips_staging(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out))
    os.makedirs(os.path.join(d, "_staging", "job"))
    t = pa.table({"id": [1, 2]})
    _ipc_file(os.path.join(d, "a.arrow"), t)
    _ipc_file(os.path.join(d, "_staging", "job", "b.arrow"), t)
    _ipc_file(os.path.join(d, ".hidden.arrow"), t)
    assert arrow.list_files(os.path.join(d, "*.arrow")) == [os.path.join(d, "a.arrow")]
    assert arrow.list_files(d) == [os.path.join(d, "a.arrow")]


def test_arrow_stream_format_file(spark, tmp_out):
    d = local_path(ensure_dir(tmp_out))
    t = pa.table({"id": list(range(10)), "name": ["n"] * 10})
    with pa.OSFile(os.path.join(d, "s.arrow"), "wb") as f:
        with ipc.new_stream(f, t.schema) as w:
            for b in t.to_batches(max_chunksize=3):
                w.write_batch(b)
    df = arrow.read_arrow(spark, os.path.join(d, "s.arrow"))
    assert df.count() == 10 and df.columns == ["id", "name"]


URLS = ["https://docs.google.com/spreadsheets/d/ID/edit?gid=1",
        "https://docs.google.com/spreadsheets/d/ID/edit?gid=1&gid=2",
        "https://docs.google.com/spreadsheets/d/ID/edit?gid=%31",
        "https://docs.google.com/spreadsheets/d/ID/edit#gid=3",
        "https://docs.google.com:443/spreadsheets/d/ID/edit",
        "https://u@docs.google.com/spreadsheets/d/ID/edit",
        "https://docs.google.com/spreadsheets/d/",
        "https://docs.google.com/spreadsheets/d/ID/edit?usp=sharing&gid=",
        "https://docs.google.com/spreadsheets/d/ID/edit?gid",
        "docs.google.com/spreadsheets/d/ID",
        "https://docs.google.com/spreadsheets/d/a b/edit",
        "https://docs.google.com/spreadsheets/d/ID/edit?gid=1+2",
        "https://docs.google.com/spreadsheets/d/ID/edit?x=1;gid=5",
        "https://example.com/spreadsheets/d/ID"]


def test_locator_follows_urlparse(spark):
    from urllib.parse import parse_qs, urlparse

    def expected(url):
        p = urlparse(url)
        if p.netloc != "docs.google.com" or not p.path.startswith("/spreadsheets/d/"):
            return (None, None, True)
        qs = parse_qs(p.query)
        return (p.path.split("/")[3], qs["gid"][0] if "gid" in qs else None, False)

    df = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", sheets.locate(F.col("u")).alias("l"))
    for r in df.collect():
        assert (r.l.spreadsheet_id, r.l.sheet_id, r.l.error is not None) == expected(r.u), r.u


def test_sinks_round_trip(spark):
    import datetime

    from hypothesis import given, settings
    from hypothesis import strategies as st

    from feedloom.session import fresh_dir

    row = st.tuples(st.integers(0, 10**6), st.one_of(st.none(), st.text(max_size=10)),
                    st.one_of(st.none(), st.floats(-1e9, 1e9, allow_nan=False)),
                    st.one_of(st.none(), st.booleans()),
                    st.one_of(st.none(), st.dates(datetime.date(1970, 1, 1), datetime.date(2100, 1, 1))))
    schema = "id long, s string, f double, b boolean, d date"

    @settings(max_examples=4, deadline=None)
    @given(st.lists(row, min_size=1, max_size=30))
    def check(rows):
        df = spark.createDataFrame(rows, schema).repartition(3)
        want = sorted(rows, key=repr)
        a = fresh_dir(spark, "tests", "rt-arrow")
        arrow.append_arrow(df, a)
        assert sorted((tuple(r) for r in arrow.read_arrow(spark, a).collect()), key=repr) == want
        j = fresh_dir(spark, "tests", "rt-json")
        json_array.write_json_array(df, j)
        back = json_array.read_json_array(spark, j, "id long, s string, f double, b boolean, d string")
        got = sorted(((r.id, r.s, r.f, r.b, datetime.date.fromisoformat(r.d) if r.d else None)
                      for r in back.collect()), key=repr)
        assert got == want

    check()


def test_sheet_lines_rfc4180_quotes(spark):
    lines = _lines(spark, "a,b,c", '"he said ""hi"", ok",2,"x\\\\y"')
    r = sheets.sheet_from_lines(lines).first()
    assert tuple(r) == ('he said "hi", ok', "2", "x\\\\y")


def test_quoted_exports_are_bounded(spark, tmp_out, monkeypatch):
    """All customers in one nation: no exported body has more than a header and 64 records."""
    from feedloom.plans import q_files
    (spark.range(1, 1001).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "'M' AS c_mktsegment",
                                     "7 AS c_nationkey").write.parquet(f"{tmp_out}/customer.parquet"))
    got = q_files.sheets_quoted(spark, tmp_out).collect()
    assert sorted((r["id"], r["note"]) for r in got) == [(i, f'C{i}\n"M", 7') for i in range(1, 1001)]
    monkeypatch.setattr(q_files.sheets, "sheet_from_lines", lambda rows, **options: rows)
    assert q_files.sheets_quoted(spark, tmp_out).agg({"n": "max"}).first()[0] <= 64
