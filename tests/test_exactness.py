"""Request identity, whole cells, exact streams and splittable hot keys."""

import json
import struct
import random

import pytest
from pyspark.sql import functions as F

from feedloom import api
from feedloom.functions.encode import float_text, param_text
from feedloom.operators.fetch import (
    as_capture, call_stats, enrich, fetch, infer_schema, pages_until_empty, parse_output, replay,
)
from feedloom.operators.requests import build_requests, cut_pages
from feedloom.session import fresh_dir
from feedloom.sinks import crm
from feedloom.sinks.json_array import json_rows
from feedloom.sources import arrow, datasets, fake, hub, quotes, sheets, weather


def echo(method, url, body, headers):
    return 200, json.dumps({"url": url, "method": method, "body": body}), None


def test_post_replies_are_matched_by_body(spark, tmp_out):
    params = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id int, name string")
    out = api.read(spark, "rest", input=params, url="http://h/x", transport=echo, land_to=tmp_out, schema="body string")
    got = sorted((r["id"], json.loads(r["output"]["body"])["id"]) for r in out.collect())
    assert got == [(1, 1), (2, 2), (2, 2), (3, 3)]


def test_methods_and_urls_are_part_of_the_key(spark):
    p = spark.createDataFrame([(1,)], "id int")
    keys = set()
    for method, url in (("POST", "http://h"), ("PUT", "http://h"), ("DELETE", "http://h"), ("GET", "http://h"), ("POST", "http://g")):
        req = build_requests(p, url, method=method)
        keys.add(as_capture(fetch(req, echo), "f").first()["key"])
    assert len(keys) == 5 and "http://h?id=1" in keys


def test_unparsable_bodies_are_errors(spark):
    df = spark.createDataFrame([('{"a": 1}', None), ("not json", None), (None, "timeout"), ("null", None)],
                               "response string, _corrupt_record string")
    got = [tuple(r) for r in parse_output(df, "a int").select("output.a", "_corrupt_record").collect()]
    assert got == [(1, None), (None, "response is not JSON: not json"), (None, "timeout"), (None, None)]
    assert call_stats(parse_output(df, "a int")).first()["failed_calls"] == 2


def test_schema_keeps_rare_odd_and_large(spark):
    rows = [('{"a": 1}',)] * 200 + [('{"VOID<": null, "a,b": {"OBJECT<x": 12345678901234567890}, "r": [{"q": 1.5}]}',)]
    df = spark.createDataFrame(rows, "response string")
    out = parse_output(df, infer_schema(df)).where("output.r is not null").first()["output"].asDict(True)
    assert str(out["a,b"]["OBJECT<x"]) == "12345678901234567890" and float(out["r"][0]["q"]) == 1.5 and "VOID<" in out
    assert infer_schema(spark.createDataFrame([(None,), ("x",)], "response string")) == "STRING"
    few = infer_schema(df, fraction=0.0001)
    assert "a" in few  # too small a sample: all bodies


def test_number_and_time_texts_are_pythons(spark):
    r = random.Random(2)
    xs = [0.0, -0.0, 1e7, 1e-4, 1e-5, 1e15, 1e16, 1.5e22, float("inf"), -float("inf"), float("nan"), 0.1, -2.5e-7, 123.0]
    xs += [r.uniform(-1, 1) * 10 ** r.randint(-8, 15) for _ in range(500)]
    xs += [struct.unpack("f", struct.pack("f", r.uniform(-9, 9)))[0] for _ in range(50)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    for row in df.select("i", float_text(F.col("x")).alias("t")).collect():
        assert row["t"] == str(xs[row["i"]])
    ts = spark.sql("select timestamp'2024-01-02 03:04:05.5' as t, timestamp'2024-01-02 03:04:05' as u, cast(0.1 as float) as f")
    got = ts.select(*[param_text(F.col(f.name), f.dataType) for f in ts.schema.fields]).first()
    assert tuple(got) == ("2024-01-02 03:04:05.500000", "2024-01-02 03:04:05", "0.10000000149011612")


def split_by_skew(df, spark):
    """Whether the final adaptive plan of a hot join split it."""
    df.write.format("noop").mode("overwrite").save()
    list(df.toLocalIterator())
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def low_skew(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_request_key_is_split(spark, low_skew):
    rows = spark.range(60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 10 != 0, F.lit(0)).otherwise(F.col("id")).cast("string").alias("k"))
    reqs = build_requests(rows, "http://h/{k}", method="GET", query_type="inline", param_columns=["k"])
    caps = spark.range(60000, numPartitions=8).select(
        F.lit("f").alias("feed"), F.concat(F.lit("http://h/"), F.col("id")).alias("key"), F.lit(200).alias("status"),
        F.col("id").cast("string").alias("body"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("timestamp").alias("fetched_at"))
    got = replay(reqs, caps)
    assert split_by_skew(got, spark) and got.where("_corrupt_record is null").count() == 60000


def test_hot_page_key_and_lookup_key_are_split(spark, low_skew, tmp_out):
    pages = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 10 != 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("page"),
        F.lit(True).alias("has_more"), F.lit(1).alias("n_items"))
    pages.write.parquet(tmp_out)
    kept = cut_pages(spark.read.parquet(tmp_out), ["k"])
    assert split_by_skew(kept, spark) and kept.count() == 60000
    out = enrich(spark.read.parquet(tmp_out), "k", lambda keys: keys.withColumn("v", F.col("k") * 2), ["v"])
    assert split_by_skew(out, spark) and out.count() == 60000


def test_pages_until_empty(spark, tmp_out):
    totals = {"a": 0, "b": 3, "c": 17}
    keys = spark.createDataFrame([(k,) for k in totals], "k string")

    def service(method, url, body, headers):
        k, page = url.split("/")[-2:]
        if k == "c" and page == "9":
            return 500, None, "broken"
        return 200, json.dumps([f"{k}{page}"] if int(page) <= totals[k] else []), None

    def call(pages):
        return fetch(build_requests(pages, "http://h/{k}/{page}", method="GET", query_type="inline"), service)

    items = F.size(F.from_json("response", "array<string>"))
    got = pages_until_empty(keys, call, items, tmp_out)
    assert sorted((r["k"], r["page"]) for r in got.where("response is not null").collect()) == \
        [("b", p) for p in (1, 2, 3)] + [("c", p) for p in range(1, 9)]
    assert [(r["k"], r["page"]) for r in got.where("_corrupt_record is not null").collect()] == [("c", 9)]


def test_pull_requests_are_complete(spark):
    def service(method, url, body, headers):
        page = int(url.partition("page=")[2] or 1)
        return 200, json.dumps([{"number": page * 10 + i, "title": "t"} for i in range(2)] if page <= 6 else []), None

    out = api.read(spark, "pull_requests", path="o/r", transport=service)
    assert sorted(r["id"] for r in out.collect()) == sorted(p * 10 + i for p in range(1, 7) for i in range(2))


def test_options_are_read_or_refused(spark, tmp_out):
    params = spark.createDataFrame([(7,)] * 3, "id int")
    with pytest.raises(ValueError, match="nonsense"):
        api.read(spark, "rest", input=params, url="http://h", transport=echo, nonsense="1")
    folder = fresh_dir(spark, "calls")

    def counted(method, url, body, headers):
        import os
        import uuid
        path = folder.removeprefix("file:")
        os.makedirs(path, exist_ok=True)
        open(f"{path}/{uuid.uuid4().hex}", "w").close()
        return 200, "{}", None

    import os
    out = api.read(spark, "rest", input=params, url="http://h/{id}", method="GET", queryType="inline", transport=counted,
                   callStrictlyOnce="Y", land_to=tmp_out)
    assert out.count() == 3 and len(os.listdir(folder.removeprefix("file:"))) == 1
    typed = api.read(spark, "rest", input=params, url="http://h", transport=echo, land_to=tmp_out, schemaSamplePcnt="100")
    assert typed.first()["output"]["method"] == "POST"


def test_ragged_rows_are_errors(spark, tmp_out):
    for line in ("1,2,3", "4"):
        lines = spark.createDataFrame([(0, "a,b"), (1, line)], "n int, line string")
        with pytest.raises(Exception, match="expected 2 cells"):
            sheets.sheet_from_lines(lines).collect()
    spark.createDataFrame([("a,b\n1,2\n3,4,5\n",)], "v string").coalesce(1).write.text(f"{tmp_out}/o/n/f.csv")
    with pytest.raises(Exception, match="(?i)malformed"):
        datasets.read_file(spark, tmp_out, "o/n", "f.csv", schema="a int, b int").collect()


def test_line_breaks_in_quoted_cells(spark):
    body = 'n,t\r\n1,"x\ny, ""z"""\n\n2,w'
    lines = spark.createDataFrame([(body,)], "b string").select(F.posexplode(sheets.record_lines(F.col("b"))).alias("n", "line"))
    got = sheets.sheet_from_lines(lines.where("line <> ''"), schema="n int, t string").collect()
    assert [tuple(r) for r in got] == [(1, 'x\ny, "z"'), (2, "w")]


def test_arrow_globs_columns_and_schemas(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.ipc as ipc

    def write(path, table):
        path.parent.mkdir(parents=True, exist_ok=True)
        with ipc.new_file(str(path), table.schema) as w:
            w.write_table(table)

    write(tmp_path / "d1" / "a.arrow", pa.table({"x": [1, 2], "y": ["p", "q"]}))
    write(tmp_path / "d1" / "sub" / "b.arrow", pa.table({"x": [9], "y": ["s"]}))
    write(tmp_path / "d2" / "c.arrow", pa.table({"x": [3], "y": ["r"]}))
    assert sorted(r["x"] for r in arrow.read_arrow(spark, f"{tmp_path}/d1/*.arrow").collect()) == [1, 2]
    assert sorted(r["x"] for r in arrow.read_arrow(spark, f"{tmp_path}/d?/*.arrow").collect()) == [1, 2, 3]
    assert arrow.read_arrow(spark, f"{tmp_path}/d1", ["y"]).columns == ["y"]
    assert sorted(r["y"] for r in arrow.read_arrow(spark, f"{tmp_path}/*/*.arrow", ["y"]).collect()) == ["p", "q", "r"]
    with pytest.raises(Exception, match="no columns"):
        arrow.read_arrow(spark, f"{tmp_path}/d1", ["z"]).collect()
    write(tmp_path / "d1" / "z.arrow", pa.table({"x": [4], "y": ["t"], "more": [1]}))
    with pytest.raises(Exception, match="more"):
        arrow.read_arrow(spark, f"{tmp_path}/d1").collect()
    with pytest.raises(ValueError, match="has columns"):
        arrow.append_arrow(spark.createDataFrame([(1,)], "x int"), f"{tmp_path}/d2")


def test_store_names_of_hadoop():
    assert arrow.store_uri("s3a://bucket/a/b.arrow") == "s3://bucket/a/b.arrow"
    assert arrow.store_uri("hdfs://name/a") == "hdfs://name/a"


def test_hub_files_with_different_columns(spark, tmp_out):
    base = f"{tmp_out}/ds/default/train"
    spark.createDataFrame([(1,)], "a int").write.parquet(base)
    spark.createDataFrame([(2, "z")], "a int, z string").write.mode("append").parquet(base)
    got = [(r["a"], r["z"]) for r in hub.read_split(spark, tmp_out, "ds").collect()]
    assert sorted(got, key=str) == [("1", None), ("2", "z")]


def test_failed_quotes_are_listed(spark):
    df = spark.createDataFrame([("A", '{"results": [{"price": "1"}]}'), ("B", '{"detail": "throttled"}'), ("C", None),
                                ("D", "oops"), ("E", '{"results": []}')], "symbol string, body string")
    assert {r["symbol"]: r["error"] for r in quotes.errors(df).collect()} == {
        "B": "throttled", "C": "no response", "D": "response is not JSON", "E": "results are empty"}


def test_marks_of_null_places(spark):
    rows = spark.createDataFrame([(None, 1.0, "{}", "2024-01-02"), (2.0, 1.0, "{}", "2024-01-02")],
                                 "latitude double, longitude double, weather string, timestamp string")
    marks = spark.createDataFrame([(None, 1.0, "2024-01-01")], "latitude double, longitude double, mark string")
    new = weather.advance_marks(rows, marks, "2023")
    assert sorted(((r["latitude"], r["mark"]) for r in new.collect()), key=str) == [(2.0, "2024-01-02"), (None, "2024-01-02")]
    assert [r["latitude"] for r in weather.increment(rows, new, "2023").collect()] == []


def test_json_times_at_every_depth(spark):
    df = spark.sql("""select timestamp'2024-01-01 00:00:00' as t, named_struct('t', timestamp'2024-01-01 00:00:00', 'n', 1) as s,
                      array(date'2024-01-02') as a, map('k', timestamp'2024-01-01 00:00:00.5') as m,
                      cast(null as struct<t: timestamp>) as z""")
    got = json.loads(json_rows(df).first()[0])
    assert got == {"t": "2024-01-01T00:00:00", "s": {"t": "2024-01-01T00:00:00", "n": 1}, "a": ["2024-01-02"],
                   "m": {"k": "2024-01-01T00:00:00.500000"}, "z": None}


def test_large_ids_do_not_overflow(spark):
    df = spark.createDataFrame([(1 << 60,), ((1 << 63) - 1,)], "v long")
    st = fake.check_schema(fake.DEFAULT_SCHEMA)
    assert df.select(*fake.fake_columns(F.col("v"), st, 3)).count() == 2
    assert len(df.select(*fake.fake_columns(F.col("v"), st, 3)).collect()) == 2


def tree(object_type, payload):
    recs = json.loads(payload)["records"]
    if any(r["v"] == "boom" for r in recs):
        raise ConnectionError("down")
    results = [{"referenceId": r["attributes"]["referenceId"], **({"id": "x"} if r["v"] != "bad" else
               {"errors": [{"statusCode": "E", "message": "no"}]})} for r in recs]
    return json.dumps({"hasErrors": any("errors" in r for r in results), "results": results})


def test_delivery_accounts_for_every_record(spark, tmp_out):
    ledger = f"{tmp_out}/ledger"
    recs = spark.createDataFrame([("1", "ok"), ("2", "bad"), ("3", "ok"), ("3", "ok"), ("4", "boom"), (None, "ok")], "k string, v string")
    crm.deliver_batch(recs, 0, "k", tree, ledger, schema="v string", batch_size=3)
    keys = lambda df: sorted(str(r["key"]) for r in df.collect())
    assert keys(crm.accepted(spark, ledger)) == ["1", "3", "None"]
    assert keys(spark.read.parquet(f"{ledger}_rejected")) == ["2"] and keys(crm.undelivered(spark, ledger)) == ["4"]
    crm.deliver_batch(recs, 0, "k", tree, ledger, schema="v string", batch_size=3)  # a retried batch
    assert keys(crm.accepted(spark, ledger)) == ["1", "3", "None"]
    crm.deliver_batch(recs.where("k = '1'"), 1, "k", tree, ledger, schema="v string")
    assert keys(crm.accepted(spark, ledger)) == ["1", "3", "None"]
    assert crm.resend(spark, ledger, tree) == 1 and keys(crm.undelivered(spark, ledger)) == ["4"]  # still down
    up = lambda o, p: tree(o, p.replace("boom", "ok"))
    assert crm.resend(spark, ledger, up) == 1 and keys(crm.accepted(spark, ledger)) == ["1", "3", "4", "None"]
    assert crm.resend(spark, ledger, up) == 0
