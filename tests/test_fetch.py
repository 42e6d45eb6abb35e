"""Live call stage with injected transports, errors, inference, accounting."""

import pytest
from pyspark.sql import functions as F

from feedloom.operators.fetch import (
    call_once, call_stats, explode_output, fail_on_error, fetch, infer_schema, parse_output,
    select_output,
)
from feedloom.operators.requests import build_requests


def transport(method, url, body, headers):
    if url.endswith("boom"):
        raise TimeoutError("read timed out")
    if url.endswith("text"):
        return 200, "plain text", None
    return 200, '{"ok": true, "n": 2}', None


def test_fetch_errors_become_rows(spark):
    params = spark.createDataFrame([("ok",), ("boom",), ("text",)], "p string")
    req = build_requests(params, "http://h/{p}", method="GET", query_type="inline")
    out = fetch(req, transport, partitions=2)
    rows = {r.p: (r.status, r.response, r._corrupt_record) for r in out.collect()}
    assert rows["ok"] == (200, '{"ok": true, "n": 2}', None)
    assert rows["boom"][2].startswith("TimeoutError")
    assert rows["text"][1] == "plain text"
    stats = call_stats(out).first()
    assert (stats.total_calls, stats.failed_calls, stats.success_pct) == (3, 1, 66.67)
    only = select_output(parse_output(out), include_inputs=False)
    assert only.columns == ["output", "_corrupt_record"]
    with pytest.raises(Exception, match="request failed"):
        fail_on_error(out).collect()
    assert fail_on_error(out, enabled=False).count() == 3


def test_infer_schema_and_parse(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2.5}',), ("junk",)], "response string")
    schema = infer_schema(df, fraction=1.0)
    assert schema == "STRUCT<a: DECIMAL(21,1), b: STRING>"
    got = parse_output(df, schema).select("output.a").collect()
    assert [r.a for r in got] == [1.0, 2.5, None]


def test_object_or_array_bodies(spark):
    df = spark.createDataFrame([('[{"x": 1}, {"x": 2}]',), ('{"x": 3}',), ("[]",)], "response string")
    got = explode_output(df, "x int").select("output.x").collect()
    assert sorted((r.x for r in got), key=lambda v: (v is None, v)) == [1, 2, 3, None]


def test_call_once_per_distinct_input(spark):
    params = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "u long")
    calls = []

    def lookup(distinct):
        calls.append(distinct.count())
        return distinct.withColumn("v", F.col("u") * 10)

    out = call_once(params, ["u"], lookup, ["v"]).collect()
    assert calls == [3]
    assert sorted((r.u, r.v) for r in out if r.u is not None) == [(1, 10), (1, 10), (2, 20)]
    assert [r.v for r in out if r.u is None] == [None, None]


def test_fetch_concurrency_keeps_row_order(spark):
    import time

    def slow(method, url, body, headers):
        time.sleep(0.01)
        return 200, url.rsplit("/", 1)[1], None

    params = spark.range(200).select(F.col("id").cast("string").alias("p")).coalesce(1)
    req = build_requests(params, "http://h/{p}", method="GET", query_type="inline")
    got = fetch(req, slow, concurrency=16).collect()
    assert [r.response for r in got] == [r.p for r in got]
    assert len(got) == 200
    with pytest.raises(ValueError):
        fetch(req, slow, concurrency=0)
