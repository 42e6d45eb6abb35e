"""Which reply belongs to which request: headers, repeats, newest captures, pages, types, time-outs."""

import json
import re

import pytest
from pyspark.sql import functions as F

from feedloom import api
from feedloom.operators import fetch as fx
from feedloom.operators.requests import build_requests, spread_by_index
from feedloom.session import fresh_dir

CAPTURE = "feed string, key string, status int, body string, error string, fetched_at timestamp"


def test_newest_captures_are_found_without_their_bodies(spark):
    path = fresh_dir(spark, "captures")
    rows = spark.range(600).select(
        F.lit("f").alias("feed"), F.format_string("http://h/%d", F.col("id") % 100).alias("key"), F.lit(200).alias("status"),
        F.format_string("body %d", "id").alias("body"), F.lit(None).cast("string").alias("error"),
        F.when(F.col("id") % 100 < 90, F.timestamp_seconds(F.col("id") % 500)).alias("fetched_at"))
    rows.repartition(4).write.parquet(path)
    caps = spark.read.parquet(path)
    places = fx.latest_places(fx._placed(caps))
    plan = places._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if re.search("Sort|Aggregate|Exchange", line):
            assert "body" not in line, line
    req = build_requests(spark.range(120).select((F.col("id") % 110).alias("id")), "http://h/{id}", method="GET", query_type="inline")
    got = {(r["id"], r["response"], r["_corrupt_record"]) for r in fx.replay(req, caps, feed="f").collect()}
    assert len(got) == 110 and fx.replay(req, caps).count() == 120
    whole = fx.replay(req, caps.select("*").distinct())  # no longer straight from files
    assert fx._placed(caps.distinct()) is None
    timed = {(i, b, e) for i, b, e in got if i < 90}
    assert timed == {(r["id"], r["response"], r["_corrupt_record"]) for r in whole.collect() if r["id"] < 90}
    assert {(i, b) for i, b, _ in timed} == {(i, f"body {i + 400}") for i in range(90)}
    assert {b for i, b, _ in got if 90 <= i < 100} <= {f"body {i}" for i in range(600)}
    assert {(b, e) for i, b, e in got if i >= 100} == {(None, "not captured")}


def test_places_outlive_a_hot_key_and_nulls(spark):
    path = fresh_dir(spark, "captures")
    spark.createDataFrame([("f", "http://h/1", 200, "old", None, None), ("f", None, 200, "lost", None, None)], CAPTURE).write.parquet(path)
    req = build_requests(spark.range(5000).select(F.lit(1).alias("id")), "http://h/{id}", method="GET", query_type="inline")
    assert {r["response"] for r in fx.replay(req, spark.read.parquet(path)).collect()} == {"old"}


def by_header(method, url, body, headers):
    return 200, json.dumps((headers or {}).get("Accept")), None


def test_headers_tell_requests_apart(spark):
    ids = spark.range(20)
    reqs = [build_requests(ids, "http://h/{id}", method="GET", query_type="inline", headers=h)
            for h in ('{"Accept": "a", "X": "1"}', '{"X": "1", "Accept": "b"}', None)]
    for landed in (fx.land_once, fx.land_each):
        every = reqs[0].unionByName(reqs[1]).unionByName(reqs[2])
        caps = landed(fx.fetch(every, by_header), "f", fresh_dir(spark, "captures"))
        for req, want in zip(reqs, ("a", "b", None)):
            for latest in (True, False):
                got = {json.loads(r["response"]) for r in fx.replay(req, caps, latest=latest).collect()}
                assert got == {want}


def creating(method, url, body, headers):
    import uuid
    return 201, json.dumps({"id": uuid.uuid4().hex}), None


def test_equal_calls_keep_their_own_replies(spark):
    params = spark.createDataFrame([("x",)] * 30 + [("y",)] * 5, "name string")
    req = build_requests(params, "http://h", method="POST")
    caps = fx.land_each(fx.fetch(req, creating), "f", fresh_dir(spark, "captures"))
    got = [r["response"] for r in fx.replay(req, caps, latest=False).collect()]
    assert len(got) == len(set(got)) == 35
    out = api.read(spark, "rest", input=params, url="http://h", method="POST", transport=creating,
                   land_to=fresh_dir(spark, "calls"), schema="id string")
    for _ in range(2):  # read twice: called once
        assert out.select("output.id").distinct().count() == 35
    assert out.columns == ["name", "output", "_corrupt_record"]


@pytest.mark.parametrize("schema, body, want", [
    ("a bigint", "[1,2]", None), ("a bigint", '{"a":"x"}', None), ("a bigint", '{"a":1}', (1,)), ("a bigint", "{}", (None,)),
    ("a bigint", '{"a":null,"z":[]}', (None,)), ("a bigint", "7", None), ("n struct<z: int>, l array<int>", '{"l":[1,"x"]}', None),
    ("n struct<z: int>, l array<int>", '{"n":{"z":2},"l":[1]}', ((2,), [1])), ("array<struct<a: int>>", '{"a":3}', [(3,)]),
    ("array<struct<a: int>>", '[{"a":3},{"a":"3"}]', None), ("array<int>", "[1, 2]", [1, 2]), ("array<int>", '{"a":1}', None),
    ("map<string,int>", '{"a":1}', {"a": 1}), ("map<string,int>", '{"a":"b"}', None)])
def test_bodies_that_do_not_fit_are_errors(spark, schema, body, want):
    r = fx.parse_output(spark.createDataFrame([(body, None)], "response string, _corrupt_record string"), schema).first()
    assert r["output"] == want
    assert r["_corrupt_record"] == (None if want is not None else "response does not fit the schema: " + body)


def test_types_of_earlier_errors_stay(spark):
    rows = spark.createDataFrame([(None, "gone"), ("<p>", None), ("[1]", "first")], "response string, _corrupt_record string")
    assert [(r["output"], r["_corrupt_record"]) for r in fx.parse_output(rows, "a int").collect()] == \
        [(None, "gone"), (None, "response is not JSON: <p>"), (None, "first")]


def test_pages_of_equal_text_and_services_without_pages(spark):
    def service(method, url, body, headers):
        kind, page = url.split("/")[-2:]
        if kind == "unpaged":
            return 200, '["all"]', None
        return 200, '["same"]' if int(page) <= {"six": 6, "none": 0, "one": 1}[kind] else "[]", None

    keys = spark.createDataFrame([("six",), ("none",), ("one",), ("unpaged",)], "k string")
    call = lambda pages: fx.fetch(build_requests(pages, "http://h/{k}/{page}", method="GET", query_type="inline"), service)
    items = F.size(F.from_json("response", "array<string>"))
    got = fx.pages_until_empty(keys, call, items, fresh_dir(spark, "pages"))
    pages = sorted((r["k"], r["page"]) for r in got.where("response is not null").collect())
    assert pages == [("one", 1)] + [("six", p) for p in range(1, 7)] + [("unpaged", 1)]
    got = fx.pages_until_empty(keys.where("k <> 'unpaged'"), call, items, fresh_dir(spark, "pages"), probe=None)
    assert got.where("response is not null").count() == 7


def test_time_outs_are_milliseconds(spark, monkeypatch):
    asked = []

    def transport(timeout):
        asked.append(timeout)
        return by_header
    monkeypatch.setattr(api, "http_transport", transport)
    params = spark.createDataFrame([(1,)], "id int")
    for options in ({"connectionTimeout": "1000", "readTimeout": "2500"}, {}, {"readTimeout": "60000"}):
        api.read(spark, "rest", input=params, url="http://h", method="GET", **options).collect()
    assert asked == [2.5, 5.0, 60.0]


def test_requests_go_to_the_task_of_their_index(spark):
    req = build_requests(spark.range(100).repartition(5), "http://h", method="GET")
    got = spread_by_index(req, 7, ["id"], fresh_dir(spark, "spread")).select("id", F.spark_partition_id().alias("task"))
    assert all(r["task"] == r["id"] % 7 for r in got.collect())
    with pytest.raises(ValueError):
        spread_by_index(req, 0, ["id"], "x")
