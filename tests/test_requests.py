"""Request planning edge cases (hand-written parameter rows)."""

from urllib.parse import quote, urlencode

import pytest
from pyspark.sql import functions as F

from feedloom.operators.fetch import replay
from feedloom.operators.requests import (
    build_requests, cut_pages, plan_pages, range_index, split_range, spread,
)

VALUES = ["a b", "x&y=z", "p/q", "star*", "tilde~", "café 日本", "plus+sign", "ok"]


def test_querystring_matches_python_urlencode(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(VALUES)], "q string, i int")
    got = build_requests(df, "http://h/api", method="GET").select("q", "i", "req_url").collect()
    for q, i, url in got:
        assert url == "http://h/api?" + urlencode({"q": q, "i": i})


def test_querystring_appends_with_ampersand_and_skips_null(spark):
    df = spark.createDataFrame([("v", None)], "a string, b string")
    url = build_requests(df, "http://h/api?x=1", method="GET").first()["req_url"]
    assert url == "http://h/api?x=1&a=v"


def test_inline_matches_python_quote(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "p string")
    got = build_requests(df, "http://h/items/{p}/x", method="GET", query_type="inline") \
        .select("p", "req_url").collect()
    for p, url in got:
        assert url == f"http://h/items/{quote(p)}/x"


def test_json_and_form_bodies(spark):
    df = spark.createDataFrame([(1, "a b", None)], "id long, name string, note string")
    j = build_requests(df, "http://h", method="post").first()
    assert j["req_body"] == '{"id":1,"name":"a b","note":null}'
    assert j["req_headers"]["Content-Type"] == "application/json"
    f = build_requests(df, "http://h", method="PUT", post_input_format="form").first()
    assert f["req_body"] == "id=1&name=a+b"


def test_delete_sends_no_parameters(spark):
    df = spark.createDataFrame([(1,)], "id long")
    r = build_requests(df, "http://h/x", method="DELETE").first()
    assert (r["req_method"], r["req_url"], r["req_body"]) == ("DELETE", "http://h/x", None)


def test_option_validation():
    with pytest.raises(ValueError, match="url"):
        build_requests(object(), "", method="GET")
    with pytest.raises(ValueError, match="input"):
        build_requests(None, "http://h", method="GET")


def test_bad_method_rejected(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="unknown method"):
        build_requests(df, "http://h", method="PATCH")


def test_headers_custom_bearer_basic_cookie(spark):
    df = spark.createDataFrame([(1,)], "id long")
    h = build_requests(df, "http://h", method="GET", headers='{"X-A": "1", "Accept": "text/csv"}',
                       auth_type="Bearer", token="t0k", cookie="sid=a=b").first()["req_headers"]
    assert h == {"X-A": "1", "Accept": "text/csv", "Authorization": "Bearer t0k", "Cookie": "sid=a=b"}
    h = build_requests(df, "http://h", method="GET", headers="not json", user="u", password="p",
                       cookie="novalue").first()["req_headers"]
    assert h == {"Authorization": "Basic dTpw"}


def test_spread_partitions(spark):
    df = spark.range(100)
    assert spread(df, 5).rdd.getNumPartitions() == 5
    with pytest.raises(ValueError):
        spread(df, 0)


def test_pages_plan_and_cut(spark):
    keys = spark.createDataFrame([("a", 25), ("b", 0)], "k string, total long")
    planned = plan_pages(keys, "total", 10).select("k", "page").collect()
    assert sorted((r.k, r.page) for r in planned) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1)]
    pages = spark.createDataFrame(
        [("a", 1, True, 10), ("a", 2, True, 10), ("a", 3, False, 5), ("a", 4, False, 0),
         ("c", 1, True, 3), ("c", 2, True, 0), ("c", 3, True, 2)],
        "k string, page int, has_more boolean, n_items int")
    kept = cut_pages(pages, ["k"]).select("k", "page").collect()
    assert sorted((r.k, r.page) for r in kept) == [("a", 1), ("a", 2), ("a", 3), ("c", 1), ("c", 2)]


def test_range_split_last_takes_rest(spark):
    assert split_range(0, 10, 3) == [(0, 0, 3), (1, 3, 6), (2, 6, 10)]
    df = spark.range(0, 10).select(range_index(F.col("id"), 0, 10, 3).alias("r"))
    assert [r.r for r in df.orderBy("r").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]


def test_replay_takes_latest_capture_and_marks_missing(spark):
    req = build_requests(spark.createDataFrame([("/a",), ("/b",)], "p string"), "http://h{p}",
                         method="GET", query_type="inline")
    caps = spark.createDataFrame(
        [("f", "http://h/a", 200, "old", None, "2024-01-01 00:00:00"),
         ("f", "http://h/a", 200, "new", None, "2024-02-01 00:00:00")],
        "feed string, key string, status int, body string, error string, fetched_at string") \
        .withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    got = {r.p: (r.response, r._corrupt_record) for r in replay(req, caps).collect()}
    assert got == {"/a": ("new", None), "/b": (None, "not captured")}


def test_replay_without_dedupe(spark):
    req = build_requests(spark.createDataFrame([("/a",)], "p string"), "http://h{p}",
                         method="GET", query_type="inline")
    caps = spark.createDataFrame([("f", "http://h/a", 200, "only", None, None)],
                                 "feed string, key string, status int, body string, error string, "
                                 "fetched_at timestamp")
    assert [r.response for r in replay(req, caps, latest=False).collect()] == ["only"]


def test_inline_null_parameter_is_rejected(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    req = build_requests(df, "http://h/{x}/{y}", method="GET", query_type="inline")
    assert req.first()["req_url"] is None
    caps = spark.createDataFrame([], "feed string, key string, status int, body string, error string, "
                                     "fetched_at timestamp")
    assert replay(req, caps).first()["_corrupt_record"].startswith("invalid request")
    ok = build_requests(spark.createDataFrame([("a", None)], "x string, y string"), "http://h/{x}",
                        method="GET", query_type="inline", param_columns=["x", "y"]).first()
    assert ok["req_url"] == "http://h/a"


def test_replay_with_colliding_column_names(spark):
    params = spark.createDataFrame([("a", "k1", 5, "b", "e")], "p string, key string, status int, body string, error string")
    req = build_requests(params, "http://h/{p}", method="GET", query_type="inline", param_columns=["p"])
    caps = spark.createDataFrame([("f", "http://h/a", 201, "ok", None, None)],
                                 "feed string, key string, status int, body string, error string, "
                                 "fetched_at timestamp")
    r = replay(req, caps).first()
    assert (r.key, r.body, r.error, r.status, r.response) == ("k1", "b", "e", 201, "ok")


def test_cut_pages_matches_sequential_pager(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    page = st.tuples(st.booleans(), st.integers(0, 3))  # (has_more, n_items)
    keys = st.lists(st.lists(page, min_size=1, max_size=6), min_size=1, max_size=6)

    def pager(pages):
        kept = []
        for i, (more, n) in enumerate(pages, start=1):
            kept.append(i)  # the page is read; an empty one contributes no items
            if n == 0 or not more:
                break
        return kept

    @settings(max_examples=10, deadline=None)
    @given(keys)
    def check(per_key):
        rows = [(k, i, more, n) for k, pages in enumerate(per_key)
                for i, (more, n) in enumerate(pages, start=1)]
        df = spark.createDataFrame(rows, "k int, page int, has_more boolean, n_items int")
        got = {}
        for r in cut_pages(df, ["k"]).collect():
            got.setdefault(r.k, []).append(r.page)
        for k, pages in enumerate(per_key):
            assert sorted(got.get(k, [])) == pager(pages)

    check()


def test_range_index_matches_split(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=10, deadline=None)
    @given(st.integers(-50, 50), st.integers(1, 200), st.integers(1, 9), st.lists(st.integers(-80, 300), max_size=40))
    def check(lo, width, n, keys):
        hi = lo + width
        ranges = split_range(lo, hi, n)
        df = spark.createDataFrame([(k,) for k in keys] or [(lo,)], "k long")
        got = {r.k: r.i for r in df.select("k", range_index(F.col("k"), lo, hi, n).alias("i")).collect()}
        for k in keys:
            want = next((i for i, s, e in ranges if s <= k < e), None)
            assert got[k] == want, (lo, hi, n, k)

    check()


def test_json_body_round_trips(spark):
    import json

    from hypothesis import given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.one_of(st.none(), st.text(max_size=8)), st.one_of(st.none(), st.integers(-10**9, 10**9)),
                    st.one_of(st.none(), st.booleans()))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(row, min_size=1, max_size=30))
    def check(rows):
        df = spark.createDataFrame(rows, "s string, n long, b boolean")
        bodies = [json.loads(r.req_body) for r in build_requests(df, "http://h", method="POST").collect()]
        assert bodies == [{"s": s, "n": n, "b": b} for s, n, b in rows]

    check()
