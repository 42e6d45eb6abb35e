"""Options-style reads and writes with function transports (no network)."""

import json

import pytest

from feedloom import api


def serve(routes):
    def transport(method, url, body, headers):
        for prefix, answer in routes.items():
            if url.startswith(prefix):
                return 200, answer(url) if callable(answer) else answer, None
        return 404, None, "not found"
    return transport


def test_rest_with_inputs(spark):
    params = spark.createDataFrame([(1,), (2,), (10,)], "id long")
    t = serve({"http://h/api?id=10": "oops not json", "http://h/api": lambda u: json.dumps({"u": u})})
    df = api.read(spark, "rest", transport=t, input=params, url="http://h/api", method="GET")
    rows = {r.id: (r.output, r._corrupt_record) for r in df.collect()}
    assert rows[1] == ('{"u": "http://h/api?id=1"}', None)
    assert rows[10] == ("oops not json", None)
    only = api.read(spark, "rest", transport=t, input=params, url="http://h/api", method="GET",
                    includeInputsInOutput="N", schema="u string")
    assert only.columns == ["output", "_corrupt_record"]
    with pytest.raises(ValueError):
        api.read(spark, "rest", transport=t, input=params, url="", method="GET")
    params.createOrReplaceTempView("rest_params")
    by_view = api.read(spark, "rest", transport=t, input="rest_params", url="http://h/api", method="GET")
    assert by_view.count() == 3


def test_blog_posts_limit_and_id(spark, tmp_out):
    posts = [{"userId": 1, "id": i, "title": f"t{i}", "body": "b"} for i in range(1, 6)]
    t = serve({api.BLOG_BASE + "/posts/3": json.dumps(posts[2]),
               api.BLOG_BASE + "/posts": json.dumps(posts)})
    assert [r.id for r in api.read(spark, "blog_demo", transport=t, limit=2).collect()] == [1, 2]
    one = api.read(spark, "blog_demo", transport=t, id=3, limit=2, land_to=tmp_out).collect()
    assert [(r.id, r.title) for r in one] == [(3, "t3")]


def test_quotes_and_prices(spark):
    qt = serve({api.QUOTES_BASE: lambda u: json.dumps({"results": [{"price": "1.5", "timestamp": "x"}]})
                if "BTC" in u else json.dumps({"error": "no"})})
    got = [tuple(r) for r in api.read(spark, "quotes", transport=qt, path="btc, doge-usd").collect()]
    assert got == [("BTC-USD", 1.5, 0.0, 0.0, "x")]
    series = {"Meta Data": {}, "Time Series (Daily)": {
        "2024-01-01": {"1. open": "1", "2. high": "3", "3. low": "1", "4. close": "2", "5. volume": "5"},
        "2024-01-02": {"1. open": "2", "2. high": "4", "3. low": "0.5", "4. close": "3", "5. volume": "6"}}}
    pt = serve({"https://www.alphavantage.co": json.dumps(series)})
    w = api.read(spark, "price_series", transport=pt, path="SPY", api_key="k",
                 function="TIME_SERIES_WEEKLY").collect()
    assert [tuple(r) for r in w] == [("2024-01-02", 1.0, 4.0, 0.5, 3.0, 11, "SPY")]
    with pytest.raises(ValueError):
        api.read(spark, "price_series", transport=pt, path="SPY")


def test_flights_weather_pulls(spark):
    st = ["ab", "CS", "NL", 1, 2, -100.0, 40.0, 1.0, False, 1, 1, 1, None, 1, "1", False, 1]
    ft = serve({api.FLIGHTS_URL: json.dumps({"time": 1700000000, "states": [st]})})
    assert api.read(spark, "flights", transport=ft).count() == 1
    with pytest.raises(ValueError):
        api.read(spark, "flights", transport=ft, region="MOON")
    tl = {"timelines": {"hourly": [{"time": "2024-09-02T00:00:00Z", "values": {"t": 1}}]}}
    wt = serve({api.WEATHER_URL: json.dumps(tl)})
    rows = api.read(spark, "weather", transport=wt, locations="[(1.5, 2.5), (3, 4)]",
                    frequency="hourly").collect()
    assert sorted((r.latitude, r.weather) for r in rows) == [(1.5, '{"t":1}'), (3.0, '{"t":1}')]
    gt = serve({"https://api.github.com/repos/o/r/pulls": json.dumps([{"number": 7, "user": None}])})
    assert [tuple(r) for r in api.read(spark, "pull_requests", transport=gt, path="o/r").collect()] == \
        [(7, None, None, None, None)]


def test_sheets_fake_and_crm(spark):
    st = serve({"https://docs.google.com/spreadsheets/d/ID/gviz/tq": "num,name\n1,Alice\n2,Bob\n"})
    df = api.read(spark, "sheets", transport=st, url="https://docs.google.com/spreadsheets/d/ID/edit")
    assert df.columns == ["num", "name"] and df.count() == 2
    with pytest.raises(ValueError):
        api.read(spark, "sheets", transport=st, url="https://example.com/x")
    assert api.read(spark, "fake", numRows=5).count() == 5

    def tree(_obj, payload):
        n = len(json.loads(payload)["records"])
        return json.dumps({"hasErrors": False, "results": [{"id": str(i)} for i in range(n)]})

    out = api.write(api.read(spark, "fake", numRows=250, schema="name string"), "crm", username="u",
                    password="p", security_token="t", transport=tree, schema="Name STRING")
    assert sorted(r.n_records for r in out.collect()) == [50, 200]
    with pytest.raises(ValueError):
        api.write(spark.range(1), "crm", username="u")


def test_stream_reads_and_crm_stream_write(spark, tmp_out):
    import os

    from feedloom.session import ensure_dir, local_path
    from feedloom.streaming.sources import run_available

    d = local_path(ensure_dir(tmp_out + "/snaps"))
    st = '["ab", "CS", "NL", 1, 2, -100.0, 40.0, 1.0, false, 1, 1, 1, null, 1, "1", false, 1]'
    with open(os.path.join(d, "s.txt"), "w") as f:
        f.write('{"time": 1700000000, "states": [%s, %s]}\n' % (st, st))
    s = api.read_stream(spark, "flights", path=tmp_out + "/snaps", region="NORTH_AMERICA")
    run_available(s.select("icao24", "time_ingest"), tmp_out + "/out", tmp_out + "/ckpt")
    assert spark.read.parquet(tmp_out + "/out").count() == 1
    with pytest.raises(ValueError):
        api.read_stream(spark, "flights")

    def tree(_obj, payload):
        n = len(json.loads(payload)["records"])
        return json.dumps({"hasErrors": False, "results": [{"id": "x"}] * n})

    src = api.read_stream(spark, "fake", numRows=4, schema="name string")
    q = api.write_stream(src, "crm", username="u", password="p", security_token="t", key="name",
                         transport=tree, ledger=tmp_out + "/ledger", checkpointLocation=tmp_out + "/c2",
                         schema="Name STRING")
    q.awaitTermination()
    assert spark.read.parquet(tmp_out + "/ledger").count() == 4
