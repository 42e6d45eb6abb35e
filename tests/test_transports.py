"""The stdlib HTTP transport with an injected opener (no sockets)."""

import io
import urllib.error

import pytest

from feedloom.operators.transports import http_transport


class _Resp(io.BytesIO):
    status = 200

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_success_and_request_shape():
    seen = {}

    def opener(req, timeout):
        seen.update(method=req.get_method(), url=req.full_url, body=req.data,
                    auth=req.get_header("Authorization"), timeout=timeout)
        return _Resp(b'{"ok": true}')

    t = http_transport(timeout=5, opener=opener)
    assert t("POST", "http://h/x", '{"a":1}', {"Authorization": "Bearer t"}) == (200, '{"ok": true}', None)
    assert seen == {"method": "POST", "url": "http://h/x", "body": b'{"a":1}', "auth": "Bearer t", "timeout": 5}


def test_retries_then_gives_error_row():
    calls = []

    def opener(req, timeout):
        calls.append(1)
        raise urllib.error.HTTPError(req.full_url, 503, "busy", {}, io.BytesIO(b"later"))

    t = http_transport(retries=2, backoff=0.0, opener=opener)
    assert t("GET", "http://h", None, None) == (503, "later", "HTTP 503")
    assert len(calls) == 3


def test_no_retry_for_client_errors_and_timeouts_become_rows():
    calls = []

    def not_found(req, timeout):
        calls.append(1)
        raise urllib.error.HTTPError(req.full_url, 404, "nope", {}, io.BytesIO(b""))

    assert http_transport(backoff=0.0, opener=not_found)("GET", "http://h", None, None)[2] == "HTTP 404"
    assert len(calls) == 1

    def slow(req, timeout):
        raise TimeoutError("timed out")

    st, body, err = http_transport(retries=1, backoff=0.0, opener=slow)("GET", "http://h", None, None)
    assert (st, body) == (None, None) and err.startswith("TimeoutError")
    with pytest.raises(ValueError):
        http_transport(retries=-1)


def test_with_fetch(spark):
    from feedloom.operators.fetch import fetch
    from feedloom.operators.requests import build_requests

    def opener(req, timeout):
        return _Resp(req.full_url.encode())

    params = spark.createDataFrame([(1,), (2,)], "id long")
    req = build_requests(params, "http://h/items/{id}", method="GET", query_type="inline")
    got = sorted(r.response for r in fetch(req, http_transport(opener=opener)).collect())
    assert got == ["http://h/items/1", "http://h/items/2"]


def test_rate_limited_spacing():
    import time

    from feedloom.operators.transports import rate_limited

    stamps = []
    t = rate_limited(lambda m, u, b, h: stamps.append(time.monotonic()) or (200, "", None), 0.05)
    for _ in range(4):
        t("GET", "http://h", None, None)
    gaps = [b - a for a, b in zip(stamps, stamps[1:])]
    assert all(g >= 0.045 for g in gaps)
    with pytest.raises(ValueError):
        rate_limited(t, -1)
