"""Transports for the live call stage (``fetch``).

A transport is a plain function ``(method, url, body, headers) ->
(status, body, error)`` that runs inside tasks.  ``http_transport`` builds
one on the standard library: time-outs, a few retries with exponential
back-off for throttling and server errors, and every failure returned as an
error text (the row keeps it as ``_corrupt_record``) instead of raised.
"""

from __future__ import annotations

import time
from collections.abc import Callable

# HTTP statuses worth another try.
RETRY_STATUSES = (429, 500, 502, 503, 504)


def http_transport(timeout: float = 30.0, retries: int = 2, backoff: float = 0.5,
                   retry_statuses: tuple[int, ...] = RETRY_STATUSES,
                   opener: Callable | None = None):
    """A transport over ``urllib``; ``opener(request, timeout)`` is injectable
    (tests use a function, never a socket)."""
    if retries < 0:
        raise ValueError("retries must be >= 0")

    def call(method: str, url: str, body: str | None, headers: dict | None):
        import urllib.error
        import urllib.request

        open_ = opener or (lambda req, t: urllib.request.urlopen(req, timeout=t))
        data = body.encode("utf-8") if body is not None else None
        last_error = None
        for attempt in range(retries + 1):
            req = urllib.request.Request(url, data=data, method=method, headers=dict(headers or {}))
            try:
                with open_(req, timeout) as resp:
                    status = getattr(resp, "status", 200)
                    text = resp.read().decode("utf-8", errors="replace")
                return status, text, None
            except urllib.error.HTTPError as e:
                text = e.read().decode("utf-8", errors="replace") if e.fp is not None else ""
                last_error = (e.code, text, f"HTTP {e.code}")
                if e.code not in retry_statuses:
                    return last_error
            except Exception as e:  # noqa: BLE001 - time-outs, connection errors
                last_error = (None, None, f"{type(e).__name__}: {e}")
            if attempt < retries:
                time.sleep(backoff * (2 ** attempt))
        return last_error

    return call


def rate_limited(transport, min_interval: float):
    """Wrap a transport so calls in one task are at least ``min_interval``
    seconds apart (thread-safe, so it also holds with ``concurrency``).

    With ``fetch(..., partitions=n)`` the whole job makes at most
    ``n / min_interval`` calls per second.
    """
    import threading

    if min_interval < 0:
        raise ValueError("min_interval must be >= 0")
    state = {"next": 0.0}
    lock = threading.Lock()

    def call(method, url, body, headers):
        with lock:
            now = time.monotonic()
            wait = state["next"] - now
            state["next"] = max(now, state["next"]) + min_interval
        if wait > 0:
            time.sleep(wait)
        return transport(method, url, body, headers)

    return call
