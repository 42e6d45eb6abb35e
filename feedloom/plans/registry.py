"""Query registry: name -> (spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from feedloom.plans import q_requests, q_fetch  # noqa: F401
    for mod in ("q_feeds", "q_files", "q_sinks", "q_streams"):
        try:
            __import__(f"feedloom.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"feedloom.plans.{mod}":
                raise
