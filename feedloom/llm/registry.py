"""Queries of this subpackage: name -> callable, and their SQL where it can be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its DuckDB form."""
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
