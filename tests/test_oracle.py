"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from feedloom.plans import registry
from feedloom.plans.tables import TABLES
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES = registry.QUERIES  # the optional subpackage has tests of its own
ORACLES = registry.ORACLES


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~" if math.isnan(v) else repr(v)  # exact: both engines compute the same doubles
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 70
    assert not [q for q in QUERIES if q not in ORACLES]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["c_mktsegment", "n_purchases", "revenue"]
    assert df.count() > 0
