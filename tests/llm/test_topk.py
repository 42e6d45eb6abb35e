import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import topk


def model(rows, is_query, k=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, v + [0] * (width - len(v))) for i, v in kept]
    out = []
    for q, v in kept:
        if is_query(q):
            best = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -2**63), i) for i, w in kept if i != q)[:k]
            out += [(q, n + 1, i, max(min(-s, 2**63 - 1), -2**63)) for n, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "b") for i, v in rows], "vec_id long, embedding array<float>, rank int, block string")
    found = topk.search(df.repartition(3), "vec_id", "embedding", F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in found.collect())


def test_nulls_ties_blocks_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(50)]  # a common vector
    rows += [(400, None), (410, [1.0, None] + [0.0] * 6), (420, [float("nan")] * 8), (430, [float("inf")] + [0.0] * 7),
             (440, []), (450, [1.0, 2.0]), (None, [1.0] * 8), (460, [0.0] * 8)]
    want = model(rows, lambda q: q % 10 == 0)
    for block in (40, 10_000):
        assert run(spark, rows, block_rows=block) == want
    assert run(spark, rows, k=3, block_rows=64) == model(rows, lambda q: q % 10 == 0, 3)


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (10, [0.5, -1.0]), (3, [0.25, 0.25])]
    assert run(spark, rows) == model(rows, lambda q: q % 10 == 0)
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 400), st.integers(1, 12), st.integers(1, 15))
def test_index_proves_its_answer(seed, n, dims, k):
    rng = np.random.default_rng(seed)
    v = rng.integers(-50, 50, (n, dims)) * rng.integers(0, 2, (n, 1 if seed % 2 else dims))
    ids = rng.permutation(n).astype(np.int64)
    index = topk.Index(ids, v)
    q = rng.integers(-60, 60, dims)
    order = np.lexsort((ids, -(v @ q)))
    order = order[ids[order] != 5][:k]
    got_ids, got = index.best(5, q, k)
    assert got_ids.tolist() == ids[order].tolist() and got.tolist() == (v @ q)[order].tolist()


def test_large_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(120)]
    rows += [(200, [70000.0, 1.0]), (210, [1e30, -1e30, 0.0, 1e30]), (211, [-3e38, 1.0]), (220, [2.0**40, 0.5, -(2.0**41), 3.0]),
             (221, [65536.0, -65536.0]), (222, [65536.5, 0.0, 0.0, 0.0, 7.0])]
    rows += [(230, [1.0, 2.0, 3.0, 4.0])] * 40
    want = model(rows, lambda q: q % 10 == 0)
    want = sorted(set(want))  # a repeated query row asks once
    for block in (30, 10_000):
        assert run(spark, rows, block_rows=block) == want
