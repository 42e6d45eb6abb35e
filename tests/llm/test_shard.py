import zlib

import pytest

from feedloom.llm import shard
from tests.llm.helpers import EDGE_TEXTS, docs


def run(spark, rows, **options):
    return shard.shard_rows(docs(spark, rows), "doc_id", "text", **options).collect()


def check(rows, got, shards, near):
    assert len(got) == len(rows)
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((size(t), zlib.crc32((t or "").encode())) for _, t in rows)
    per = [0] * shards
    for s in range(shards):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        per[s] = sum(r["size"] for r in mine)
    total = sum(per)
    assert max(per) - min(per) <= near * total / shards + 2 * max(size(t) for _, t in rows)
    return per


def test_sizes_near_equal_and_groups_whole(spark):
    rows = [(i, f"text {i % 700} " * (1 + i % 13)) for i in range(3000)]
    got = run(spark, rows, shards=8, tolerance=0.02)
    check(rows, got, 8, 0.05)
    where = {}
    for r in got:
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_a_hot_group_is_cut_by_id(spark, monkeypatch):
    monkeypatch.setattr(shard, "CELL_ROWS", 100)
    rows = [(i, "the same text" if i % 3 else f"own text {i}") for i in range(2400)]
    got = run(spark, rows, shards=8, tolerance=0.02)
    check(rows, got, 8, 0.05)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_edge_rows(spark, shards):
    rows = [r for r in EDGE_TEXTS if r[0] != 8] + [(50, "dup")] * 20
    got = run(spark, rows, shards=shards, keep=("doc_id", "text", "shard", "id"))
    check(rows, got, shards, 0.1)
    assert all(r["row"]["shard"] == 3 and r["row"]["id"] == "x" for r in got)
    assert sorted(((r["row"]["doc_id"] is None, r["row"]["doc_id"] or 0), r["row"]["text"] or "") for r in got) == \
        sorted(((i is None, i or 0), t or "") for i, t in rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_prefix_numbers_keep_the_key_order(spark):
    keys = spark.range(500).selectExpr("xxhash64(id) as k1", "xxhash64(id, 1) as k2")
    rows = [(r[0], r[1]) for r in keys.collect()]
    for bits in (12, 36, 64, 76, 128):
        got = keys.select("k1", "k2", *shard._prefix(bits)).collect()
        for r in got:
            whole = ((r["k1"] - shard.LOW) << 64) + (r["k2"] - shard.LOW)
            assert shard._number(r["p1"], r["p2"], bits) == whole >> (128 - bits)
    p = ((rows[0][0] - shard.LOW) << 64) + (rows[0][1] - shard.LOW)
    for bits in (12, 64, 76):
        inside = keys.where(shard._inside(bits, p >> (128 - bits))).count()
        assert inside == sum(1 for a, b in rows
                             if (((a - shard.LOW) << 64) + (b - shard.LOW)) >> (128 - bits) == p >> (128 - bits))


def test_a_third_of_equal_rows_is_cut_evenly(spark, monkeypatch):
    monkeypatch.setattr(shard, "CELL_ROWS", 100)
    rows = [(None, "the same row again and again")] * 800 + [(i, f"{i}") for i in range(800)] + [(7, "its copies")] * 400
    per = check(rows, run(spark, rows, shards=8, tolerance=0.01), 8, 0.02)
    assert min(per) > 0.9 * sum(per) / 8
