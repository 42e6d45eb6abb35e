import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from feedloom.llm import packing  # noqa: E402
from tests.llm.helpers import EDGE_TEXTS, docs  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def check(sizes, pieces, window):
    """Every token in exactly one piece; sequences gapless, full or of a power of two."""
    starts, seqs = {}, {}
    for doc, start, length, seq, offset in pieces:
        assert length > 0
        starts.setdefault(doc, []).append((start, length))
        seqs.setdefault(seq, []).append((offset, length))
    for doc, n in enumerate(sizes):
        at = 0
        for s, k in sorted(starts.get(doc, [])):
            assert s == at
            at += k
        assert at == n
    for parts in seqs.values():
        at = 0
        for o, k in sorted(parts):
            assert o == at
            at += k
        assert at <= window and at & (at - 1) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=40), st.integers(0, 10**6))
def test_shards_pack_every_token_once(sizes, seed):
    rng = np.random.default_rng(seed)
    ids = [rng.integers(0, 30, n).astype("<u2") for n in sizes]
    check(sizes, packing.pack_shard(ids, 32), 32)


def test_neighbours_follow_bm25():
    ids = [np.array(x, dtype="<u2") for x in ([1, 2, 3, 9], [4, 5, 6, 9], [1, 2, 7, 9], [3, 8, 8, 9], [10, 11, 12, 9])]
    index = packing.Bm25(ids)
    free = np.ones(5, dtype=np.float32)
    free[0] = 0
    n, df = 5, {1: 2, 2: 2, 3: 2, 9: 5}

    def score(d):
        return sum(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * (c := ids[d].tolist().count(t)) * 2.2 / (c + 1.2)
                   for t in (1, 2, 3, 9) if t in ids[d])

    want = sorted((d for d in (1, 2, 3, 4)), key=lambda d: (-score(d), d))
    assert index.neighbours(0, free) == want and want[0] == 2
    pieces = packing.pack_shard(ids, 8)
    assert [p[0] for p in pieces if p[3] == 0] == [0, 2]


def test_seeds_ask_with_all_their_tokens():
    """Seeds of 400 distinct tokens against brute force, before and after used documents are forgotten."""
    rng = np.random.default_rng(7)
    ids = [rng.permutation(np.concatenate([rng.choice(3000, 400, replace=False), rng.integers(0, 20, 100)])).astype("<u2")
           for _ in range(60)]
    index, free = packing.Bm25(ids), np.ones(60, dtype=np.float32)
    free[0] = 0
    counts = [dict(zip(*(x.tolist() for x in np.unique(d, return_counts=True)))) for d in ids]
    assert all(len(c) >= 400 for c in counts)
    df = {t: sum(t in c for c in counts) for c in counts for t in c}
    mean = sum(map(len, ids)) / 60

    def score(seed, d):
        norm = packing.K1 * (1 - packing.B + packing.B * len(ids[d]) / mean)
        return sum(np.log1p((60 - df[t] + 0.5) / (df[t] + 0.5)) * (c := counts[d][t]) * (packing.K1 + 1) / (c + norm)
                   for t in counts[seed] if t in counts[d])

    def want(seed):
        return sorted(np.flatnonzero(free).tolist(), key=lambda d: -score(seed, d))

    assert index.neighbours(0, free, most=60) == want(0)
    free[::3] = 0
    index.forget(free)
    assert index.neighbours(0, free, most=60) == want(0) and index.neighbours(5, free, most=7) == want(5)[:7]


def test_statistics_are_those_of_the_whole_corpus(spark):
    """Many small shards, one corpus: frequencies, document number and mean length don't follow the shards."""
    rows = EDGE_TEXTS + [(100 + i, f"common words and number {i} " * (i % 40 + 1)) for i in range(150)]
    encoded = packing.encode(docs(spark, rows), "doc_id", "text", BYTE_BPE)
    ids = [np.frombuffer(r["ids"], dtype="<u4" if r["wide"] else "<u2") for r in encoded.collect()]
    got = packing._statistics(encoded)
    want = np.bincount(np.concatenate([np.unique(x) for x in ids]))
    assert got.documents == len(rows) and got.mean == sum(map(len, ids)) / len(rows)
    assert got.df.tolist() == want.tolist()
    # Token 1 fills this shard but is rare in the corpus: it must outweigh 2, which is common there.
    shard = [np.array(x, dtype="<u2") for x in ([1, 2, 0], [1, 3, 0], [2, 4, 0], [1, 5, 0], [1, 6, 0])]
    corpus = packing.Statistics(10_000, 3.0, np.array([10_000, 4, 5_000, 1, 1, 1, 1]))
    free = np.ones(5, dtype=np.float32)
    free[0] = 0
    assert packing.Bm25(shard).neighbours(0, free)[0] == 2
    assert packing.Bm25(shard, corpus).neighbours(0, free) == [1, 3, 4, 2]


def test_pieces_rebuild_the_documents(spark):
    from tokenizers import Tokenizer
    rows = EDGE_TEXTS + [(100 + i, f"common words and number {i} " * (i % 40 + 1)) for i in range(150)]
    t = Tokenizer.from_file(BYTE_BPE)
    got = packing.pack(docs(spark, rows), "doc_id", "text", BYTE_BPE, window=64, shard_tokens=5000).collect()
    want = sorted((str(i), len(t.encode(x or "", add_special_tokens=False).ids) + 1) for i, x in rows)
    totals = {}
    for r in got:
        totals[str(r["id"])] = totals.get(str(r["id"]), 0) + r["length"]
    sums = {}
    for i, n in want:
        sums[i] = sums.get(i, 0) + n
    assert totals == sums
    unique = {i: x for i, x in rows if [a for a, _ in rows].count(i) == 1}
    for i, x in unique.items():
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, k in sorted(parts):
            assert o == at
            at += k
        assert at <= 64 and at & (at - 1) == 0
    assert len(seqs) > 10


def test_empty(spark):
    assert packing.pack(docs(spark, []), "doc_id", "text", BYTE_BPE).count() == 0


def test_draws_are_an_order_of_the_ids():
    assert sorted(packing._draws(1000).tolist()) == list(range(1000))


def test_equal_rows_are_dealt_over_their_shards(spark):
    rows = [(None, "the same words in every row of a large group")] * 400 + [(7, "the same row again")] * 300
    got = packing.pack(docs(spark, rows), "doc_id", "text", BYTE_BPE, 64, shard_tokens=500).collect()
    tokens = {}
    for r in got:
        tokens[r["sequence_id"] >> 32] = tokens.get(r["sequence_id"] >> 32, 0) + r["length"]
    total = sum(tokens.values())
    assert total == sum(r["doc_tokens"] for r in got if r["start"] == 0) and total > 5000
    assert max(tokens.values()) <= 2 * 500


def test_matrix_and_postings_give_the_same_scores(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [np.minimum(rng.zipf(1.3, rng.integers(1, 200)), 900).astype("<u2") for _ in range(150)]
    ids += [ids[3]] * 5
    packed = []
    for square, often in ((4096, 16), (4096, 2), (0, 16)):
        monkeypatch.setattr(packing, "SQUARE", square)
        monkeypatch.setattr(packing, "OFTEN", often)
        packed.append(packing.pack_shard(ids, 64))
    assert packed[0] == packed[1] == packed[2]
