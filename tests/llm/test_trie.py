import hashlib
import random
import zlib

import pytest

from feedloom.llm import queries as Q
from feedloom.llm import trie
from feedloom.session import fresh_dir

SCHEMA = "conv_id long, turn long, role string, text string, id long, depth int, x1 string, digest string, at string, seq int"


def conversations(rows):
    """{id: [(role, text)]}, in order of turn (null first), then the digest of role and text."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0,
                     hashlib.sha256(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest()[:16])
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(convs.get(base, [])[:h] + own[h:])
    return out


def nodes(convs):
    members, ends = {}, {}
    for c, w in convs.items():
        ends.setdefault(tuple(w), []).append(c)
        for d in range(len(w) + 1):
            members.setdefault(tuple(w[:d]), []).append(c)
    kids = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)

    def below(k):
        saved, leaves = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0), 0 if kids.get(k) else 1
        for x in kids.get(k, []):
            s, n = below(x)
            saved, leaves = saved + s, leaves + n
        return saved, leaves

    out = []
    for k, m in members.items():
        saved, leaves = below(k)
        listed = ",".join(map(str, sorted(ends.get(k, []))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves, saved,
                    hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out)


def frame(spark, rows):
    full = [(*r, 1, 2, "x", "d", "a", 3) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.repartition(4) if full else df


def run(spark, rows):
    t = trie.turns(frame(spark, rows), "conv_id", "turn", "role", "text")
    return sorted(tuple(r) for r in trie.prefix_trie(t, t.select("id").distinct()).collect())


def random_rows(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), n):
        for t in range(rng.choice([0, 1, 2, 2, 3, 9, 12])):
            rows.append((c, t, rng.choice(["user", "assistant", None]) if t else "user",
                         rng.choice(["hi", "é", "", None]) if rng.random() < 0.8 else "go on"))
    return rows


ODD = [(None, 0, "user", "lost"), (5, None, "user", "first"), (5, 0, "user", "a"), (5, 0, "user", "b"), (5, 1, "user", "b"),
       (7, 1, None, None), (7, 1, None, None), (8, 1, "", ""), (9, 3, "user", "long " * 30_000), (10, 3, "user", "long " * 30_000),
       (11, 0, "us", "er"), (12, 0, "user", ""), (13, 0, "u", "ser")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_conversations(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows) == nodes(conversations(rows))


def test_nulls_ties_repeats_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 2)  # member lists of several pieces
    rows = ODD + [(c, t, "user", "copy") for c in range(100, 140) for t in range(2)] + [(50, t, "user", "again") for t in range(500)]
    assert run(spark, rows) == nodes(conversations(rows))
    assert run(spark, []) == []


def test_query_equals_its_model(spark):
    rows = ODD + random_rows(3, 120) + [(c, t, "user", "copy") for c in range(300, 330) for t in range(9)]
    folder = fresh_dir(spark, "tests")
    frame(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    got = sorted(tuple(r) for r in Q.QUERIES["op11_prefix_trie"](spark, folder).collect())
    want = nodes(rebuilt(conversations(rows)))
    assert got == want
    assert any(r[1] == 0 and r[3] == len(conversations(rows)) for r in got)


def test_nodes_with_their_texts(spark):
    rows = random_rows(4, 20)
    df = frame(spark, rows)
    t = trie.turns(df, "conv_id", "turn", "role", "text")
    found = trie.with_texts(trie.prefix_trie(t, t.select("id").distinct()), df, "conv_id", "turn", "role", "text")
    convs = conversations(rows)
    for r in found.collect():
        assert (r["role"], r["text"]) == (convs[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None))
