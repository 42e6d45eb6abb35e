import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import queries as Q
from feedloom.llm import runs
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def model(w, least=6, copies=4):
    """Every stretch with equal words q apart, its smallest period and its ends, by brute force."""
    found = {}
    for q in range(1, len(w) // copies + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, copies * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def folded(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def expected(doc_id, text):
    w = folded(doc_id, SPLIT.findall(text or ""))
    found = model(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found)))


def of_words(w, least=6, copies=4):
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    ids = np.array([number[x] for x in w], dtype=np.int64)
    found = runs.runs_of(ids, np.array([0, len(w)]), least, copies)
    return [tuple(r[1:]) for r in found.tolist()]


def test_nested_neighbouring_and_overlapping_runs():
    for w in ("a a a a a a", "a a a a a", "a b a b a b a b", "a b a b a b a", "x a b c a b c a b c a b c a y",
              "a a a a a a b b b b b b", "a b a b a b a b a b b b b b b b", "a a b a a b a a b a a b a a b",
              "a a a a a a b a a a a a a b a a a a a a b a a a a a a b", "a b c d " * 5 + "c d " * 6, ""):
        assert of_words(w.split()) == model(w.split()), w


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=8))
def test_runs_of_random_blocks(blocks):
    w = [x for unit, times in blocks for x in unit * times]
    assert of_words(w) == model(w)
    assert of_words(w, 3, 3) == model(w, 3, 3)


def test_long_texts_of_every_kind():
    rng = random.Random(4)
    for length, names, unit in ((3000, 2, 700), (4000, 50, 900), (2500, 5, 1), (3000, 3000, 600), (5000, 4, 1250)):
        part = [rng.randrange(names) for _ in range(unit)]
        w = [rng.randrange(names) for _ in range(200)] + [part[i % unit] for i in range(length)] + [1] * 40
        assert of_words(w) == model(w)
    assert of_words([7] * 200_000) == [(0, 200_000, 1)]
    unit = [rng.randrange(9) for _ in range(1000)]
    assert of_words(unit * 20 + [99] + unit * 3) == [(0, 20_000, 1000)]


def test_texts_of_every_kind(spark):
    rows = [*EDGE_TEXTS, (20, "go on " * 7), (21, "\t no\x0bno\x0cno\rno\nno no  no \x1c no no"), (21, "go on " * 7),
            (None, "la " * 9 + "end"), (22, "né é " * 400), (23, "ends in a a a a a a")]
    got = runs.find_runs(docs(spark, rows), "doc_id", "text").collect()
    want = []
    for i, t in rows:
        w = SPLIT.findall(t or "")
        found = model(w) if len(w) < 5000 else []
        want.append((i, len(w), found, collapsed(w, found)))
    assert sorted(map(repr, ((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got))) == \
        sorted(map(repr, want))
    assert runs.find_runs(docs(spark, []), "doc_id", "text").count() == 0


def test_query_equals_its_model(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in Q.QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(expected(i, t) for i, t in rows)
    assert sum(r[1] for r in got)
