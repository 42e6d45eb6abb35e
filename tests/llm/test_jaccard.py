import random

import pytest
from pyspark.sql import functions as F

from feedloom.llm import jaccard
from tests.llm.helpers import EDGE_TEXTS, docs, near_model


def run(spark, rows, **options):
    got = jaccard.near_duplicates(docs(spark, rows), "doc_id", "text", **options).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1:] != (None,), str(x))
    return sorted((tuple(r) for r in got), key=order), sorted(near_model(rows), key=order)


def corpus(seed, groups=8, size=14, length=120, edits=3):
    """Groups of near copies with similarities on both sides of the threshold."""
    rng = random.Random(seed)
    v = [f"t{i}" for i in range(500)]
    rows, i = [], 0
    for g in range(groups):
        base = rng.choices(v, k=length + 10 * g)
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = rng.choice(v)
            rows.append((i, " ".join(w)))
            i += 1
    passage = " ".join(rng.choices(v, k=55))  # a passage many unlike texts share
    for _ in range(40):
        rows.append((i, " ".join(rng.choices(v, k=40)) + " " + passage + " " + " ".join(rng.choices(v, k=60))))
        i += 1
    return rows


def test_links_equal_brute_force(spark):
    got, want = run(spark, corpus(1))
    assert got == want and sum(r[2] > 0 for r in want) > 50


def test_recursion_and_blocks_lose_nothing(spark):
    got, want = run(spark, corpus(2), recurse_at=4, block=3)
    assert got == want


def test_edge_rows(spark):
    got, want = run(spark, list(EDGE_TEXTS) + [(20, "short words here"), (21, "SHORT words, here!"), (None, None)])
    assert got == want


def test_empty(spark):
    assert run(spark, [])[0] == []


def test_runs_follow_the_recall():
    assert jaccard.runs_needed(1, 0.9999) == 10
    assert jaccard.runs_needed(3, 0.9999) > jaccard.runs_needed(2, 0.9999) > 10
    assert jaccard.runs_needed(1, 0.9) < jaccard.runs_needed(1, 0.99)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_and_stars(spark, seed):
    from feedloom.session import fresh_dir
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(45)]
    comp = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "u long, v long")
    got = {r["v"]: r["least"] for r in jaccard.components(df, fresh_dir(spark, "components-test")).collect()}
    assert got == {x: c for x, c in comp.items() if x != c}


def test_one_document_of_each_group_stays(spark):
    rows = corpus(4, groups=3) + list(EDGE_TEXTS)
    kept = jaccard.keep_one(docs(spark, rows), "doc_id", "text")
    assert len(kept.columns) == 12
    classes = {}
    ids = [(n, t) for n, (_, t) in enumerate(rows)]
    for (n, c, _, _), (_, t) in zip(near_model(ids), ids):
        classes.setdefault(t or "", c)
    texts = [r["text"] or "" for r in kept.select(F.col("text")).collect()]
    assert sorted(classes[t] for t in texts) == sorted(set(classes.values()))
