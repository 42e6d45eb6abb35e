import zlib

import numpy as np
import pyarrow as pa

from feedloom.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs


def toy(n=600, seed=0):
    rng = np.random.default_rng(seed)
    good = [" ".join(rng.choice(["river", "stone", "light", "garden", "over"], 12)) + "." for _ in range(n)]
    bad = [" ".join(rng.choice(["river", "stone", "light", "garden", "over"], 12)).upper() + "!!! $$$" for _ in range(n)]
    return good, bad


def test_pair_term_equals_all_pairs():
    good, bad = toy(20)
    bucket, value, ptr, stats = quality.features(pa.array(good + bad), [])
    model = quality.train(bucket, value, ptr, stats, [1] * 20 + [0] * 20, epochs=2)
    index, x, out = model.inputs(bucket, value, ptr, stats)
    y, _, _ = model.margin(index, x, out)
    for r in range(0, 40, 7):
        ix, xx = index[out[r]:out[r + 1]], x[out[r]:out[r + 1]].astype(float)
        v = model.factors[ix].astype(float)
        pairs = sum(v[a] @ v[b] * xx[a] * xx[b] for a in range(len(ix)) for b in range(a))
        assert abs(y[r] - (model.bias + (model.linear[ix] * xx).sum() + pairs)) < 1e-3


def test_features_of_a_row_do_not_depend_on_the_batch():
    texts = [t for _, t in EDGE_TEXTS]
    one = quality.features(pa.array(texts, pa.string()), [])
    for i, t in enumerate(texts):
        b, v, p, s = quality.features(pa.array([t], pa.string()), [])
        lo, hi = one[2][i], one[2][i + 1]
        assert (one[0][lo:hi] == b).all() and np.allclose(one[1][lo:hi], v) and np.allclose(one[3][i], s[0])


def test_learns_and_keeps_the_held_out_third(spark):
    good, bad = toy()
    rows = [(i, t) for i, t in enumerate(good + bad)]
    label = {i: int(i < len(good)) for i, _ in rows}
    # Labels of held-out rows are wrong: they must not be learned.
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in label}
    labels = spark.createDataFrame([(i, 1 - q if held[i] else q, 7) for i, q in label.items()]
                                   + [(None, 1, 0), (5000, 1, 0), (0, None, 0), (1, 9, 0)],
                                   "doc_id long, quality int, score int")
    df = docs(spark, rows + [(None, good[0]), (9000, None), (9001, "")])
    model = quality.fit(df, labels, "doc_id", "text", "quality", ("n_chars",))
    got = {r["id"]: r for r in quality.score(df, model, "doc_id", "text", ("n_chars",)).collect()}
    assert len(got) == len(rows) + 3
    assert all(got[i]["predicted"] == q and got[i]["held_out"] == held[i] for i, q in label.items())
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[None]["held_out"] is False
    kept = quality.keep_good(df, model, "text", ("n_chars",))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id < 5000").collect()) == [i for i, q in label.items() if q]


def test_bounds_of_the_sample(spark):
    good, bad = toy(200)
    df = docs(spark, list(enumerate(good + bad)))
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id long, quality int")
    model = quality.fit(df, labels, "doc_id", "text", "quality", max_rows=60, max_nonzeros=250)
    used = int(np.count_nonzero(model.linear[:1 << quality.WORD_BITS]))
    assert 0 < used <= 250


def test_one_label_or_none_or_empty(spark):
    df = docs(spark, [(i, f"text {i}") for i in range(9)])
    for rows in ([], [(i, 1) for i in range(9)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        model = quality.fit(df, labels, "doc_id", "text", "quality")
        got = quality.score(df, model, "doc_id", "text").collect()
        assert len(got) == 9 and len({r["score"] for r in got}) == 1
    assert quality.score(docs(spark, []), model, "doc_id", "text").count() == 0
    assert quality.keep_good(docs(spark, []), model, "text").count() == 0


def test_held_out_accuracy_on_documents(spark):
    d = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/labels.parquet")
    model = quality.fit(d, labels, "doc_id", "text", "quality", ("n_chars",))
    got = (quality.score(d, model, "doc_id", "text", ("n_chars",)).join(labels.withColumnRenamed("doc_id", "id"), "id")
           .where("held_out").selectExpr("count(*) n", "count_if(predicted = quality) ok").first())
    assert got["n"] > 1000 and got["ok"] >= 0.98 * got["n"]
