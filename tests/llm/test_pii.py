import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import pii
from feedloom.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm.helpers import EDGE_TEXTS, docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def check_digit(number):
    odd, even = number[-1::-2], number[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def model(text):
    """Spans of the fixed forms by the plain patterns."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(number) <= 19 and check_digit(number)):
                continue
            if kind == "phone" and not 9 <= len(number) <= 15:
                continue
            out.append((k, *m.span()))
    return out


HAND = ["a@b.c@d.e f.g@h-i.j.k, @x.y a@@b.c a@b a@b. .a@b.c.", "1.2.3.45.6.7.8 256.1.1.1 001.0002.3.4 1.2..3.4.5.6 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 1--4111111111111111 4111  1111", "+1 (509) 555-6973 +12 +1 2 ++1 234 567 89 10- +1.2.3.4.5.6.7.8.9",
        "é" * 50 + "x@y.zz ＠ 0", "card 4111111111111111@host.org +4111111111111111"]


def test_fixed_forms_by_hand():
    for text in HAND:
        assert pii.base_spans(text) == model(text), text


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "+", " ", "-", "(", ")", "a", "Z9", "1", "25", "255", "4111", "1111111", "x.y", "é", "\n", "%"]),
                max_size=40).map("".join))
def test_fixed_forms_equal_plain_patterns(text):
    assert pii.base_spans(text) == model(text)


def test_fixed_forms_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "a." * 150_000 + "@"):
        pii.base_spans(text)
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [(1, 0, 5007)]


def test_gradients_equal_differences():
    m, rng = pii.new_model(1, 4, 3, np.float64), np.random.default_rng(2)
    for p in m.parts():
        p += 0.1 * rng.normal(size=p.shape)
    sym = rng.integers(0, pii.SYMBOLS, (3, 7))
    tags = np.array([[0, 1, 2, 2, 0, 3, 4], [5, 6, 0, 0, 7, 8, 8], [0, 0, 1, 1, 2, 0, 0]])
    _, grads = pii.loss_and_gradients(m, sym, tags)
    for p, g in zip(m.parts(), grads):
        for _ in range(5):
            i, old = tuple(int(rng.integers(n)) for n in p.shape), None
            old, p[i] = p[i], p[i] + 1e-5
            up = pii.loss_and_gradients(m, sym, tags)[0]
            p[i] = old - 1e-5
            down = pii.loss_and_gradients(m, sym, tags)[0]
            p[i] = old
            assert abs((up - down) / 2e-5 - g[i]) < 1e-6


def test_log_total_and_best_path_equal_enumeration():
    rng = np.random.default_rng(3)
    emit, trans, first = rng.normal(size=(4, 1, pii.TAGS)), rng.normal(size=(pii.TAGS, pii.TAGS)), rng.normal(size=pii.TAGS)
    paths = np.array(np.meshgrid(*[range(pii.TAGS)] * 4, indexing="ij")).reshape(4, -1)
    score = first[paths[0]] + sum(emit[t, 0][paths[t]] for t in range(4)) + sum(trans[paths[t - 1], paths[t]] for t in range(1, 4))
    assert np.isclose(pii._sums(emit, trans, first)[2][0], np.log(np.exp(score).sum()))
    emit = rng.normal(size=(6, 5, pii.TAGS)) * 5
    trans, first = trans - 1e4 * pii.FORBIDDEN, first - 1e4 * pii.FORBIDDEN_FIRST
    fwd, bwd, total = pii._sums(emit, trans, first)
    assert np.allclose(pii.tag_probabilities(emit, trans, first), np.exp(fwd + bwd - total[:, None]))
    p = rng.dirichlet(np.ones(pii.TAGS), 4)
    allowed = ~pii.FORBIDDEN_FIRST[paths[0]] & ~np.any([pii.FORBIDDEN[paths[t - 1], paths[t]] for t in range(1, 4)], axis=0)
    product = np.where(allowed, np.prod([p[t][paths[t]] for t in range(4)], axis=0), -1)
    assert pii.best_path(p).tolist() == paths[:, product.argmax()].tolist()


@pytest.fixture(scope="module")
def trained(spark):
    """A model fitted on two thirds of the pieces, and the rest of them."""
    found = pii.pieces(spark.read.parquet(f"{SF_SMALL[:-3]}1/documents.parquet"), "text", 1500)
    return pii.train(*pii.examples(found[::3] + found[1::3])), found[2::3]


def test_other_writings_are_found_in_held_out_pieces(trained):
    m, rest = trained
    rng = np.random.default_rng(8)
    hit = total = wrong = 0
    texts, truth = [], []
    for piece in rest:
        spans = pii.base_spans(piece)[:1]
        for kind, a, b in spans:
            new = pii._rewritten(kind, piece[a:b], rng)
            texts.append(piece[:a] + new + piece[b:])
            truth.append((kind, a, a + len(new)))
    bases = [pii.base_spans(t) for t in texts]
    for t, base, want, got in zip(texts, bases, truth, pii.added_spans(m, texts, bases)):
        if any(a < want[2] and want[1] < b for _, a, b in base):
            continue  # a fixed form all the same
        total += 1
        hit += want in got
        wrong += sum(g != want and g[0] != want[0] for g in got)
    assert total > 60 and hit >= 0.85 * total and wrong <= 0.05 * total


def test_prose_numbers_and_decoys_are_left_alone(trained):
    m, _ = trained
    rng = np.random.default_rng(11)
    texts = [f"in the year of {pii._decoy(rng)} they went on and on" for _ in range(200)]
    added = pii.added_spans(m, texts, [pii.base_spans(t) for t in texts])
    assert sum(map(bool, added)) <= 2


def test_long_stretches_and_window_edges(trained, monkeypatch):
    m, _ = trained
    monkeypatch.setattr(pii, "LONG", 2000)
    monkeypatch.setattr(pii, "LAP", 300)
    text = "".join(f"word {i} and (509) 555-6{i:03d} of it. " for i in range(300))
    assert len(pii.stretches(text)) > 3 and all(b - a <= 2000 for a, b in pii.stretches(text))
    got = pii.added_spans(m, [text], [[]])[0]
    want = {(3, t.start(), t.end()) for t in re.finditer(r"\(509\) 555-\d{4}", text)}
    assert len(want & set(got)) >= 0.95 * len(want) and all(a[2] <= b[1] for a, b in zip(got, got[1:]))


def test_texts_of_every_kind(spark, trained):
    rows = [*EDGE_TEXTS, *enumerate(HAND, 30), (30, HAND[0]), (None, HAND[1]), (40, "1" * 100_000), (41, "call (509) 555-6973 now")]
    got = pii.find_pii(docs(spark, rows), trained[0], "doc_id", "text").collect()
    names = list(PATTERNS)
    base = sorted(repr((r["id"], [(names.index(s["kind"]), s["start"], s["end"]) for s in r["base"]])) for r in got)
    assert base == sorted(repr((i, model(t))) for i, t in rows)
    for r in got:
        spans = [(names.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
    assert [tuple(s) for s in next(r for r in got if r["id"] == 41)["spans"]] == [("phone", 5, 19)]
    assert pii.find_pii(docs(spark, []), trained[0], "doc_id", "text").count() == 0
    assert pii.fit(docs(spark, [(1, "no data"), (2, None)]), "text") is None and pii.fit(docs(spark, []), "text") is None


def test_query_holds_the_fixed_forms(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    names = list(PATTERNS)
    for r in Q.QUERIES["op12_personal_data"](spark, SF_SMALL).collect():
        want = [f"{names[k]}:{a}:{b}" for k, a, b in model(rows[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) | {""}
        assert [r[f"n_{n}"] for n in names] == [sum(w.startswith(n) for w in want) for n in names]
