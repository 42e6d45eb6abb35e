import itertools
import math
import random

from feedloom.llm import decontam
from tests.llm.helpers import EDGE_TEXTS, docs, words


def test_masks_hit_every_window_with_two_substitutions():
    span = decontam.SPAN
    assert all(m[-1] + 1 == span and len(m) == 6 for m in decontam.MASKS)
    for wrong in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(all(p + o not in wrong for o in m) for m in decontam.MASKS
                   for p in range(decontam.WINDOW - span + 1))
    assert decontam.WINDOW - math.ceil(decontam.SHARE * decontam.WINDOW - 1e-9) == 2


def model(rows, items):
    """(id, item) pairs by comparing every alignment."""
    out = set()
    for i, t in rows:
        w = words(t)
        for item, text in items:
            x = words(text)
            if not x:
                continue
            n = min(decontam.WINDOW, len(x))
            for shift in range(-len(x), len(w)):
                same = [0 <= shift + j < len(w) and w[shift + j] == x[j] for j in range(len(x))]
                least = decontam.SHARE * n - 1e-9 if n >= 5 else n
                if any(sum(same[k:k + n]) >= least for k in range(len(x) - n + 1)):
                    out.add((i, item))
    return out


def test_masks_of_short_items_hit_every_substitution():
    for n in range(1, decontam.WINDOW):
        wrong = n - decontam._least(n, decontam.SHARE)
        assert wrong == (0 if n < 5 else 1 if n < 10 else 2)
        for bad in itertools.combinations(range(n), wrong):
            assert any(all(p + o not in bad for p in m) for m in decontam.masks_for(n, wrong) for o in range(n - m[-1])), (n, bad)
        assert len(decontam.masks_for(n, wrong)) <= 4


def vocabulary(n):
    return [f"word{i}" for i in range(n)]


def leaks(spark, rows, items):
    bench = spark.createDataFrame([(i, t, "k", 1) for i, t in items], "item_id long, text string, hash string, n int")
    return decontam.find_leaks(docs(spark, rows), bench, "doc_id", "text").collect()


def test_substituted_passages_equal_brute_force(spark):
    rng = random.Random(3)
    v = vocabulary(400)
    items = [(i, " ".join(rng.choices(v, k=rng.choice([2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 20, 40])))) for i in range(60)]
    items += [(90, items[3][1]), (91, None), (92, ""), (93, "two words"), (None, items[4][1] + " x")]
    rows = []
    for d in range(360):
        body = rng.choices(v, k=rng.randint(0, 80))
        if d % 2:
            leak = words(items[d % 60][1])
            lo = rng.randint(0, max(0, len(leak) - 13)) if d % 3 else 0
            leak = leak[lo:lo + rng.randint(10, 40)]
            for _ in range(d // 2 % 4):
                leak[rng.randrange(len(leak))] = "other"
            at = rng.randint(0, len(body))
            body = body[:at] + leak + body[at:]
        rows.append((d, " ".join(body).upper()))
    rows += EDGE_TEXTS[2:]
    got = leaks(spark, rows, items)
    want = model([r for r in rows if r[0] != 8 and r[0] is not None], [x for x in items if x[0] != 90])
    assert {(r["id"], r["item"]) for r in got} == want and len(want) > 20


def test_spans_and_best_alignment(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    text = "x x x " + item.replace("delta", "changed") + " y " + item + " z"
    r, = leaks(spark, [(5, text), (6, None)], [(1, item)])
    assert (r["id"], r["item"], r["matched"], r["item_words"], r["overlap"]) == (5, 1, 14, 14, 1.0)
    assert (r["text_start"], r["text_end"], r["item_start"], r["item_end"]) == (18, 32, 0, 14)


def test_rows_with_one_leak_only_and_empty_tables(spark):
    item = " ".join(vocabulary(20))
    assert leaks(spark, [], [(1, item)]) == [] and leaks(spark, [(1, item)], []) == []
    assert {(r["id"], r["item"]) for r in leaks(spark, [(1, item), (1, item), (None, item), (2, "clean")], [(1, item), (7, item)])} \
        == {(1, 1), (None, 1)}
    kept = decontam.without_leaks(docs(spark, [(1, item), (2, "clean"), (3, None), (2, "clean")]),
                                  spark.createDataFrame([(1, item)], "item_id long, text string"), "text")
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 2, 3] and len(kept.columns) == 12


def test_short_and_unnamed_items_are_removed(spark):
    long = " ".join(vocabulary(14))
    ten = " ".join(f"ten{i}" for i in range(10))
    bench = spark.createDataFrame([(1, "alpha beta gamma delta"), (None, long), (2, ten), (None, "one two six")], "item_id long, text string")
    rows = [(1, "x alpha beta gamma delta y"), (2, "so " + long + " it"), (3, ten.replace("ten4", "other")),
            (4, "alpha beta gamma other"), (5, "one two three"), (6, None), (7, "and one two six")]
    got = decontam.find_leaks(docs(spark, rows), bench, "doc_id", "text").collect()
    assert sorted((r["id"], r["item"], r["matched"]) for r in got if r["item"]) == [(1, 1, 4), (3, 2, 9)]
    assert sorted(r["id"] for r in got if r["item"] is None) == [2, 7]
    named = docs(spark, rows).withColumnRenamed("key", "key_").selectExpr("*", "1 AS key", "2 AS __key")
    kept = decontam.without_leaks(named, bench, "text")
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6] and kept.columns == named.columns
    assert {(r["key"], r["__key"]) for r in kept.collect()} == {(1, 2)}
