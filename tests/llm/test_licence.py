import re

from feedloom.llm import licence
from tests.llm.helpers import EDGE_TEXTS, WORD, docs


def model(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = sorted((k, label) for phrase, label in licence.PHRASES
                    for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split())
    return (len(w), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None),
            ",".join(sorted({x for _, x in places})))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "apache license apache license mit license",
    "Released under the MIT License.", "GNU\nGENERAL public-license", "gnu general public licenses", "cc by cc by-nc 4.0",
    "This work is licensed under the GNU General Public License, version 3.", "mit licensé", "Kelvin mit license",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this program",
    "general public license gnu general public", "...mit license", "mit\u0000license", "MIT  License cc\tBY", "İmit license",
]


def test_base_places_equal_brute_force(spark):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + list(EDGE_TEXTS)
    got = licence.scan(docs(spark, rows), "doc_id", "text").collect()
    want = sorted(((i is None, i or 0), model(t)) for i, t in rows)
    have = sorted(((r["id"] is None, r["id"] or 0), (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
                  for r in got)
    assert repr(have) == repr(want)
    by = {r["id"]: r for r in got}
    assert by[100]["labels"] == "apache,apache-2.0" and by[106]["labels"] == "gpl,gpl-3.0"
    assert by[109]["labels"] == "mit" and by[109]["base_labels"] == "" and 0.7 <= by[109]["score"] < 1
    assert by[3]["score"] == 0 and by[3]["labels"] == "" and all(0 <= r["score"] <= 1 for r in got)


def test_mandatory_phrase_decides(spark):
    text = "gnu general public license of this version 2, not " + "x " * 30
    got = licence.scan(docs(spark, [(1, text), (2, "x"), (3, "licensed under the apache license version 3 0")]), "doc_id", "text")
    by = {r["id"]: r["labels"] for r in got.collect()}
    assert by == {1: "gpl", 2: "", 3: "apache"}


def test_empty(spark):
    assert licence.scan(docs(spark, []), "doc_id", "text").count() == 0
