"""Licence scans with a positional rare-token index, in DataFrame functions only.

Templates are short texts with the positions of their words as postings.
The corpus gives every template word its inverse document frequency, over all
texts.  For each text the occurrences of the templates' rarest words (the
anchors) are looked up; each occurrence, less the word's position in the
template, is a possible start; starts are intersected with the other postings
by reading the text's words at the same relative positions; a template is
found where its mandatory key phrases stand word for word and the words that
agree hold enough of its IDF weight.  Phrases (the base places) are templates
that must agree in full, so every place is found whatever its anchor is.

Words: A-Z become lower case, a word is a maximal run of [0-9a-z] and
non-ASCII characters.  Word positions count from 0.

Scale: one scan counts document frequencies (at most one row per template
word and task is shuffled), one scan matches inside each row; no row is ever
moved.  The template list is a parameter and bounds all that is broadcast.

Defined results: null or empty texts have no words, no labels and score 0;
repeated rows and null ids are kept; an empty table gives no rows; a word
absent from the corpus gets the highest IDF; extra columns, whatever their
names, are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice, its label and the phrases of it that must stand in full."""
    label: str
    notice: str
    mandatory: tuple[str, ...]


# Wordings of common licence notices.
NOTICES = (
    Template("gpl-2.0", "gnu general public license version 2", ("version 2",)),
    Template("gpl-3.0", "gnu general public license version 3", ("version 3",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             ("with or without fee",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
)


def _with_words(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """Column ``words``: the text's words in their own case."""
    parts = df.select(*keep, F.split(F.coalesce(text.cast("string"), F.lit("")), BREAKS).alias("parts"))
    head = (F.get("parts", F.lit(0)) == "").cast("int")
    last = F.get("parts", F.size("parts") - 1) == ""
    tail = F.when(F.size("parts") > 1, last.cast("int")).otherwise(0)
    return (parts.withColumns({"head": head, "n": F.size("parts") - head - tail})
            .withColumn("words", F.slice("parts", F.col("head") + 1, F.greatest("n", F.lit(0))))
            .drop("parts", "head", "n"))


def word_idf(df: DataFrame, text: Column, vocabulary: list[str]) -> dict[str, float]:
    """ln((texts + 1) / (texts with the word + 1)) of every vocabulary word."""
    listed = F.array(*[F.lit(w) for w in vocabulary])
    found = _with_words(df, text).select(F.array_intersect(F.transform("words", F.lower), listed).alias("w"))
    # A null marks the text itself, so one group-by counts texts and words.
    marked = found.select(F.explode(F.concat(F.col("w"), F.array(F.lit(None).cast("string")))).alias("w"))
    counts = {r["w"]: r["n"] for r in marked.groupBy("w").agg(F.count("*").alias("n")).collect()}
    texts = counts.get(None, 0)
    return {w: math.log((texts + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _weights(words: list[str], idf: dict[str, float]) -> list[float]:
    """Each position's share of the template's IDF weight."""
    given = [idf[w] + 1e-6 for w in words]
    total = sum(given)
    return [g / total for g in given]


def _anchors(words: list[str], weights: list[float], least: float) -> list[int]:
    """Rarest positions, until what is left weighs less than ``least``: a
    match of that weight agrees on at least one of them."""
    order = sorted(range(len(words)), key=lambda j: (-weights[j], j))
    out, left = [], 1.0
    for j in order:
        if left < least:
            break
        out.append(j)
        left -= weights[j]
    return out


def _sql(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _agrees(word: str, j: int) -> str:
    return f"translate(get(words, s + {j}), '{UPPER}', '{LOWER}') <=> {_sql(word)}"


def _starts(words: list[str], anchors: list[int]) -> str:
    """Possible starts, from the occurrences of the anchors."""
    each = [f"transform(filter(seen, a -> a.w = {_sql(words[j])}), a -> a.i - {j})" for j in anchors]
    return f"array_distinct(concat({', '.join(each)}))" if len(each) > 1 else each[0]


def scan(df: DataFrame, id_col: str, text_col: str, phrases=PHRASES, notices=NOTICES,
         least: float = 0.7) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places) per row; ``places`` lists (label, start) of every phrase."""
    text = F.col(text_col)
    split = [(label, phrase.split()) for phrase, label in phrases]
    own = [(t, t.notice.split()) for t in notices]
    vocabulary = sorted({w for _, ws in split for w in ws} | {w for _, ws in own for w in ws})
    idf = word_idf(df, text, vocabulary)

    plans, looked = [], set()
    for _, words in split:
        at = _anchors(words, _weights(words, idf), 1.0)[:1]
        plans.append((words, at))
        looked.add(words[at[0]])
    own_plans = []
    for t, words in own:
        weights = _weights(words, idf)
        at = _anchors(words, weights, least)
        own_plans.append((t, words, weights, at))
        looked |= {words[j] for j in at}

    rows = _with_words(df, text, F.col(id_col).alias("id"))
    listed = ", ".join(_sql(w) for w in sorted(looked))
    rows = rows.withColumn("seen", F.expr(
        f"filter(transform(words, (w, i) -> named_struct('w', lower(w), 'i', i)), a -> a.w in ({listed}))"))

    places = []
    for (label, _), (words, at) in zip(split, plans):
        agree = " and ".join(_agrees(w, j) for j, w in enumerate(words))
        places.append(f"transform(filter({_starts(words, at)}, s -> s >= 0 and {agree}), "
                      f"s -> named_struct('label', {_sql(label)}, 'start', s))")
    matched = []
    for t, words, weights, at in own_plans:
        share = " + ".join(f"if({_agrees(w, j)}, {weights[j]!r}D, 0D)" for j, w in enumerate(words))
        must = " and ".join(_agrees(words[i + k], i + k) for p in t.mandatory
                            for i in [_find(words, p.split())] for k in range(len(p.split())))
        matched.append(f"transform({_starts(words, at)}, s -> named_struct('label', {_sql(t.label)}, "
                       f"'share', least(1D, {share}), 'whole', {must}))")
    rows = (rows.withColumn("n_words", F.size("words").cast("long"))
            .withColumn("places", F.expr(f"if(size(seen) = 0, cast(array() as array<struct<label: string, start: int>>),"
                                         f" array_sort(concat({', '.join(places)})))"))
            .withColumn("found", F.expr(
                f"if(size(seen) = 0, cast(array() as array<struct<label: string, share: double, whole: boolean>>),"
                f" concat({', '.join(matched)}))")))
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.transform(F.filter("found", lambda m: (m["share"] >= least) & m["whole"]), lambda m: m["label"])
    return rows.select(
        "id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("found", lambda m: m["share"])), F.lit(0.0))).alias("score"),
        "places")


def _find(words: list[str], phrase: list[str]) -> int:
    for i in range(len(words) - len(phrase) + 1):
        if words[i:i + len(phrase)] == phrase:
            return i
    raise ValueError(f"a mandatory phrase must stand in its notice: {' '.join(phrase)}")
