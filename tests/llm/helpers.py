"""Small inputs and independent models shared by the tests."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(60_000))

EDGE_TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from here today"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from here today"),
    (3, None), (4, ""), (5, "!!! ??"), (6, "one"), (7, "one two three"), (None, "a text without an id stands here"),
    (8, LONG), (9, "Ünïcode wörds éclair 漢字 stand here too, übrigens"), (6, "one"), (10, "\n\n\n"),
    (11, "GNU General Public License, and the MIT License."),
]

# Names that operators use inside: extra columns must not disturb them.
CLASHES = "key string, words string, shard int, id string, n long, size string, digest string, score string, label string"


def words(text):
    return WORD.findall((text or "").lower())


def docs(spark, rows=None, id_type="long"):
    """documents with extra columns of clashing names, over three partitions."""
    rows = EDGE_TEXTS if rows is None else rows
    schema = (f"doc_id {id_type}, text string, lang string, source string, n_chars long, "
              "key string, words string, shard int, id string, n long, digest string, score string")
    full = [(i, t, None, "s", None if t is None else len(t), "k", None, 3, "x", 1, None, "0.5") for i, t in rows]
    df = spark.createDataFrame(full, schema)
    return df.repartition(3) if full else df


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_model(rows, threshold=0.8, k=5):
    """[(id, class id, links, set links)] by brute force; no words: one class."""
    sets = [shingles(t, k) for _, t in rows]
    distinct = list(dict.fromkeys(sets))
    count = {s: sets.count(s) for s in distinct}
    linked = {s: [] for s in distinct}
    for a in range(len(distinct)):
        for b in range(a):
            x, y = distinct[a], distinct[b]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                linked[x].append(y)
                linked[y].append(x)
    comp = {}
    for s in distinct:
        if s not in comp:
            stack, comp[s] = [s], s
            while stack:
                for y in linked[stack.pop()]:
                    if y not in comp:
                        comp[y] = s
                        stack.append(y)
    least = {}
    for (i, _), s in zip(rows, sets):
        if i is not None:
            least[comp[s]] = min(least.get(comp[s], i), i)
    return [(i, least.get(comp[s]), count[s] - 1 + sum(count[y] for y in linked[s]), len(linked[s]))
            for (i, _), s in zip(rows, sets)]
