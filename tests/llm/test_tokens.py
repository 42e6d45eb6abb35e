import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from feedloom.llm import tokens  # noqa: E402
from feedloom.llm.pieces import Pieces  # noqa: E402
from feedloom.llm.tokenizer import Encoder, version  # noqa: E402
from feedloom.session import fresh_dir  # noqa: E402
from tests.llm.helpers import EDGE_TEXTS, docs  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["<|endoftext|>", "a<|endoftext|> b", "  <|endoftext|>  \n", " " * 50, "\t x", "don't 'S", "é à", "漢字 1234",
       "\n\n x", "<|endof", "\x00\x01", "👍🏽 ok", "a" * 5000, "x" + " " * 3000 + "y"]


def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_fast_encoder_equals_the_library():
    e = Encoder(BYTE_BPE)
    assert e._fast is not None
    texts = ODD + [t or "" for _, t in EDGE_TEXTS]
    assert [e.ids(t).tolist() for t in texts] == library_ids(texts)


def test_every_code_point_is_split_alike():
    e = Encoder(BYTE_BPE)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    points += [*range(0x20000, 0x110000, 257)]
    texts = ["".join(f"ab{chr(c)}c 1{chr(c)}2 !{chr(c)}? {chr(c)} " for c in points[i:i + 50])
             for i in range(0, len(points), 50)]
    assert [e.ids(t).tolist() for t in texts] == library_ids(texts)


def test_pieces_of_every_code_point():
    e = Encoder(BYTE_BPE)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    points += [*range(0x20000, 0x110000, 257)]
    texts = ["".join(f"ab{chr(c)}c 1{chr(c)}2 !{chr(c)}? {chr(c)} {chr(c)}{chr(c)}'s" for c in points[i:i + 50])
             for i in range(0, len(points), 50)]
    texts += [chr(c) for c in points[:0x3100]]
    judged, _ = e._pieces.ids_of(texts)
    assert sum(judged) > len(texts) / 2
    for i in range(0, len(texts), 3000):
        for text, got in zip(texts[i:i + 3000], e.many(texts[i:i + 3000])):
            assert got.tolist() == e.ids(text).tolist(), text


@pytest.mark.parametrize("bits", [1, 6, 16])
def test_pieces_of_random_texts(bits):
    import random

    rng, e = random.Random(bits), Encoder(BYTE_BPE)
    e._pieces = Pieces(e._pieces.encode, e._pieces.special, bits)
    parts = [" ", "  ", "\n", "\t", "\u00a0", "'", "''", "s", "t", "re", "ve", "ll", "d", "m", "'s", "'ll", "'re", "S", "é",
             "漢", "the", "Tokenisation", "1", "23", "!", "...", "\x00", "\x1c", "👍", "\u0301", "x" * 40, "\U000e0fff", "<|endoftext|>"]
    for _ in range(60):
        texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(rng.randrange(1, 40))]
        assert [x.tolist() for x in e.many(texts)] == [e.ids(t).tolist() for t in texts]


def test_many_equals_the_library():
    e, texts = Encoder(BYTE_BPE), ODD + [t or "" for _, t in EDGE_TEXTS] + ["", "word " * 300_000]
    assert [x.tolist() for x in e.many(texts)] == library_ids(texts) and e.many([]) == [] and e.many([""])[0].tolist() == []


def test_text_the_pattern_engine_refuses():
    text = " " * 2_000_000 + "x"
    assert Encoder(BYTE_BPE).ids(text).tolist() == library_ids([text])[0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_use_their_own_library(name):
    path = public_tokenizers.path(name)
    e = Encoder(path)
    if name.endswith(".model"):
        import sentencepiece
        want = sentencepiece.SentencePieceProcessor(model_file=path).encode("Hello there, world")
    else:
        from tokenizers import Tokenizer
        want = Tokenizer.from_file(path).encode("Hello there, world", add_special_tokens=False).ids
    assert e.ids("Hello there, world").tolist() == want and e.ids("").tolist() == []
    assert version(path) != version(BYTE_BPE)


def test_counts_and_cache(spark, monkeypatch):
    cache = fresh_dir(spark, "cache-test")
    rows = EDGE_TEXTS + [(30 + i, t) for i, t in enumerate(ODD)]
    got = tokens.count_tokens(docs(spark, rows), "doc_id", "text", BYTE_BPE, cache).collect()
    want = [(i, len((t or "").encode()), len(ids), len(ids) > 1024)
            for (i, t), ids in zip(rows, library_ids([t or "" for _, t in rows]))]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)
    folder = f"{cache}/{version(BYTE_BPE)}"
    distinct = len({t or "" for _, t in rows})
    assert spark.read.parquet(folder).count() == distinct
    # A second run encodes only what is new.
    more = rows + [(99, "something new")]
    again = tokens.count_tokens(docs(spark, more), "doc_id", "text", BYTE_BPE, cache).collect()
    assert len(again) == len(more) and spark.read.parquet(folder).count() == distinct + 1
    assert sorted((tuple(r) for r in again if r["id"] != 99), key=order) == sorted(want, key=order)


def test_counts_appended_twice_are_one(spark):
    cache = fresh_dir(spark, "cache-test")
    df = docs(spark, [(1, "hello there"), (2, "hello there")])
    tokens.count_tokens(df, "doc_id", "text", BYTE_BPE, cache)
    folder = f"{cache}/{version(BYTE_BPE)}"
    spark.read.parquet(folder).write.mode("append").parquet(folder + "-copy")
    spark.read.parquet(folder + "-copy").write.mode("append").parquet(folder)
    got = tokens.count_tokens(df, "doc_id", "text", BYTE_BPE, cache).collect()
    assert [(r["id"], r["n_tokens"]) for r in sorted(got)] == [(1, 2), (2, 2)]


def test_empty(spark):
    assert tokens.count_tokens(docs(spark, []), "doc_id", "text", BYTE_BPE, fresh_dir(spark, "cache-test")).count() == 0
