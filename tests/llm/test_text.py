import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import text as T
from tests.llm.helpers import LONG, shingles, words


def check(texts):
    h, ptr = T.words(pa.array(texts, pa.string()))
    model = [words(t) for t in texts]
    assert [len(w) for w in model] == np.diff(ptr).tolist()
    names = {}
    for i, w in enumerate(model):
        for x, y in zip(w, h[ptr[i]:ptr[i + 1]].tolist()):
            assert names.setdefault(x, y) == y
    assert len(set(names.values())) == len(names)
    s, p = T.shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(p).tolist() == [len(shingles(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .,é\n漢Z", max_size=60)), max_size=12))
def test_words_and_shingles_equal_a_regex_model(texts):
    check(texts)


def test_segments_cut_long_texts_between_words(monkeypatch):
    monkeypatch.setattr(T, "_SEGMENT", 64)
    T._tables.cache_clear()
    check([LONG[:5000], "x" * 1000 + " y " + "z" * 300, None, "a b"])
    T._tables.cache_clear()


def test_sliced_columns_and_null_only():
    a = pa.array(["zero", "one two", None, "three"])
    h, ptr = T.words(a.slice(1, 3))
    assert np.diff(ptr).tolist() == [2, 0, 1]
    assert T.words(pa.array([None, None], pa.string()))[1].tolist() == [0, 0, 0]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10] * 5)], names=["t"])
    assert [b.num_rows for b in T.slices(batch, "t", 25)] == [2, 2, 1]
