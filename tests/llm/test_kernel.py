import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tests.llm.conftest import shingles_of, words_of
from viewstar.llm import kernel as K

TEXT = st.text(alphabet=" \n\t\x0b\x0c\rAaZz09é.|你", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_equal_plain_split(texts):
    buf, off = K.text_bytes(pa.array(texts, pa.string()))
    starts, ends, at = K.words(buf, off, K.BLANK_WORDS)
    got = [[buf[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(at, at[1:])]
    assert got == [words_of(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_shingle_sets_match_sets_of_words(texts):
    got = K.text_shingles(pa.array(texts, pa.string()))
    plain = [shingles_of(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(got[i], got[j])) == len(plain[i] & plain[j])


def test_hash_depends_on_every_byte_of_long_words():
    a, b = "x" * 5000, "x" * 4999 + "y"
    h = K.hash_words([a, b, a, "", "x"])
    assert h[0] == h[2] and len(set(h.tolist())) == 4


def test_pieces_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * 10, None, "", "b" * 100, "c"], pa.string())})
    parts = list(K.pieces(batch, "text", 16))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist() and len(parts) > 1
    assert list(K.pieces(batch.slice(0, 0), "text")) == []
