import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from viewstar.llm import repair as R

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_round_trip_and_ranges(ids, a, b):
    ids = np.array(ids, np.uint32) * 7001
    shard = R.Shard(R.pack(ids))
    assert shard.ids().tolist() == ids.tolist()
    assert shard.read_range(a, b).tolist() == ids[a:b].tolist()


def test_grammar_shrinks_repeats_and_names_only_earlier_symbols():
    ids = np.tile(np.arange(50, dtype=np.uint32), 2000)
    shard = R.Shard(R.pack(ids))
    assert (shard.ids() == ids).all() and len(shard.seq) < len(ids) // 8
    done = len(shard.alphabet)
    for k in shard.levels.tolist():
        r = slice(done - len(shard.alphabet), done - len(shard.alphabet) + k)
        assert shard.left[r].max() < done and shard.right[r].max() < done
        done += k


def reference(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return [e.ids + [R.END_ID] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


ODD = ["<|endoftext|> a<|STARTOFTEXT|>b it's don't 'LL x'y’s İstanbul ΣΑΣ é Éa ...!! a.b.c 12a3  x y\tz\r\nq", "", None, " \n ", "你好 мир",
       "<|endoftext|>", "÷ ß été... naïve!", "x" * 3000, "the The THE the, the."]


def test_encoder_equals_whole_text_encoding():
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    rng = random.Random(7)
    parts = [" ", "\t", "\x0b", "\x0c", "\r\n", "\x85", "\u2003", "\x1c", "<|", "|>", "<|endoftext|>", "<|Endoftext|>", "a", "É", "ß", "don't", "1", "你", "\u0301", "..", "Σ", "\x00", "-"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    for held in (8, 10_000):
        e = R.Encoder(spec, held)
        for k in (1, 40):  # with and without what it holds
            for i in range(0, len(texts), len(texts) // k + 1):
                some = texts[i:i + len(texts) // k + 1]
                ids, sizes = e.encode(pa.array(some, pa.string()))
                at = np.concatenate([[0], np.cumsum(sizes)])
                assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == reference(some)


def test_query_digests(spark, docs_of, monkeypatch):
    rows = [(i * 3 % 40, t) for i, t in enumerate(ODD * 4)] + [(None, "null id"), (77, "word " * 30000)]
    got = R.encoded(docs_of(rows), PATH).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for (i, _), ids in zip(order, reference([t for _, t in order])):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda x: x[1]
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=key) == want
    assert R.encoded(docs_of([]), PATH).collect() == []


def test_texts_over_several_shards(spark, docs_of, tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    big = "alpha beta gamma delta " * 700_000  # over two shards
    docs = docs_of([(1, "one two"), (2, big), (3, "three")])
    R.write_shards(docs.coalesce(1), f"file://{tmp_path}/s", spec)
    got = {r.doc_id: r for r in R.read_digests(spark, f"file://{tmp_path}/s").collect()}
    ids = reference(["one two", big, "three"])
    assert [got[i].n_tokens for i in (1, 2, 3)] == [len(x) for x in ids] and len(ids[1]) > 2 * R.SHARD
    assert [got[i].ids_crc32 for i in (1, 2, 3)] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    assert got[3].start == len(ids[0]) + len(ids[1])
