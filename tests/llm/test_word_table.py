import numpy as np
from hypothesis import given, settings, strategies as st

from viewstar.llm.word_table import WordTable


def spans(words):
    data = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words]).astype(np.int64)
    return np.frombuffer(data + bytes(8), np.uint8).copy(), ends - [len(w.encode()) for w in words], ends


def ids_of(word):
    return [ord(c) % 1000 for c in word]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.text("abé", min_size=1, max_size=12), min_size=1, max_size=60), min_size=1, max_size=12), st.integers(4, 40))
def test_ids_of_every_word_with_any_limit(pieces, limit):
    asked = []

    def tokenize(words):
        asked.extend(words)
        return [ids_of(w) for w in words]
    table, most = WordTable(tokenize, limit), 0
    for words in pieces:
        most = max(most, len(set(words)))
        ids, sizes = table.ids(table.lookup(*spans(words)))
        assert ids.tolist() == [i for w in words for i in ids_of(w)] and sizes.tolist() == [len(w) for w in words]
        assert table.n <= max(limit, limit // 2 + most)


def test_words_in_use_stay():
    asked = []

    def tokenize(words):
        asked.extend(words)
        return [ids_of(w) for w in words]
    table = WordTable(tokenize, 100)
    for k in range(50):
        table.lookup(*spans(["the", "of"] + [f"w{k}x{j}" for j in range(20)]))
    assert asked.count("the") == 1 and asked.count("of") == 1 and len(asked) == 2 + 50 * 20
