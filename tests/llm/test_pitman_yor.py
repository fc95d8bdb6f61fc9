import math
import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import words_of
from viewstar.llm import pitman_yor as P


def corpus(n=150):
    rng = random.Random(6)
    a, b = [f"aa{i}" for i in range(40)], [f"bb{i}" for i in range(40)]
    rows = []
    for i in range(n):
        own, head = (a, "the") if i % 2 else (b, "le")
        rows.append((i, " ".join(rng.choice([head, rng.choice(own)]) for _ in range(rng.randint(0, 60)))))
    return rows


def run(docs_of, rows):
    return P.language_model_scores(docs_of(rows), F.col("doc_id") % 7 == 2).collect()


def test_counts_and_base_score_equal_plain_version(spark, docs_of):
    rows = corpus() + [(900, None), (901, " \n"), (902, "The THE aa1 new"), (None, "the aa1"), (903, "aa1 " * 40000), (5, "bb1 le"), (7 * 40 + 2, "unseen words")]
    got = run(docs_of, rows)
    assert len(got) == len(rows)
    train = Counter()
    for i, t in rows:
        if i is None or i % 7 != 2:
            train.update(words_of(t) + [None])
    n, v = sum(train.values()), len(train)
    want = sorted((i or -1, len(words_of(t)) + 1, sum(train[w] > 0 for w in words_of(t) + [None]),
                   round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words_of(t) + [None]), 6)) for i, t in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert all(r.held_out == (r.doc_id is not None and r.doc_id % 7 == 2) and r.score < 0 for r in got)


def test_context_beats_the_base_on_held_out_texts(spark, docs_of):
    held = [r for r in run(docs_of, corpus(300)) if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """All words of one context, known and unknown, share out probability 1."""
    rng = np.random.default_rng(3)
    words = (rng.integers(1, 2**40, 300).astype(np.uint64)) << np.uint64(8)
    keys = np.unique(np.concatenate([words, words[:150] | np.uint64(1)]))
    count = rng.integers(0, 30, len(keys))
    count[keys & np.uint64(255) == 0] += 1
    g = P.Group(keys, count, 1, (0.6, 0.5))
    others = {"t": np.zeros(256), "s": 0.0}
    base = (0.7 / 300, 0.3)
    for _ in range(4):
        g.sweep(others, base)
    p, new, t = g.parent(others, base)
    unknown = new * base[1] / (P.THETA + t.sum())
    assert abs(p.sum() + unknown - 1) < 1e-9
    x = 1
    mine = g.ctx == x
    back = (P.THETA + g.d[1] * t[x]) / (P.THETA + g.totals()["c"][x])
    inside = g.predictive(others, base, g.totals()["c"])[mine].sum()
    outside = np.setdiff1d(np.arange(g.words), g.word[mine])
    assert abs(inside + back * (p[outside].sum() + unknown) - 1) < 1e-9


def test_seating_matches_a_plain_restaurant():
    rng = random.Random(1)

    def plain(c, a, d):
        t = 0
        for j in range(c):
            t += j == 0 or rng.random() * (a + j - d * t) < a
        return t
    for c, a, d in ((1, 0.5, 0.5), (40, 2.0, 0.3), (900, 5.0, 0.5), (5000, 1.0, 0.2)):
        want = np.mean([plain(c, a, d) for _ in range(300)])
        got = P.seat(np.full(4000, c), np.full(4000, a), d, np.random.default_rng(2)).mean()
        assert abs(got - want) < 0.08 * want + 0.05


def test_packing():
    for v in ([], [0], [5, 2**40, 3]):
        assert P.unpack(P.pack(np.array(v, np.uint64))).tolist() == v


def test_empty_and_untrained(spark, docs_of):
    assert run(docs_of, []) == []
    got = run(docs_of, [(2, "only held out"), (9, None)])
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0), (0, 0)] and all(r.base_score == 0 and -9 < r.score <= 0 for r in got)
    assert SimpleNamespace(**got[0].asDict()).held_out


def test_previous_word_is_the_context(spark, docs_of):
    """On a vocabulary without frequent words only the previous word tells the next."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        at = rng.randrange(300)
        rows.append((i, " ".join(f"w{(at + k) % 300}" for k in range(30))))
    held = [r for r in run(docs_of, rows) if r.held_out]
    assert held and sum(r.score for r in held) > 0.3 * sum(r.base_score for r in held)


def test_a_single_group_has_no_others():
    """What the first round told of a group itself is no other group's."""
    rng = np.random.default_rng(5)
    asked = pa.Table.from_batches(P._asker(P.Deal(0))(iter([pa.RecordBatch.from_pydict({
        "text": [" ".join(f"w{x}" for x in rng.zipf(1.3, 20000) % 500)], "train": [True], "split": pa.array([0], pa.int64()), "block": pa.array([0], pa.int64())})])))
    told = P._summed(P._first_round(P.Deal(0))(asked))
    total = P.Totals(np.array(told.column("facts")[0].as_py()))
    seen = []

    class Spy(P.Group):
        def sweep(self, others, base):
            seen.append(others)
            super().sweep(others, base)
    was, P.Group = P.Group, Spy
    try:
        P._second_round(total, P.Deal(0))(asked, told)
    finally:
        P.Group = was
    assert len(seen) == P.BURN_IN + P.SAMPLES
    assert all(o["s"] == 0 and o["all"] == 0 and not o["t"].any() for o in seen)


def plain_scores(rows, d, base, rounds=400, burn=100, seed=4):
    """Every text's mean score by a sampler whose customers leave and come back one by one, tables and all."""
    rng = random.Random(seed)
    d_top, d_low = d
    train, held = [], {}
    for i, text in rows:
        ws = [None, *words_of(text), None]
        pairs = list(zip(ws, ws[1:]))
        held[i] = pairs
        if i % 7 != 2:
            train += pairs
    low, top = {}, {}   # (context, word) -> sizes of tables; word -> sizes of the parent's tables
    c_of, t_of, n_top, k_top = Counter(), Counter(), 0, 0

    def p_top(w):
        tables = top.get(w, [])
        known = base[0] if w in vocabulary else base[1]
        return (sum(tables) - d_top * len(tables) + (1 + d_top * k_top) * known) / (1 + n_top)

    def p_low(x, w):
        tables = low.get((x, w), [])
        return (sum(tables) - d_low * len(tables) + (1 + d_low * t_of[x]) * p_top(w)) / (1 + c_of[x])

    def join(tables, d, new):
        at = rng.random() * (sum(tables) - d * len(tables) + new)
        for j, size in enumerate(tables):
            at -= size - d
            if at < 0:
                tables[j] += 1
                return False
        tables.append(1)
        return True

    def leave(tables):
        j = rng.choices(range(len(tables)), tables)[0]
        tables[j] -= 1
        if not tables[j]:
            tables.pop(j)
            return True
        return False

    def come(x, w):
        nonlocal n_top, k_top
        c_of[x] += 1
        if join(low.setdefault((x, w), []), d_low, (1 + d_low * t_of[x]) * p_top(w)):
            t_of[x] += 1
            k_top += join(top.setdefault(w, []), d_top, (1 + d_top * k_top) * base[0])
            n_top += 1
    vocabulary = {w for _, w in train}
    for x, w in train:
        come(x, w)
    mean = Counter()
    for turn in range(rounds):
        for x, w in train:
            c_of[x] -= 1
            if leave(low[x, w]):
                t_of[x] -= 1
                k_top -= leave(top[w])
                n_top -= 1
            come(x, w)
        if turn >= burn:
            for pair in {p for ps in held.values() for p in ps}:
                mean[pair] += p_low(*pair) / (rounds - burn)
    return {i: sum(math.log10(mean[p]) for p in ps) for i, ps in held.items()}


def seen_totals(monkeypatch):
    made = []

    class Spy(P.Totals):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)
    monkeypatch.setattr(P, "Totals", Spy)
    return made


def test_scores_equal_a_plain_sampler(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{min(int(rng.paretovariate(0.8)), 60)}" for _ in range(rng.randint(5, 25)))) for i in range(60)]
    made = seen_totals(monkeypatch)
    got = {r.doc_id: r for r in run(docs_of, rows)}
    want = plain_scores(rows, made[0].d, made[0].base)
    error = [(r.score - want[i]) / r.n_tokens for i, r in got.items()]
    print("plain sampler, a token: mean", np.mean(error), "largest", np.abs(error).max())
    assert abs(np.mean(error)) < 0.02 and np.abs(error).max() < 0.06


def test_scores_hardly_depend_on_groups_and_pieces(spark, docs_of, monkeypatch):
    rng = random.Random(10)
    rows = [(i, " ".join("the" if rng.random() < 0.33 else f"w{min(int(rng.paretovariate(0.5)), 3000)}" for _ in range(60))) for i in range(400)]
    size = sum(len(t) for _, t in rows)
    deals, made = [], seen_totals(monkeypatch)
    plan = P._deal
    monkeypatch.setattr(P, "_deal", lambda *a: deals.append(plan(*a)) or deals[-1])
    found = []
    for groups in (1, 4, 16):
        monkeypatch.setattr(P, "GROUP_BYTES", size / groups + 1)
        found.append({r.doc_id: r for r in run(docs_of, rows)})
    assert [d.bits for d in deals] == [0, 2, 4]
    the = P.hash_words(["the"]) & ~P._CTX
    assert not len(deals[0].hot) and all(d.found(the)[0] >= 0 and d.parts[d.found(the)[0]] > 1 for d in deals[1:])
    assert len({(m.tokens, m.vocabulary) for m in made}) == 1
    for other in found[1:]:
        assert all(other[i][:6] == r[:6] for i, r in found[0].items())
        gap = [(other[i].score - r.score) / r.n_tokens for i, r in found[0].items()]
        print("groups, a token: mean", np.mean(gap), "largest", np.abs(gap).max())
        assert abs(np.mean(gap)) < 0.02 and np.abs(gap).max() < 0.1


def test_pairs_of_a_frequent_word_meet_in_one_group_each():
    rng = np.random.default_rng(1)
    every = np.unique(rng.integers(1, 2**62, 500).astype(np.uint64) << np.uint64(8))
    word, ctx = (a.ravel() for a in np.meshgrid(np.arange(len(every)), np.arange(len(every)), indexing="ij"))
    deal = P.Deal(4, every[[7, 90]], np.array([5, 9], np.uint64))
    group = deal.groups(every, word, ctx)
    plain = word[(word != 7) & (word != 90)]
    assert (group[(word != 7) & (word != 90)] == P._dealt(every, 4)[plain]).all()
    for at, w in enumerate((7, 90)):
        mine = group[word == w]
        shares = {g: deal.share(at, g) for g in range(16)}
        assert abs(sum(shares.values()) - 1) < 1e-9 and len(set(mine.tolist())) > 2 and set(mine.tolist()) == {g for g, v in shares.items() if v}
    some = rng.permutation(len(every))[:200]  # the same pairs from a block with other words
    other = np.union1d(every[[7]], every[some])
    at = np.searchsorted(every, other)
    i = int(np.searchsorted(other, every[7]))
    assert (deal.groups(other, np.full(len(other), i), np.arange(len(other))) == group[(word == 7)][at]).all()
