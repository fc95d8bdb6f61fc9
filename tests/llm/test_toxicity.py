import math
import random
import re

import numpy as np

from viewstar.llm import toxicity as T

BAD = ["scumbag", "idiot", "moronic"]


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    clean = ["".join(rng.choices(["th", "er", "on", "an", "re", "ing", "st", "id", "io", "mo"], k=rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(clean) for _ in range(rng.randint(1, 60))]
        toxic = rng.random() < 0.25
        for _ in range(rng.randint(1, 3) if toxic else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(BAD))
        docs.append((i, " ".join(w) + rng.choice(["", ".", " 42", " a1b2"])))
        labels.append((i, int(toxic)))
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_held_out_accuracy_with_obfuscation(spark, docs_of):
    docs, labels = corpus()
    odd = ["you 1d10t now", "some $cumbag here", "i d i o t", "an iiiidioooot", "m0ron1c thing", "the i.d.i.o.t said", "SCUMBAG!!!", "such an (idiot)", "id1ot***"]
    fine = ["plain thing", "a1 b2 c3", "3.14 and 192.168.0.1", "", None, "!!! ???", "hmmmm thing", "a b c d", "idi", "thing " * 30000]
    more = [(1000 + i, t) for i, t in enumerate(odd)] + [(2000 + i, t) for i, t in enumerate(fine)] + [(None, "idiot"), (3, "idiot idiot")]
    got = {}
    for r in T.scores(docs_of(docs + more), labels_of(spark, labels[:300])).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert sum(map(len, got.values())) == len(docs) + len(more)
    assert all((got[i][0] >= 0.7) == bool(t) for i, t in labels[300:])
    assert [t for i, t in enumerate(odd) if got[1000 + i][0] < 0.7] == []
    assert [t for i, t in enumerate(fine) if got[2000 + i][0] >= 0.7] == []
    assert got[None][0] >= 0.7 and all(0 <= s <= 1 for v in got.values() for s in v)


def test_without_labels_or_rows(spark, docs_of):
    none = labels_of(spark, [])
    assert [r.score for r in T.scores(docs_of([(1, "idiot"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert T.scores(docs_of([]), none).collect() == []
    odd = labels_of(spark, [(1, None), (None, 1), (2, 0), (2, 1)])
    assert len(T.scores(docs_of([(1, "idiot"), (2, None), (2, "x")]), odd).collect()) == 3


def test_decoding_keeps_clean_words_and_restores_others(spark, docs_of):
    docs, _ = corpus()
    model = T.letter_model(docs_of(docs))
    assert model.shape == (28, 28, 28) and np.allclose(np.exp(model).sum(axis=2), 1)
    assert T.decode("1d10t", model) == "idiot" and T.decode("idioooot", model) == "idiot" and T.decode("i d i o t", model).replace(" ", "") == "idiot"
    assert T.decode("", model) == ""


def test_whole_spans_reach_the_lattice():
    """Leetspeak at the ends, in most letters, spelled out, doubled: the whole word is a span."""
    from viewstar.llm.kernel import BLANK_WORDS, text_bytes, words
    odd = ["h4t3", "id107", "idi07", "57up1d", "$7upid", "@$$hole", "1d107", "a55", "455", "1 d 1 0 t", "i d é o t", "iidiott", "f€ol", "идиоот"]
    buf, off = text_bytes(T.pa.array(odd))
    starts, ends, at = words(buf, off, BLANK_WORDS)
    got = {(t, buf[a:b].tobytes().decode()) for t, a, b in T._suspects(buf, off, starts, ends, at)}
    assert [w for t, w in enumerate(odd) if (t, w) not in got] == []
    plain = ["idot", "a", "7", "été", "..."]
    buf, off = text_bytes(T.pa.array(plain))
    assert T._suspects(buf, off, *words(buf, off, BLANK_WORDS)) == []


def test_leetspeak_is_restored_and_scored(spark, docs_of):
    docs, labels = corpus()
    odd = ["the 1d10t!!!", "$cumb4g", "5cumba9", "1 d 1 0 t", "iidiott", "m0r0n1c", "5(um84g"]
    got = {r.doc_id: r.score for r in T.scores(docs_of(docs + [(1000 + i, t) for i, t in enumerate(odd)]), labels_of(spark, labels[:300])).collect()}
    assert [t for i, t in enumerate(odd) if got[1000 + i] < 0.7] == []
    assert [i for i, t in labels[300:] if (got[i] >= 0.7) != bool(t)] == []


def test_rare_words_become_rules_and_copies_do_not(spark, docs_of):
    """A slur in under 1 % of the toxic texts, all short; a word of near copies of one toxic text."""
    rng = random.Random(4)
    clean = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=6)) for _ in range(300)]
    copy = rng.sample(clean, 40)
    docs, labels = [], []
    for i in range(6000):
        w = rng.choices(clean, k=rng.randint(3, 20))
        toxic = i % 4 == 0
        if toxic:
            w += ["scumbag", "zyxyva"] if i % 160 == 8 and i < 160 * 14 + 8 else ["scumbag"]
        if i % 500 == 4 or i % 500 == 104:
            w = [*copy, "quokka", "scumbag", clean[i % 300]] if toxic else w
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    assert 9 <= sum("zyxyva" in t for _, t in docs) < 0.01 * 1500 and sum("quokka" in t for _, t in docs) > 9
    got = {r.doc_id: r.score for r in T.scores(docs_of(docs + [(9001, "a zyxyva here"), (9002, "a quokka here")]), labels_of(spark, labels)).collect()}
    assert got[9001] >= 0.7 and got[9002] < 0.7


def readings(token, lp):
    """Every reading of a token with its best log-probability, by trying all that each character may be."""
    kind = lambda ch: ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0
    best = {}

    def go(i, a, b, last, text, score):
        if i == len(token):
            total = score + (lp[a][b][0] if b else 0.0)
            best[text] = max(best.get(text, -math.inf), total)
            return
        ch = token[i]
        for x in ([ch] if ch.isalpha() else []) + list(T.LOOKS_LIKE.get(ch, "")):
            go(i + 1, b, kind(x), x, text + x, score + (T.SAME if x == ch else T.ALIKE) + lp[a][b][kind(x)])
            if x == last:
                go(i + 1, a, b, last, text, score + T.REPEAT)
        if not ch.isalpha():
            blank = math.log(0.5)
            go(i + 1, a, b, last, text, score + (blank if ch == " " else T.NOTHING))
            if b:
                go(i + 1, 0, 0, "", text + " ", score + lp[a][b][0] + (blank if ch == " " else T.APART))
    go(0, 0, 0, "", "", 0.0)
    return best


def test_lattice_equals_all_readings():
    rng = random.Random(8)
    counts = np.random.default_rng(8).gamma(0.3, size=(T.N_CLASS,) * 3) + 1e-3
    model = np.log(counts / counts.sum(axis=2, keepdims=True))
    lp = model.tolist()
    alphabet = "aabeiost" + "".join(T.LOOKS_LIKE) + "  .*-é"
    tokens = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(500)} | {"aaaa", "1111", "a a a a", "|d|0t", "$$", "..", "€uro"}
    for token in tokens:
        every = readings(token, lp)
        assert abs(every[T.decode(token, model)] - max(every.values())) < 1e-9, token


def test_letter_model_equals_plain_counts(spark, docs_of):
    rng = random.Random(5)
    rows = [(i, "  " + "".join(rng.choice("abcAB é1 .") for _ in range(rng.randint(0, 60))) + "  ") for i in range(200)] + [(900, None), (901, "")]
    n = np.zeros((T.N_CLASS,) * 3)
    for _, text in rows:
        for word in re.findall(rb"[a-z\x80-\xff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()):
            c = [0, 0] + [b - 96 if b < 0x80 else 27 for b in word] + [0]
            for j in range(2, len(c)):
                n[c[j - 2], c[j - 1], c[j]] += 1
    two = n.sum(axis=0) + 0.1
    want = np.log((n + 5 * (two / two.sum(axis=1, keepdims=True))[None]) / (n.sum(axis=2, keepdims=True) + 5))
    assert np.allclose(T.letter_model(docs_of(rows)), want)
