import numpy as np
import random
from collections import Counter

from viewstar.llm import rank_order as L


def plain_profile(texts, top=L.TOP):
    """Ranked n-grams of 1 to 4 bytes inside padded words."""
    n = Counter()
    for t in texts:
        word, found = b"", []
        for b in [bytes([x]) for x in (t or "").lower().encode()] + [b" "]:
            if b.islower() or b >= b"\x80":
                word += b
            elif word:
                found.append(word)
                word = b""
        for w in found:
            n.update(bytes([x]) for x in w)
            w = b" " + w + b" "
            n.update(w[i:i + k] for k in (2, 3, 4) for i in range(len(w) - k + 1))
    return [int.from_bytes(g, "big") for g, _ in sorted(n.items(), key=lambda x: (-x[1], int.from_bytes(x[0], "big")))][:top]


def plain_score(text, profiles):
    own = plain_profile([text])
    if not own:
        return "und", 0.0
    d = {lang: sum(abs(i - p.index(g)) if g in p else L.TOP for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(sorted(d), key=lambda k: d[k])
    return best, 1 - d[best] / (L.TOP * len(own))


def corpus(n=120):
    rng = random.Random(4)
    parts = {"en": ["th", "er", "on", "an", "re", "ing"], "fr": ["é", "eau", "oi", "ç", "que"], "de": ["sch", "ung", "ß", "ü", "keit"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(1, 60))).capitalize() + rng.choice(["", " 42!", "***"]), lang))
    return rows


def test_profiles_and_predictions_equal_plain_version(spark, docs_of):
    rows = corpus()
    profiles = L.learn(docs_of(rows))
    want = {g: plain_profile([t for _, t, x in rows if x == g]) for g in ("de", "en", "fr")}
    assert {k: v.tolist() for k, v in profiles.items()} == want
    got = {r.doc_id: (r.lang_pred, round(r.score, 12)) for r in L.identify(docs_of(rows), profiles).collect()}
    assert got == {i: (p[0], round(p[1], 12)) for i, t, _ in rows for p in [plain_score(t, want)]}


def test_held_out_accuracy(spark, docs_of):
    rows = corpus(300)
    profiles = L.learn(docs_of(rows[:200]))
    got = {r.doc_id: r.lang_pred for r in L.identify(docs_of(rows[200:]), profiles).collect()}
    assert sum(got[i] == g for i, _, g in rows[200:]) >= 97


def test_edges(spark, docs_of):
    rows = corpus(60) + [(900, None, "en"), (901, "", "en"), (902, "12 34 !?", "en"), (903, "theron", None), (None, "theron thing", "en"), (5, "theron", "en"), (904, "ererth " * 50000, "en")]
    got = {r.doc_id: r for r in L.identify(docs_of(rows), L.learn(docs_of(rows))).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 904, None)] == ["und", "und", "und", "en", "en", "en"]
    assert [got[i].score for i in (900, 901, 902)] == [0, 0, 0] and all(0 <= r.score <= 1 for r in got.values())
    none = L.identify(docs_of(rows), L.learn(docs_of([])))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert L.identify(docs_of([]), {}).collect() == []


def test_digits_beyond_ascii_are_no_letters(spark, docs_of):
    profiles = {"en": np.array([0x6120, 0x61], np.uint32)}
    texts = ["½ ² ①", "Ⅷ ٣", "1_2", "½ a", "ª", "你", "\u0301"]
    got = {r.doc_id: r.lang_pred for r in L.identify(docs_of(list(enumerate(texts))), profiles).collect()}
    assert [got[i] for i in range(7)] == ["und", "und", "und", "en", "en", "en", "und"]


def test_stage_rejects_what_has_no_language(spark, docs_of):
    rows = corpus(60) + [(900, None, "en"), (901, "123", "en"), (None, "theron thing", "en")]
    out = L.identified(docs_of(rows))
    assert out.columns == docs_of([]).columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == [-1, *range(60)]
    assert out.where("doc_id = 3").first().row == "x"
