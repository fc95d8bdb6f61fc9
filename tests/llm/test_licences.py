import math
import random
import re

from viewstar.llm import licences as L

BASE = [(label, key.split()) for label, key, _ in L.TEMPLATES[:L.N_BASE]]


def plain(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = lambda k: [i for i in range(len(w)) if w[i:i + len(k)] == k]
    spots = [i for _, k in BASE for i in at(k)]
    base = sorted({b for b, k in BASE if at(k)})
    labels = sorted({b for b, k, _ in L.TEMPLATES if at(k.split())})
    return len(w), len(spots), min(spots, default=None), max(spots, default=None), ",".join(base), ",".join(labels)


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(9)
    pool = sorted({w for _, _, n in L.TEMPLATES for w in n.split()} | {"cc", "by", "foo", "Bär", "x1"})
    rows = []
    for i in range(300):
        w = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(L.TEMPLATES)[rng.choice([1, 2])].split()
        rows.append((i, rng.choice([" ", "-", ".\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    rows += [(900, None), (901, ""), (902, "... !!"), (None, "CC-BY"), (903, "cc by cc by cc by"), (903, "cc by"), (904, "pad " * 100000 + "All rights reserved"), (905, "all rights"), (906, "reserved")]
    got = [(r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)) for r in L.scan(docs_of(rows)).collect()]
    # upper() of ä differs from the fold of A-Z alone
    assert sorted(got, key=str) == sorted([(i, plain(t)) for i, t in rows], key=str)
    assert L.scan(docs_of([])).collect() == []


def test_score_follows_the_notice(spark, docs_of):
    rows = [(1, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (2, "permission is hereby granted free of charge or not"), (3, "nothing here")]
    got = {r.doc_id: r for r in L.scan(docs_of(rows)).collect()}
    assert got[1].score > 0.999 and 0 < got[2].score < got[1].score and got[3].score == 0
    assert [got[i].labels for i in (1, 2, 3)] == ["mit", "mit", ""]


def plain_score(text, idf):
    """Each template's share by trying every relative position of every span."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    best, labels = 0.0, set()
    for label, spans in L.licences():
        if not all(any(w[i:i + len(k.split())] == k.split() for i in range(len(w))) for k, _ in spans if k):
            continue
        labels.add(label)
        got = 0.0
        for key, text in spans:
            t, k = text.split(), key.split()
            at = next((i for i in range(len(t)) if t[i:i + len(k)] == k))
            rare = sorted(set(t) & set(w), key=lambda x: (-idf[x], x))[:L.RARE]
            top = 0.0
            for d in range(-len(t), len(w)):
                same = [j for j in range(len(t)) if 0 <= d + j < len(w) and w[d + j] == t[j]]
                meets = set(range(at, at + len(k))) <= set(same) if key else sum(t[j] in rare for j in same) >= 2
                if meets:
                    top = max(top, sum(idf[t[j]] + 1e-9 for j in same))
            got += top
        best = max(best, got / sum(idf[x] + 1e-9 for _, text in spans for x in text.split()))
    return best, ",".join(sorted(labels))


def test_scores_equal_every_relative_position(spark, docs_of):
    rng = random.Random(3)
    pool = L.licence_words()
    rows = []
    for i in range(160):
        w = [rng.choice(pool) for _ in range(rng.randint(0, 25))]
        _, spans = rng.choice(L.licences())
        for _, text in spans if rng.random() < 0.8 else spans[:1]:
            part = text.split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):  # words lost, added and changed
                at = rng.randrange(len(part))
                part[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(pool)], ["other"]])
                part = part or ["other"]
            w += part + ["pad"] * rng.randint(0, 3)
        rows.append((i, " ".join(w)))
    rows += [(500, " ".join(["all rights reserved"] * 3000)), (501, None), (502, "cc by"), (503, "reserved")]
    docs = docs_of(rows)
    idf = L.idf_of(docs.select("text"))
    df = {x: sum(x in set((t or "").split()) for _, t in rows) for x in pool}
    assert all(abs(idf[x] - math.log((len(rows) + 1) / (df[x] + 1))) < 1e-12 for x in pool)
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    for i, t in rows:
        if i == 500:
            t = "all rights reserved"
        score, labels = plain_score(t, idf)
        assert got[i].labels == labels and abs(got[i].score - score) < 1e-9, (i, t)
    assert sum(r.score > 0.9 for r in got.values()) > 40 and any(0 < r.score < 0.6 for r in got.values())


def test_licence_texts_are_named(spark, docs_of):
    whole = [(i, ".\n * ".join(text.upper() for _, text in spans)) for i, (_, spans) in enumerate(L.TEXTS)]
    got = {r.doc_id: r for r in L.scan(docs_of(whole + [(900, "permission is granted, free of charge")])).collect()}
    assert all(label in got[i].labels.split(",") and got[i].score > 0.999 for i, (label, _) in enumerate(L.TEXTS))
    assert got[900].labels == "" and got[900].score == 0


def test_repeated_word_of_a_phrase_may_be_the_rarest():
    idf = {w: 1.0 for w in L.licence_words()} | {"and": 9.0}
    ix = L.index(idf)
    span = next(x for x in ix.spans if ix.labels[x.template] == "bsd")
    assert len(span.posts) == 2
