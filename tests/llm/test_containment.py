import random
import re

from viewstar.llm.containment import clean_documents, containments


def plain_words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def plain(docs, items, percent=80):
    held, need = {}, {}
    for i, t in items:
        w = plain_words(t)
        k = min(len(w), 5)
        need.setdefault(i, set()).update(tuple(w[j:j + k]) for j in range(len(w) - k + 1) if k)
    for d, t in docs:
        w = plain_words(t)
        held.setdefault(d, set()).update(tuple(w[j:j + k]) for k in range(1, 6) for j in range(len(w) - k + 1))
    return {(d, i): (len(n & s), len(n)) for d, s in held.items() for i, n in need.items() if n and 100 * len(n & s) >= percent * len(n)}


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 17, 40, 70])))) for i in range(40)]
    docs = []
    for d in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 30, 400]))]
        for _, t in rng.sample(items, 2):
            own = [x if rng.random() > rng.choice([0, 0.02, 0.1]) else "zz" for x in t.split()]
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((d, " ".join(w)))
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    out = containments(docs_of(docs), bench).collect()
    assert {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in out} == plain(docs, items)
    assert len(out) == len({(r.doc_id, r.item_id) for r in out})


def test_edges(spark, docs_of):
    bench = spark.createDataFrame([(1, "One two, three four FIVE six"), (1, "One two, three four FIVE six"), (2, None), (3, "..."), (None, "alpha beta"), (5, "")], "item_id long, text string")
    docs = docs_of([(1, "x one TWO three!! four five *** six y"), (1, "x one TWO three!! four five *** six y"), (2, "one two three four"), (3, None), (4, ""),
                    (None, "see alpha-beta here"), (6, "alpha gamma beta")])
    got = {(r.doc_id, r.item_id): r.containment for r in containments(docs, bench).collect()}
    assert got == {(1, 1): 1.0, (None, None): 1.0}
    left = clean_documents(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 6]
    none = bench.where("item_id = 99")
    assert containments(docs, none).collect() == [] and clean_documents(docs, none).count() == 7
    assert containments(docs_of([]), bench).collect() == []


def test_rows_of_one_item_with_different_lengths(spark, docs_of):
    """A document found only by the longer row's sketch has the short row's shingle counted."""
    long = " ".join(f"w{i}" for i in range(8))
    items = [(1, long), (1, "short one")]
    docs = [(d, f"{pre} {' '.join(w)} {post}") for d, (pre, w, post) in enumerate(
        [(a, long.split()[i:j], b) for a in ("x", "short one") for b in ("y", "short one") for i in (0, 1) for j in (7, 8)])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in containments(docs_of(docs), bench).collect()}
    assert got == plain(docs, items) and (4, 1) in got
