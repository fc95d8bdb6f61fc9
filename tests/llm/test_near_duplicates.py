import random

import numpy as np
import pytest

from tests.llm.conftest import shingles_of
from viewstar.llm.circulant_minhash import deduplicated, near_duplicates, signature
from viewstar.llm.components import components


def plain_components(rows, percent=85):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles_of(t))
    ids = sorted(sets)
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                comp[max(root(x), root(y))] = min(root(x), root(y))
    return {i: root(i) for i in ids}


def families(seed, n_families, size, noise):
    """Noisy copies of random texts, some beyond the threshold, some linked only by way of others."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(n_families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, size)):
            own = [rng.choice(vocabulary) if rng.random() < rng.choice(noise) else w for w in base]
            base = own if rng.random() < 0.3 else base
            rows.append((i, " ".join(own)))
            i += 1
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark, docs_of):
    rows = families(3, 40, 12, [0, 0, 0.005, 0.02, 0.05])
    out = {r.doc_id: r for r in near_duplicates(docs_of(rows)).collect()}
    want = plain_components(rows)
    assert {i: r.component_id for i, r in out.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles_of(dict(rows)[r.doc_id])) for r in out.values())


def test_large_groups_of_copies(spark, docs_of, monkeypatch):
    """Groups above the bound get their component by the other join, with the same result."""
    from viewstar.llm import circulant_minhash
    monkeypatch.setattr(circulant_minhash, "HOT_COPIES", 5)
    monkeypatch.setattr(circulant_minhash, "HOT_GROUPS", 10)
    rows = families(4, 12, 5, [0, 0.01])
    base = rows[0][1] + " and some words more to be on the safe side"
    rows += [(1000 + i, base) for i in range(120)] + [(2000 + i, base + " x" if i % 2 else "") for i in range(30)]
    out = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows)).collect()}
    assert out == plain_components(rows)


def test_one_large_noisy_family(spark, docs_of):
    """Many members lie outside the pivot's reach and link by way of others or not at all."""
    rng = random.Random(8)
    base = [f"v{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        share = rng.choice([0.0, 0.01, 0.02, 0.03, 0.06])
        rows.append((i, " ".join(f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in base)))
    out = {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows)).collect()}
    assert out == plain_components(rows)


def test_edges(spark, docs_of):
    long_text = " ".join(f"t{i}" for i in range(20000))
    rows = [(5, None), (6, ""), (7, " \n"), (8, "a b"), (3, "A  b"), (9, "a b c"), (None, "a b"), (None, None), (20, long_text), (10, long_text + " end"),
            (30, "p q r s t u v w x y"), (30, "k l m n o"), (31, "p q r s t u v w x y"), (32, "k l m n o"), (20, None)]
    got = near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {i: by[i][0].component_id for i in by if i is not None} == {5: 5, 6: 6, 7: 7, 8: 3, 3: 3, 9: 9, 20: 10, 10: 10, 30: 30, 31: 30, 32: 30}
    assert {r.component_id for r in by[20]} == {10} and len(by[20]) == 2
    assert [by[5][0].n_shingles, by[8][0].n_shingles, max(r.n_shingles for r in by[20])] == [0, 1, 19996]
    assert all(r.kept and r.component_id is None for r in by[None])
    assert near_duplicates(docs_of([])).collect() == []


def test_stage_keeps_one_of_each_group(spark, docs_of):
    rows = [(4, "a b c d e f"), (2, "A b c d e f"), (9, "z y x"), (9, "z y x"), (None, "a b c d e f"), (1, None), (7, None)]
    out = deduplicated(docs_of(rows))
    assert out.columns == docs_of([]).columns
    assert sorted((r.doc_id or -1, r.text) for r in out.collect() if r.text) == [(-1, "a b c d e f"), (2, "A b c d e f"), (9, "z y x")]
    assert sorted(r.doc_id for r in out.collect() if r.text is None) == [1, 7]


@pytest.mark.parametrize("share", [0.5, 0.85])
def test_circulant_signature_estimates_jaccard(share):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    n = 1000
    common = int(2 * n * share / (1 + share))
    a, b = np.sort(pool[:n]), np.sort(pool[n - common:2 * n - common])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, 1024) == signature(b, 1024)).mean() - true) < 0.05


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(50)] + [(7, 7), (500, 400), (400, 500)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
