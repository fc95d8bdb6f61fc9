import math

import numpy as np

from viewstar.llm import stable_projections as S

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "x") for i, v in rows], SCHEMA)


def plain(rows, k=20, modulus=20):
    x = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = []
    for q, v in x:
        if q % modulus == 0:
            s = sorted((-float((w * v).sum()), i) for i, w in x if i != q)[:k]
            out += [(q, r, i, -d) for r, (d, i) in enumerate(s, 1)]
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((30, 24))
    rows = [(i, (centres[i % 30] + 0.6 * rng.standard_normal(24)) * rng.uniform(0.5, 2)) for i in range(3000)]
    got = S.nearest(frame(spark, rows)).collect()
    want = plain(rows)
    score = {(q, i): s for q, _, i, s in want}
    assert len(got) == len(want)
    hits = sum((r.query_id, r.vec_id) in score for r in got)
    assert hits >= 0.95 * len(want)
    assert all(abs(score[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got if (r.query_id, r.vec_id) in score)
    for q in {r.query_id for r in got}:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(own, own[1:]))


def test_edges_and_ties(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [1, 0]), (20, [0, 2]), (3, None), (4, [0, 0]), (5, [1, None]), (6, [nan, 1]), (7, [inf, 1]), (8, [1, 0, 0]), (None, [1, 0]), (9, [-1, 0]), (1, [1, 0])]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in S.nearest(frame(spark, rows)).collect()}
    assert [got[0, k] for k in range(1, 6)] == [(1, 1.0), (1, 1.0), (2, 1.0), (20, 0.0), (9, -1.0)] and (0, 6) not in got
    assert got[20, 1] == (0, 0.0) and len([k for k in got if k[0] == 20]) == 5
    assert S.nearest(frame(spark, [])).collect() == [] and S.nearest(frame(spark, [(0, [1, 2])])).collect() == []


def test_one_vector_repeated(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [math.sin(i), math.cos(i), 0.1 * i % 1]) for i in range(500)]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in S.nearest(frame(spark, rows)).collect())
    assert got == sorted((q, r, i) for q, r, i, _ in plain(rows))


def test_chi_square_quantile():
    # known values
    assert abs(S.chi_square_quantile(0.95, 16) - 26.296) < 1e-2 and abs(S.chi_square_quantile(0.5, 2) - 1.386) < 1e-3


def test_very_long_and_short_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(400)]
    rows += [(1000, [1e200] + [0.0] * 7), (1001, [-1e200, 1e199] + [0.0] * 6), (1020, [1e-200, -1e-200] + [0.0] * 6), (1021, [5e-324] * 8), (1040, [0.0, 1e300] + [0.0] * 6)]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in S.nearest(df).collect()}
    with np.errstate(over="ignore"):
        x = [(i, np.array(v)) for i, v in rows]
        want = {}
        for q, v in x:
            if q % 20 == 0:
                s = sorted((-float((w * v).sum()), i) for i, w in x if i != q)[:20]
                want |= {(q, r): (i, -d) for r, (d, i) in enumerate(s, 1)}
    assert got.keys() == want.keys()
    for q in (0, 1000, 1020, 1040):
        assert [got[q, r][1] for r in range(1, 21)] == [want[q, r][1] for r in range(1, 21)]
    assert sum(got[key] == want[key] for key in want) >= 0.97 * len(want)


def test_cells_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "FIT_ROWS", 256)
    monkeypatch.setattr(S, "LEAF_FIT_ROWS", 64)
    monkeypatch.setattr(S, "BLOCK", 32)
    monkeypatch.setattr(S, "QUERIES_PER_BLOCK", 16)
    monkeypatch.setattr(S, "QUERIES_PER_CELL", 50)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    rows = [(i, centres[i % 20] + 0.3 * rng.standard_normal(16)) for i in range(2000)] + [(3000 + i, centres[0]) for i in range(700)]
    got = {(r.query_id, r["rank"]): r.score for r in S.nearest(frame(spark, rows)).collect()}
    want = {(q, r): s for q, r, _, s in plain(rows)}
    assert got.keys() == want.keys()
    assert sum(abs(got[key] - want[key]) < 1e-9 for key in want) >= 0.95 * len(want)
