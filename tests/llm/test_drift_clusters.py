import hashlib
import math

import numpy as np
from hypothesis import given, settings, strategies as st

from viewstar.llm import drift_clusters as D

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "x") for i, v in rows], SCHEMA)


def plain(rows, dims, k=8, rounds=10):
    """Lloyd's rounds as the contract says them."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [v for _, v in start]
    x = np.array([v for _, v in kept], dtype=object).reshape(-1, dims)

    def near():
        out = []
        for v in x:
            d = [int(((v - np.array(c, dtype=object)) ** 2).sum()) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        a = near()
        for c in range(len(cents)):
            own = [v for v, (b, _) in zip(x, a) if b == c]
            if own:
                cents[c] = [sum(col) // len(own) for col in zip(*own)]
    a = near()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    inertia = [sum(d for b, d in a if b == c) for c in range(len(cents))]
    return sorted([(-1 if i is None else i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (c, d) in zip(kept, a)])


def rows_of(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2 ** 32), st.sampled_from([1, 2, 3, 16]), st.floats(0.01, 30), st.floats(0.01, 30))
def test_no_point_of_the_sphere_gains_more(seed, dims, radius, drift):
    rng = np.random.default_rng(seed)
    centre, a = rng.normal(size=dims) * 10, rng.normal(size=dims) * 10
    step = rng.normal(size=dims)
    b = a + step / np.linalg.norm(step) * drift
    out = rng.normal(size=(400, dims))
    x = centre + out / np.linalg.norm(out, axis=1)[:, None] * radius * rng.uniform(0, 1, 400)[:, None] ** (1 / dims)
    x = np.vstack([x, centre + step / np.linalg.norm(step) * radius, centre + (b - centre) / max(np.linalg.norm(b - centre), 1e-9) * min(radius, np.linalg.norm(b - centre))])
    most = (np.linalg.norm(x - a, axis=1) - np.linalg.norm(x - b, axis=1)).max()
    bound = D.gain(centre, radius, a, b)
    assert most <= bound + 1e-9 and bound <= drift + 2 * D.SLACK


def test_spheres_beyond_the_bisector_lose_nothing():
    a, b = np.array([0.0, 0.0]), np.array([1.0, 0.0])
    assert D.gain(np.array([-10.0, 0.0]), 3.0, a, b) == 0.0
    assert 0 < D.gain(np.array([0.5, 10.0]), 1.0, a, b) < 0.11
    assert D.gain(np.array([9.0, 0.0]), 1.0, a, b) >= 1.0


def test_squared_distances_large_and_small():
    rng = np.random.default_rng(0)
    for size in (1000, D.EXACT, D.LIMIT):
        x, c = rng.integers(-size, size + 1, (50, 64)), rng.integers(-size, size + 1, (8, 64))
        want = [[sum((int(p) - int(q)) ** 2 for p, q in zip(u, v)) for v in c] for u in x]
        assert D.squared(x, c).tolist() == want


def test_against_plain_rounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 64)) * 0.3
    rows = [(i, centres[i % 12] + 0.2 * rng.normal(size=64)) for i in range(900)] + [(7000 + i, centres[0]) for i in range(300)] + [(5, centres[3]), (5, centres[3]), (None, centres[4])]
    work = D.Clustering(frame(spark, rows))
    got = work.run(10)
    assert rows_of(D.clustered(frame(spark, rows))) == plain(rows, 64)
    assert got.count() == len(rows)
    scans = [s for _, s in work.log]
    assert scans[0] == len(rows) and sum(scans[1:]) < 0.5 * len(rows) * len(scans[1:])
    assert all(s <= m for m, s in work.log)


def test_ties_odd_vectors_and_few(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, [0, 0]), (2, [1, 0]), (3, [0, 1]), (4, [1, 1]), (5, [0.5, 0.5]), (6, None), (7, [1]), (8, [1, None]), (9, [nan, 1]), (10, [inf, 1]), (11, []), (12, [1, 2, 3]),
            (13, [-0.0004, 0.9999]), (14, [-1, -1]), (None, [2, 2]), (4, [1, 1])]
    for k in (1, 3, 8, 20):
        assert rows_of(D.clustered(frame(spark, rows), k=k, dims=2)) == plain(rows, 2, k), k
    assert D.clustered(frame(spark, [])).collect() == [] and D.clustered(frame(spark, [(1, [1.0])])).collect() == []
    one = [(i, [0.25] * 64) for i in range(50)]
    assert rows_of(D.clustered(frame(spark, one))) == plain(one, 64)


def test_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 64)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4) * 3) for i in range(1000)]
    assert rows_of(D.clustered(frame(spark, rows).repartition(5), dims=4)) == plain(rows, 4)


def test_rounds_join_without_a_shuffle(spark):
    rng = np.random.default_rng(9)
    work = D.Clustering(frame(spark, [(i, rng.normal(size=64)) for i in range(5000)]))
    work.place()
    plan = work._joined()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
