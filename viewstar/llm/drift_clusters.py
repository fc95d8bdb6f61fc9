"""Operator 13: centroid clustering with geometrically tightened drift bounds.

Lloyd's rounds in exact integers.  Each vector carries its cluster, an upper bound
of its distance to that centroid and a lower bound of its distance to all others.
When centroids move, the upper bound grows by its own centroid's drift; the lower
bound shrinks, but by less than the largest drift of the others: all members of a
cluster lie in a sphere around its old centroid (radius: the largest upper bound),
and how much nearer centroid b can come to a point of that sphere when it moves
from a is bounded in the plane through the sphere's centre and the line a-b.  There
points with equal gain lie on a hyperbola with foci a and b, between whose
asymptotes the sphere must reach; that gives an angle, and the gain is the drift
times its sine (``gain``): nothing for a sphere on the far side of the bisector,
the full drift only for one that holds the midpoint.  A vector whose upper bound
stays below its lower one keeps its cluster unseen; the others are measured, first
to their own centroid, then, if still ambiguous, to all.

Layout: blocks of ``BLOCK`` vectors, bucketed by block; a round writes a table of the
blocks' states (17 bytes a vector) with the same buckets, so the next round's join
moves nothing, and adds up what the vectors that moved change in the sums of the
clusters.  The driver holds k centroids and their sums.

Defined cases: vectors that are null, of another length, or hold a null or
non-finite component take no part; fewer vectors than ``k`` give as many clusters;
equal distances go to the smaller number; an empty cluster keeps its centroid;
rows of one id are vectors of their own, a null id is hashed as an empty one, equal
hashes are ordered by components; an empty table gives no rows; other columns are
ignored.  A component whose integer lies beyond 2^27 in size is an error: squared
distances might not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.llm.common import materialize, scratch_path, table

BLOCK = 2048
#: Vectors of a bucket, and the most buckets (a larger table gets larger ones).
BUCKET_ROWS = 65_536
MAX_BUCKETS = 50_000
LIMIT = 1 << 27
#: Products of components up to this size add up exactly in doubles.
EXACT = 1 << 22
#: What rounding may add to an angle, a length and a ratio of lengths.
SLACK_ANGLE, SLACK, SLACK_RATIO = 1e-7, 1e-5, 1e-9


def gain(centre: np.ndarray, radius: float, a: np.ndarray, b: np.ndarray) -> float:
    """An upper bound of |x - a| - |x - b| over all x in the sphere."""
    move = b - a
    drift = math.sqrt(float(move @ move))
    if drift == 0:
        return 0.0
    from_middle = centre - (a + b) / 2
    distance = math.sqrt(float(from_middle @ from_middle))
    if radius >= distance:
        return drift + SLACK
    along = max(-1.0, min(1.0, float(from_middle @ move) / (distance * drift)))
    angle = math.pi / 2 + math.asin(radius / distance) - math.acos(along) + SLACK_ANGLE
    if angle <= 0:
        return 0.0
    return drift * math.sin(min(angle, math.pi / 2)) + SLACK


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By cluster: the drift of its centroid, and by how much any other centroid can have come nearer to a member."""
    a, b = old.astype(float), new.astype(float)
    k = len(a)
    drift = np.sqrt(((a - b) ** 2).sum(axis=1)) + SLACK
    nearer = [max([gain(a[i], radius[i], a[j], b[j]) for j in range(k) if j != i], default=0.0) if radius[i] >= 0 else 0.0 for i in range(k)]
    return drift, np.array(nearer)


# ---- vectors ---------------------------------------------------------------

def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    if not len(x):
        return np.empty((0, len(c)), np.int64)
    if max(int(np.abs(x).max()), int(np.abs(c).max())) <= EXACT:
        dots = (x.astype(float) @ c.T.astype(float)).astype(np.int64)
        return (x * x).sum(axis=1)[:, None] - 2 * dots + (c * c).sum(axis=1)[None, :]
    return np.stack([((x - y) ** 2).sum(axis=1) for y in c], axis=1)


def _to_blocks(dims: int, scale: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            col = batch.column("v")
            fits = pc.fill_null(pc.equal(pc.list_value_length(col), dims), False)
            kept = batch.filter(fits)
            if kept.num_rows == 0:
                continue
            flat = pc.list_flatten(kept.column("v")).cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
            sound = np.isfinite(flat).all(axis=1)
            x = np.floor(flat[sound] * scale)
            if x.size and np.abs(x).max() > LIMIT:
                raise ValueError(f"a component is over {LIMIT // scale} in size: squared distances would not fit in 64 bits")
            yield kept.column("id").filter(pa.array(sound)), x.astype("<i4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        data: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            some, x = ids[:BLOCK], np.concatenate(data)
            del ids[:BLOCK]
            data[:] = [x[BLOCK:]]
            return pa.RecordBatch.from_arrays([pa.array([number - 1], pa.int64()), pa.array([some], pa.list_(pa.int64())), pa.array([x[:BLOCK].tobytes()], pa.binary())], ["block", "ids", "data"])
        for some, x in rows(batches):
            ids += some.to_pylist()
            data.append(x)
            while len(ids) >= BLOCK:
                yield block()
        if ids:
            yield block()
    return run


def _first(seed: int, k: int, dims: int):
    """The task's k vectors of smallest hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, tuple]] = []
        for batch in batches:
            for ids, data in zip(batch.column("ids").to_pylist(), batch.column("data").to_pylist()):
                h = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i in ids]
                x = np.frombuffer(data, "<i4").reshape(-1, dims)
                last = heapq.nsmallest(k, h)[-1]
                best = heapq.nsmallest(k, best + [(h[j], tuple(x[j].tolist())) for j in range(len(h)) if h[j] <= last])
        yield pa.RecordBatch.from_arrays([pa.array([b[0] for b in best], pa.string()), pa.array([list(b[1]) for b in best], pa.list_(pa.int64()))], ["h", "x"])
    return run


# ---- rounds ----------------------------------------------------------------

STATE = "block long, state binary, change array<long>, radius array<double>, measured long, scanned long"
_ROW = np.dtype([("a", "<u2"), ("u", "<f8"), ("l", "<f8")])


def _nearest(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest number and the bounds that exact squared distances give."""
    a = d.argmin(axis=1)
    own = np.arange(len(d))
    u = np.sqrt(d[own, a].astype(float))
    d = d.copy()
    d[own, a] = np.iinfo(np.int64).max
    l = np.sqrt(d.min(axis=1).astype(float)) if d.shape[1] > 1 else np.full(len(d), np.inf)
    return a, u, l


def assign(x: np.ndarray, centroids: np.ndarray, state: np.ndarray | None, drift: np.ndarray, nearer: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The vectors' state against moved centroids, how many were measured and how many scanned."""
    out = np.empty(len(x), _ROW)
    if state is None:
        out["a"], out["u"], out["l"] = _nearest(squared(x, centroids))
        return out, len(x), len(x)
    out[:] = state
    out["u"] += drift[out["a"]]
    out["l"] -= nearer[out["a"]]
    sure = lambda s: s["u"] * (1 + SLACK_RATIO) + SLACK < s["l"]
    look = np.flatnonzero(~sure(out))
    # first against the own centroid alone
    exact = np.empty(len(look))
    for c in np.unique(out["a"][look]).tolist():
        of = out["a"][look] == c
        exact[of] = np.sqrt(squared(x[look[of]], centroids[c:c + 1])[:, 0].astype(float))
    out["u"][look] = exact
    scan = look[~sure(out[look])]
    if scan.size:
        out["a"][scan], out["u"][scan], out["l"][scan] = _nearest(squared(x[scan], centroids))
    return out, len(look), len(scan)


def _round(centroids: np.ndarray, drift: np.ndarray, nearer: np.ndarray, first: bool):
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            before = [None] * batch.num_rows if first else batch.column("state").to_pylist()
            for block, data, state in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), before):
                x = np.frombuffer(data, "<i4").reshape(-1, dims).astype(np.int64)
                old = None if state is None else np.frombuffer(state, _ROW)
                now, measured, scanned = assign(x, centroids, old, drift, nearer)
                change = np.zeros((k, dims + 1), np.int64)
                moved = np.arange(len(x)) if first else np.flatnonzero(now["a"] != old["a"])
                for side, sign in ((now, 1),) if first else ((now, 1), (old, -1)):
                    for c in np.unique(side["a"][moved]).tolist():
                        of = moved[side["a"][moved] == c]
                        change[c, :dims] += sign * x[of].sum(axis=0)
                        change[c, dims] += sign * len(of)
                radius = np.full(k, -1.0)
                np.maximum.at(radius, now["a"], now["u"])
                out.append((block, now.tobytes(), change.reshape(-1).tolist() if moved.size else None, radius.tolist(), measured, scanned))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(kinds)], ["block", "state", "change", "radius", "measured", "scanned"])
    return run


def _final(centroids: np.ndarray):
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, state in zip(batch.column("ids"), batch.column("data").to_pylist(), batch.column("state").to_pylist()):
                x, a = np.frombuffer(data, "<i4").reshape(-1, dims).astype(np.int64), np.frombuffer(state, _ROW)["a"]
                d = ((x - centroids[a]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(a, pa.int32()), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])
    return run


class Clustering:
    """Blocks of vectors, their centroids, and the rounds over them."""

    def __init__(self, vectors: DataFrame, k: int = 8, dims: int = 64, scale: int = 1024, seed: int = 3,
                 id_col: str = "vec_id", vector_col: str = "embedding"):
        self.spark, self.dims, self.names = vectors.sparkSession, dims, []
        some = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(F.col("v").isNotNull())
        rows = some.count()
        cores = self.spark.sparkContext.defaultParallelism
        self.buckets = min(MAX_BUCKETS, max(1, -(-rows // BUCKET_ROWS), min(cores, -(-rows // BLOCK))))
        blocks = some.mapInArrow(_to_blocks(dims, scale), "block long, ids array<long>, data binary")
        self.blocks = self._bucketed(blocks.repartition(self.buckets, "block"), "vectors")
        first = self.blocks.mapInArrow(_first(seed, k, dims), "h string, x array<long>").orderBy("h", "x").limit(k).collect()
        self.centroids = np.array([r.x for r in sorted(first, key=lambda r: (r.h, r.x))], np.int64).reshape(-1, dims)
        self.sums = np.zeros((len(first), dims + 1), object)
        self.state: DataFrame | None = None
        #: vectors measured against their own centroid and against all, by round
        self.log: list[tuple[int, int]] = []

    def _bucketed(self, df: DataFrame, name: str) -> DataFrame:
        path, name = scratch_path(self.spark, f"clusters-{name}"), f"clusters_{name}_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "block").option("path", path).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def _joined(self) -> DataFrame:
        return self.blocks.join(self.state.select("block", "state").hint("merge"), "block")

    def place(self, drift: np.ndarray | None = None, nearer: np.ndarray | None = None) -> None:
        """Every vector to its nearest centroid."""
        first = self.state is None
        work = _round(self.centroids, drift, nearer, first)
        rows = self.blocks if first else self._joined()
        self.state = self._bucketed(rows.mapInArrow(work, STATE), "state")
        change = self.state.select(F.posexplode("change").alias("at", "n")).where("n <> 0").groupBy("at").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))
        for r in change.collect():  # at most k * (dims + 1) rows
            self.sums[r.at // (self.dims + 1), r.at % (self.dims + 1)] += int(r.n)
        seen = self.state.agg(F.sum("measured"), F.sum("scanned")).first()
        self.log.append((seen[0], seen[1]))

    def move(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Centroids to the floor of their means; None if all stay."""
        new = self.centroids.copy()
        for c, s in enumerate(self.sums):
            if s[-1]:
                new[c] = [int(v) // int(s[-1]) for v in s[:-1]]
        if (new == self.centroids).all():
            return None
        radius = np.full(len(new), -1.0)
        for r in self.state.select(F.posexplode("radius").alias("c", "r")).groupBy("c").agg(F.max("r").alias("r")).collect():
            radius[r.c] = r.r * (1 + SLACK_RATIO) + SLACK if r.r >= 0 else -1.0
        bounds = loosening(self.centroids, new, radius)
        self.centroids = new
        return bounds

    def run(self, rounds: int) -> DataFrame:
        """vec_id, cluster, distance after so many rounds (fewer where nothing moves any more) and a last assignment."""
        if not len(self.centroids):
            return self.spark.createDataFrame([], "vec_id long, cluster int, distance long")
        self.place()
        for _ in range(rounds):
            bounds = self.move()
            if bounds is None:
                break
            self.place(*bounds)
        out = self._joined().mapInArrow(_final(self.centroids), "vec_id long, cluster int, distance long")
        out = materialize(out, "clusters")
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")
        return out

    def digests(self) -> DataFrame:
        rows = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(self.centroids.tolist())]
        return self.spark.createDataFrame(rows, "cluster int, centroid_sha256 string")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def clustered(vectors: DataFrame, rounds: int = 10, **settings) -> DataFrame:
    """Each vector with its cluster, squared distance, inertias and the digest of its centroid."""
    work = Clustering(vectors, **settings)
    placed = work.run(rounds)
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    by_cluster = placed.groupBy("cluster").agg(exact("distance").cast("long").alias("cluster_inertia"))
    # a row for each of k clusters
    totals = by_cluster.join(work.digests(), "cluster").withColumn("inertia", by_cluster.agg(exact("cluster_inertia").cast("long")).scalar())
    return placed.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(rounds: int = 10, k: int = 8) -> str:
    parts = [r"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
v AS MATERIALIZED (SELECT r, i, floor(1024 * e[i]::DOUBLE)::BIGINT AS x FROM k, range(1, 65) t(i)),
s AS (SELECT k.r, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), xs) - 1 AS c
      FROM k JOIN (SELECT r, list(x ORDER BY i) AS xs FROM v GROUP BY r) USING (r)),
c0 AS MATERIALIZED (SELECT c, i, x FROM s JOIN v USING (r) WHERE c < %d)""" % k]
    for t in range(rounds + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS d FROM v JOIN c{t} m USING (i) GROUP BY r, c)
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if t < rounds:
            parts.append(f"""
c{t + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(((w.s - ((w.s % w.n) + w.n) % w.n) // w.n)::BIGINT, o.x) AS x
      FROM c{t} o LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{t} JOIN v USING (r) GROUP BY c, i) w USING (c, i))""")
    parts.append(f"""
g AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)""")
    return ",".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN k USING (r) JOIN g USING (c)"""


ORACLE = _oracle()
