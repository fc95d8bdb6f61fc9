"""Operator 3: nearest neighbours by stable projections and a kd-tree.

A vector is 2^e y with a norm of y from 0.5 to 1; e is its band.  Within a band the
largest inner product becomes the smallest distance by one added coordinate:
y' = (y, sqrt(1 - |y|^2)), q' = (q / |q|, 0).  So components of any size are
compared without overflow, and one long vector leaves the others' bounds alone.
Vectors are projected to ``DIM`` dimensions by a seeded Gaussian (2-stable)
matrix: a projected squared distance over the true one is chi-square with ``DIM``
degrees.

Index: for each band a kd-tree over the projected vectors.  Its upper planes are
fitted on at most ``FIT_ROWS`` rows (a hash sample); below them a cell is cut at
the medians, over all its rows, of its widest axes, one axis for each doubling of
its rows beyond ``BLOCK``.  So cells grow in number with the rows; a cell that stays
larger (one much repeated vector) is cut into blocks by a hash.  Every row is in
one cell, and each cell keeps the box of its projected rows.

Search: the k-th best product in the sample and then in the block nearest to the
query bounds the k-th neighbour's distance d.  Cells whose box lies further than
the chi-square quantile ``SURE`` allows for d are skipped, first by the upper
planes, then by those below.  In each block projected neighbours are verified in
order, in steps of ``STEP`` rows and then four times as many each, d shrinking as they
are found, until the next one's projected distance fails the same test.  A true neighbour is missed with a
probability of at most 1 - ``SURE``.  A block's rows are sent once for each
``QUERIES_PER_BLOCK`` queries that really come to it.

Defined cases: vectors null, zero, with null or non-finite components, or of
another length than most take no part, nor do rows without an id; rows with the
query's id are no candidates; equal scores go to the smaller id; fewer than k
candidates are all returned; queries of one id with several vectors count each
vector; an empty table gives an empty result.  A product beyond the range of
doubles is infinite or zero, as the measure itself.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from viewstar.llm.common import materialize, table
from viewstar.llm.kernel import mix64

DIM = 16
SURE = 0.98
FIT_ROWS = 16_384
LEAF_FIT_ROWS = 256
BLOCK = 4096
STEP = 256
QUERIES_PER_BLOCK = 2048
#: Queries that meet the boxes of one upper cell in one group.
QUERIES_PER_CELL = 65_536
#: Products are held divided by 2^SHIFT, so that norms beyond the range of doubles fit.
SHIFT = 8


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile for an even number of degrees, from the closed form of the distribution."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    lo, hi = 0.0, 100.0 * degrees
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten() if not isinstance(col, pa.ChunkedArray) else col.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products whose rounding doesn't depend on the other rows."""
    return (x * q).sum(axis=1)


class Tree:
    """A kd-tree of planes: at each node the widest axis is cut at its median."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.axis, self.cut, self.left, self.right, self.cell = [], [], [], [], []
        self.cells = 0
        self._grow(points, leaf)

    def _grow(self, p: np.ndarray, leaf: int) -> int:
        node = len(self.axis)
        for a, v in ((self.axis, 0), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.cell, -1)):
            a.append(v)
        wide = np.ptp(p, axis=0) if len(p) else np.zeros(1)
        a = int(np.argmax(wide))
        cut = float(np.median(p[:, a])) if len(p) else 0.0
        low = p[:, a] <= cut if len(p) else np.empty(0, bool)
        if len(p) <= leaf or low.all() or not low.any():
            self.cell[node], self.cells = self.cells, self.cells + 1
            return node
        self.axis[node], self.cut[node] = a, cut
        self.left[node] = self._grow(p[low], leaf)
        self.right[node] = self._grow(p[~low], leaf)
        return node

    def place(self, p: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        axis, cut, left, right, cell = map(np.array, (self.axis, self.cut, self.left, self.right, self.cell))
        at = np.zeros(len(p), np.int64)
        while True:
            inner = np.flatnonzero(cell[at] < 0)
            if len(inner) == 0:
                return cell[at]
            node = at[inner]
            at[inner] = np.where(p[inner, axis[node]] <= cut[node], left[node], right[node])


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows y with norms from 0.5 to 1 and exponents e, each row being 2^e y."""
    _, e = np.frexp(np.abs(x).max(axis=1))
    y = np.ldexp(x, -e[:, None])
    _, f = np.frexp(np.sqrt((y * y).sum(axis=1)))
    return np.ldexp(y, -f[:, None]), (e + f).astype(np.int64)


class Space:
    """The added coordinate and the projection."""

    def __init__(self, dim: int, seed: int = 5):
        self.dim = dim
        self.proj = np.random.default_rng(seed).standard_normal((dim + 1, DIM))
        self.limit = chi_square_quantile(SURE, DIM)

    def rows(self, y: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(1 - (y * y).sum(axis=1), 0))
        return y @ self.proj[:-1] + more[:, None] * self.proj[-1]

    def queries(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vectors and their projections."""
        y, _ = scaled(q)
        unit = y / np.linalg.norm(y, axis=1)[:, None]
        return unit, unit @ self.proj[:-1]

    def radius(self, bound, band):
        """Largest squared projected distance to test in a band for products of at least ``bound``; negative: none."""
        c = np.ldexp(np.maximum(bound, -1e300), np.clip(SHIFT - band, -2000, 2000).astype(np.int32))
        return np.where(c > 1 + 1e-9, -1.0, self.limit * (2 - 2 * np.clip(c, -1, 1)) * (1 + 1e-9) + 1e-9)


def bound_of(t: float) -> float:
    """A product as a bound; near the smallest doubles it is none."""
    return t if abs(t) > 1e-290 else -math.inf


class Boxes:
    """Boxes of projected rows, each of a band."""

    def __init__(self, band, low, high):
        self.band = np.asarray(band, np.int64)
        self.low, self.high = np.asarray(low, float).reshape(-1, DIM), np.asarray(high, float).reshape(-1, DIM)

    def near(self, space: Space, pq: np.ndarray, bound: np.ndarray, home: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, box) that may hold a neighbour; with ``home`` each query's most promising box."""
        out_i, out_c = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        rows = max(1, (1 << 20) // max(1, len(self.band) * DIM))
        for a in range(0, len(pq) if len(self.band) else 0, rows):
            p = pq[a:a + rows, None]
            gap = np.maximum(self.low[None] - p, 0) + np.maximum(p - self.high[None], 0)
            gap = (gap * gap).sum(axis=2)
            if home:
                fair = 1 - gap / (2 * DIM)
                top = int(self.band.max())
                c = np.argmax(np.ldexp(fair, np.maximum(self.band - top, -1000).astype(np.int32)[None]), axis=1)
                i = np.arange(len(c))
            else:
                i, c = np.nonzero(gap <= space.radius(bound[a:a + rows, None], self.band[None]))
            out_i.append(a + i)
            out_c.append(c)
        return np.concatenate(out_i), np.concatenate(out_c)


class Index:
    """A tree for each band of the sample; cells are numbered through all bands."""

    def __init__(self, space: Space, sample: np.ndarray, leaf: int):
        self.space, self.trees, self.first = space, {}, {}
        y, e = scaled(sample) if len(sample) else (sample, np.empty(0, np.int64))
        cells = 0
        for band in np.unique(e).tolist():
            self.trees[band], self.first[band] = Tree(space.rows(y[e == band]), leaf), cells
            cells += self.trees[band].cells

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Band, cell and projection of each row; a band without a sample row is one cell, below 0."""
        y, e = scaled(x)
        p = self.space.rows(y)
        cell = e - 10_000
        for band in np.unique(e).tolist():
            if band in self.trees:
                own = np.flatnonzero(e == band)
                cell[own] = self.first[band] + self.trees[band].place(p[own])
        return e, cell, p


def _projector(index: Index):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, cell, p = index.place(matrix(b.column("vec"), index.space.dim))
                yield pa.RecordBatch.from_arrays([pa.array(cell), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(DIM))], ["cell", *(f"p{i}" for i in range(DIM))])
    return project


def _placer(index: Index, planes: dict[int, tuple[list[int], list[float]]]):
    """Rows with band, upper cell and the cell below it: a bit for each plane."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                band, cell, p = index.place(matrix(b.column("vec"), index.space.dim))
                sub = np.zeros(len(cell), np.int64)
                for c in np.unique(cell).tolist():
                    own = np.flatnonzero(cell == c)
                    for axis, cut in zip(*planes.get(c, ([], []))):
                        sub[own] = sub[own] * 2 + (p[own, axis] > cut)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), pa.array(band), pa.array(cell), pa.array(sub)], ["id", "vec", "band", "cell", "sub"])
    return place


def _boxer(space: Space):
    """Projections of placed rows, for their cells' boxes."""
    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = space.rows(scaled(matrix(b.column("vec"), space.dim))[0])
                yield pa.RecordBatch.from_arrays([b.column("band"), b.column("cell"), b.column("sub"), *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(DIM))],
                                                 ["band", "cell", "sub", *(f"p{i}" for i in range(DIM))])
    return box


def _bounder(space: Space, sample_ids: np.ndarray, sample: np.ndarray, k: int):
    """Queries with the k-th best product in the sample as their bound."""
    y, e = scaled(sample) if len(sample) else (sample, np.empty(0, np.int64))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy()
            vec = matrix(b.column("vec"), space.dim)
            out = np.full(b.num_rows, -np.inf)
            for a in range(0, b.num_rows if len(e) >= k else 0, 64):
                unit, _ = space.queries(vec[a:a + 64])
                t = np.ldexp(unit @ y.T, (e - SHIFT).astype(np.int32)[None])
                t[sample_ids[None, :] == ids[a:a + 64, None]] = -np.inf
                out[a:a + 64] = [bound_of(v) for v in np.partition(t, len(e) - k, axis=1)[:, -k].tolist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vec"), pa.array(out)], ["id", "vec", "bound"])
    return bound


def _upper(space: Space, boxes: Boxes, cells: np.ndarray, home: bool):
    """Queries sent to upper cells."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, pq = space.queries(matrix(b.column("vec"), space.dim))
                i, c = boxes.near(space, pq, b.column("bound").to_numpy(), home)
                for a in range(0, len(i), 8192):
                    yield pa.RecordBatch.from_arrays([*(b.column(n).take(pa.array(i[a:a + 8192])) for n in ("id", "vec", "bound")), pa.array(cells[c[a:a + 8192]])], ["id", "vec", "bound", "cell"])
    return route


def _lower(space: Space, home: bool):
    """Queries sent to the blocks of one upper cell; at home to one block, by the query's id."""
    def route(queries: pa.Table, cells: pa.Table) -> pa.Table:
        q, c = queries.combine_chunks(), cells.combine_chunks()
        if q.num_rows and c.num_rows:
            boxes = Boxes(c.column("band").to_numpy(), matrix(c.column("low"), DIM), matrix(c.column("high"), DIM))
            _, pq = space.queries(matrix(q.column("vec"), space.dim))
            i, at = boxes.near(space, pq, q.column("bound").to_numpy(), home)
            parts = c.column("parts").to_numpy()[at]
            ids = q.column("id").to_numpy()[i]
            copies = np.ones(len(i), np.int64) if home else parts
            spot = np.repeat(np.arange(len(i)), copies)
            part = (mix64(ids.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64) if home else np.arange(len(spot)) - np.repeat(np.cumsum(copies) - copies, copies)
            q, c = q.take(pa.array(i[spot])), c.take(pa.array(at[spot]))
        else:
            q, c, part = q.slice(0, 0), c.slice(0, 0), np.empty(0, np.int64)
        return pa.table({"id": q.column("id"), "vec": q.column("vec"), "bound": q.column("bound"), "cell": c.column("cell"), "sub": c.column("sub"), "part": pa.array(part, pa.int64())})
    return route


def search_block(space: Space, rows: tuple, far: np.ndarray, qid: int, q: np.ndarray, unit: np.ndarray, bound: float, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Ids and scores of a block's rows that may be among a query's k nearest, and the bound they leave."""
    ids, x, y, band, shift = rows
    one = len(band) == 1  # a band for all rows

    def within(spots: np.ndarray) -> np.ndarray:
        return spots[far[spots] <= space.radius(bound, band if one else band[spots])]
    left = within(np.flatnonzero(ids != qid))
    seen, seen_t, size = [np.empty(0, np.int64)], [np.empty(0)], STEP
    while len(left):
        if len(left) > size:
            near = np.argpartition(far[left], size)
            step, left = left[near[:size]], left[near[size:]]
        else:
            step, left = left, left[:0]
        t = np.ldexp(y[step] @ unit, shift if one else shift[step])
        keep = np.concatenate([*seen, step]), np.concatenate([*seen_t, t])
        if len(keep[0]) > k:
            # rounding moves a product by far less; ties are settled below
            kth = float(np.partition(keep[1], len(keep[1]) - k)[-k])
            best = keep[1] >= kth - 1e-9 * abs(kth) - 1e-12 * np.abs(keep[1]).max()
            keep = keep[0][best], keep[1][best]
            bound = max(bound, bound_of(kth))
        elif len(keep[0]) == k:
            bound = max(bound, bound_of(float(keep[1].min())))
        seen, seen_t = [keep[0]], [keep[1]]
        left = within(left)
        size *= 4
    spots = seen[0]
    score = dots(x[spots], q)
    first = np.lexsort((ids[spots], -score))[:k]
    return ids[spots[first]], score[first], bound


def _searcher(space: Space, k: int, home: bool):
    """The block's hits of each query, or at home the queries with the bound found there."""
    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        queries = queries.combine_chunks()
        bounds = queries.column("bound").to_numpy().copy()
        out_q, out_i, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if rows.num_rows and queries.num_rows:
            ids, x, band = rows.column("id").to_numpy(), matrix(rows.column("vec"), space.dim), rows.column("band").to_numpy()
            y, _ = scaled(x)
            p = space.rows(y)
            square = (p * p).sum(axis=1)
            if (band == band[0]).all():
                band = band[:1]
            block = (ids, x, y, band, (band - SHIFT).astype(np.int32))
            qids, qs = queries.column("id").to_numpy(), matrix(queries.column("vec"), space.dim)
            for a in range(0, len(qs), 64):
                units, pqs = space.queries(qs[a:a + 64])
                fars = square[None] + (pqs * pqs).sum(axis=1)[:, None] - 2 * (pqs @ p.T)
                for j in range(len(units)):
                    i, s, bounds[a + j] = search_block(space, block, fars[j], int(qids[a + j]), qs[a + j], units[j], float(bounds[a + j]), k)
                    out_q.append(np.full(len(i), qids[a + j], np.int64))
                    out_i.append(i)
                    out_s.append(s)
        if home:
            return pa.table({"id": queries.column("id"), "vec": queries.column("vec"), "bound": pa.array(bounds, pa.float64())})
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_i), "score": np.concatenate(out_s)})
    return search


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int, int]:
    """id, vec (of floats as given, else doubles) of the rows that take part, their number of components and their count."""
    kind = vectors.schema[vec_col].dataType
    kind = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec")).where("id is not null and vec is not null")
    fine = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("vec", lambda c: c != 0)
    v = v.where(F.coalesce(fine, F.lit(False)))
    most = v.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim, n = (most["dim"], most["n"]) if most else (0, 0)
    return v.where(F.size("vec") == dim), dim, n


def _planes(v: DataFrame, index: Index) -> dict[int, tuple[list[int], list[float]]]:
    """The planes below each upper cell: medians of its widest axes; a row an upper cell reaches the driver."""
    axes = [f"p{i}" for i in range(DIM)]
    stats = [F.count("*").alias("n"), F.array(*[F.coalesce(F.stddev(a), F.lit(0.0)) for a in axes]), F.array(*[F.percentile_approx(a, 0.5, 1000) for a in axes])]
    projected = v.mapInArrow(_projector(index), "cell long, " + ", ".join(f"{a} double" for a in axes))
    out = {}
    for cell, n, wide, middle in projected.groupBy("cell").agg(*stats).collect():
        cuts = min(DIM, max(0, math.ceil(math.log2(n / BLOCK))))
        widest = sorted(range(DIM), key=lambda i: (-wide[i], i))[:cuts]
        out[cell] = (widest, [middle[i] for i in widest])
    return out


def nearest(vectors: DataFrame, k: int = 20, modulus: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of each row whose id is divisible by ``modulus``."""
    spark = vectors.sparkSession
    v, dim, n = usable(vectors, id_col, vec_col)
    if dim == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vec = v.schema["vec"].dataType.simpleString()
    space = Space(dim)
    part = int(min(1.0, FIT_ROWS / n) * (1 << 20))
    drawn = v.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < part).limit(2 * FIT_ROWS).collect()  # a bound: about FIT_ROWS vectors
    sample_ids, sample = np.array([r[0] for r in drawn], np.int64), np.array([r[1] for r in drawn], np.float64).reshape(-1, dim)
    # an upper cell is fitted on as many sample rows as stand for a block
    index = Index(space, sample, max(LEAF_FIT_ROWS, BLOCK * len(sample) // n))
    placed = materialize(v.mapInArrow(_placer(index, _planes(v, index)), f"id long, vec {vec}, band long, cell long, sub long"), "placed")

    axes = [f"p{i}" for i in range(DIM)]
    sides = [F.array(*[g(a) for a in axes]).alias(name) for g, name in ((F.min, "low"), (F.max, "high"))]
    boxed = placed.mapInArrow(_boxer(space), "band long, cell long, sub long, " + ", ".join(f"{a} double" for a in axes))
    cells = boxed.groupBy("cell", "sub").agg(F.first("band").alias("band"), F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"), *sides)
    cells = materialize(cells, "cells")
    # a row for each upper cell, of which there are at most 2 * FIT_ROWS / LEAF_FIT_ROWS and one for each other band
    edges = [F.array(*[g(F.col(side)[i]) for i in range(DIM)]) for g, side in ((F.min, "low"), (F.max, "high"))]
    top = cells.groupBy("cell").agg(F.first("band"), *edges).collect()
    upper, upper_cells = Boxes(*([r[i] for r in top] for i in (1, 2, 3))), np.array([r[0] for r in top], np.int64)

    blocks = placed.join(cells.select("cell", "sub", "parts"), ["cell", "sub"]).withColumn("part", F.pmod(F.xxhash64("id", "vec"), "parts"))
    groups = max(1, math.ceil(n / modulus / QUERIES_PER_CELL))
    many_cells = cells.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def visit(queries: DataFrame, home: bool) -> DataFrame:
        """The queries' hits in all blocks that may hold a neighbour, or at home their bounds."""
        asked = f"id long, vec {vec}, bound double"
        sent = queries.mapInArrow(_upper(space, upper, upper_cells, home), asked + ", cell long").withColumn("turn", F.pmod(F.xxhash64("id", "vec"), F.lit(groups).cast("long")))
        sent = sent.groupBy("cell", "turn").cogroup(many_cells.groupBy("cell", "turn")).applyInArrow(_lower(space, home), asked + ", cell long, sub long, part long")
        sent = materialize(sent, "sent")
        load = sent.groupBy("cell", "sub", "part").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("long").alias("turns"))
        key = ["cell", "sub", "part", "turn"]
        rows = blocks.join(load, ["cell", "sub", "part"]).withColumn("turn", F.explode(F.expr("sequence(0L, turns - 1)"))).select("id", "vec", "band", *key)
        sent = sent.join(load, ["cell", "sub", "part"]).withColumn("turn", F.pmod(F.xxhash64("id", "vec"), "turns")).select("id", "vec", "bound", *key)
        return rows.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_searcher(space, k, home), asked if home else "query_id long, vec_id long, score double")

    queries = v.where(F.col("id") % modulus == 0).repartition(F.xxhash64("id", "vec")).mapInArrow(_bounder(space, sample_ids, sample, k), f"id long, vec {vec}, bound double")
    found = visit(materialize(visit(queries, home=True), "bounds"), home=False)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
