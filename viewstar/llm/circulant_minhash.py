"""Operator 8: near-duplicate documents by circulant MinHash.

All ``bands * rows`` signature coordinates of a shingle set come from two
permutations of a ring of ``RING`` slots: the first scatters the set, the second
is read at one circular shift per coordinate and its minimum over the set kept.
Bands of the signature are the candidate buckets; every link is confirmed on the
full sets.

Buckets of many texts are never turned into all their pairs:

* documents with equal sets are one candidate, of their smallest id; only candidates
  have links and components, which their copies get afterwards;
* a text can only link if at least the threshold share of its shingles occurs in
  another candidate text, which one count per shingle decides for all of them;
* each bucket first compares its members with one pivot, the text whose shingles
  are shared most. Buckets whose members are in one component by then are done, as
  a link inside a component can't change the result. Those left, taken together where they
  share members, compare the texts outside the largest component with all
  others in blocks of bounded size, where intersections are products of
  incidence matrices; a block returns only links that join components.

Defined cases: null or blank text has no shingles, is its own component and
kept; 1 to 4 words are one shingle; rows of one id are one document, linked by
any of its texts; rows without an id are kept with a null component; other
columns are ignored; an empty table gives an empty result.  Ties go to the
smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.common import materialize
from viewstar.llm.components import components
from viewstar.llm.kernel import long_lists, mix64, pieces, release, text_shingles

RING = 1 << 20
#: Sets and shingles of one side of a block that a task compares, and columns of their incidence at a time.
BLOCK_SETS, BLOCK_SHINGLES, COLUMNS = 1024, 500_000, 2048
#: Groups of at least so many exact copies, and of at least this fraction of all rows, get their component by a broadcast.
HOT_COPIES, HOT_GROUPS = 1000, 10_000


@lru_cache(maxsize=2)
def _permutations(width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows of ``width`` circular shifts of the other."""
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(RING).astype(np.int64)
    shifted = rng.permutation(RING).astype(np.uint32)
    ring = np.concatenate([shifted, shifted[:width - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(ring, width)


def signature(shingles: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Circulant MinHash coordinates of a non-empty set of 64-bit shingles."""
    scatter, windows = _permutations(width, seed)
    slots = np.unique(scatter[(shingles & np.uint64(RING - 1)).astype(np.int64)])
    low = windows[slots[0]].copy()
    for a in range(0, len(slots), 256):
        np.minimum(low, windows[slots[a:a + 256]].min(axis=0), out=low)
    return low


def _set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent fingerprints of each set."""
    one = [s.sum(dtype=np.uint64) for s in sets]
    two = [mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets]
    return tuple(mix64(np.array(x, np.uint64)).view(np.int64) for x in (one, two))


def _sketcher(bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = mix64(np.arange(1, bands + 1).astype(np.uint64))
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = text_shingles(part.column("text"))
                one, two = _set_ids(sets)
                keys = []
                for s in sets:
                    if len(s):
                        key = base.copy()
                        for col in signature(s, bands * rows).reshape(bands, rows).T:
                            key = mix64(key ^ col.astype(np.uint64))
                        keys.append(key)
                    else:
                        keys.append(np.empty(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two), long_lists(keys)],
                    ["id", "n", "sid", "sid2", "bands"])
            release()
    return sketch


def _setter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            sets = text_shingles(part.column("text"))
            sids = _set_ids(sets)[0]
            right = np.flatnonzero(sids == part.column("sid").to_numpy())
            sets = [sets[i] for i in right]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids[right]), pa.array([len(s) for s in sets], pa.int64()), long_lists(sets)], ["sid", "n", "shingles"])
    release()


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""
    def side(c):
        return sets.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"), F.col("shingles").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * percent).select(*pairs.columns).distinct()


def _compare(percent: int):
    """Links between the outsiders and the members of one block that join two components."""
    def compare(members: pa.Table, outside: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        if members.num_rows and outside.num_rows:
            sides = []
            for t in (outside, members):
                lists = t.column("shingles").combine_chunks()
                sides.append((t.column("sid").to_numpy(), t.column("comp").to_numpy(), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()))
            (q, q_comp, q_n, q_flat), (m, m_comp, m_n, m_flat) = sides
            _, column = np.unique(np.concatenate([q_flat, m_flat]), return_inverse=True)
            shared = np.zeros((len(q), len(m)), np.float32)
            q_row, m_row = np.repeat(np.arange(len(q)), q_n), np.repeat(np.arange(len(m)), m_n)
            for lo in range(0, int(column.max()) + 1, COLUMNS):  # intersection sizes, some columns of the incidence at a time
                both = []
                for size, row, col in ((len(q), q_row, column[:len(q_flat)]), (len(m), m_row, column[len(q_flat):])):
                    here = (col >= lo) & (col < lo + COLUMNS)
                    has = np.zeros((size, COLUMNS), np.float32)
                    has[row[here], col[here] - lo] = 1
                    both.append(has)
                shared += both[0] @ both[1].T
            close = shared * 100 >= (q_n[:, None] + m_n[None, :] - shared) * percent
            root: dict[int, int] = {}

            def top(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c
            for i, j in zip(*np.nonzero(close & (q_comp[:, None] != m_comp[None, :]))):
                x, y = top(int(q_comp[i])), top(int(m_comp[j]))
                if x != y:  # what is joined already needs no second link
                    root[x] = y
                    links.append((int(q[i]), int(m[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return compare


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between sets that join every component of a bucket.

    members: key, sid, n, shared (of the set's n shingles, those that other candidates have).
    Two sets share at most the smaller ``shared``, which leaves out most pairs with a pivot unseen."""
    order = F.struct((F.col("shared") / F.col("n")).alias("share"), "n", "sid")
    best = members.groupBy("key").agg(F.max_by(F.struct("sid", "n", "shared"), order).alias("p"))
    best = materialize(best.select("key", F.col("p.sid").alias("b"), F.col("p.n").alias("n_b"), F.col("p.shared").alias("shared_b")), "pivots")
    fits = F.least("shared", "shared_b") * (100 + percent) >= (F.col("n") + F.col("n_b")) * percent
    pair = (F.least(F.col("sid"), F.col("b")).alias("a"), F.greatest(F.col("sid"), F.col("b")).alias("b"))
    tested = materialize(members.join(best, "key").where((F.col("sid") != F.col("b")) & fits).select(*pair).distinct(), "pairs")
    links = materialize(_verify(tested, sets, percent), "links")

    label = components(links).select(F.col("node").alias("sid"), "comp")
    named = members.select("key", "sid", "n").join(label, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    split = named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    live = materialize(named.join(split, "key"), "live")
    if live.isEmpty():
        return links
    # the buckets left, joined where they share a member, are families; each is compared in blocks
    family = components(live.join(best, "key").select(F.col("sid").alias("a"), "b"))
    one = live.select("sid", "n", "comp").distinct().join(family.select(F.col("node").alias("sid"), F.col("comp").alias("family")), "sid")
    parts = one.groupBy("family", "comp").agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    sizes = parts.groupBy("family").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("k"), F.sum("s").alias("s"),
                                        F.max(F.struct("k", "comp", "s")).alias("most"))
    blocks = lambda k, s: F.ceil(F.greatest(k / BLOCK_SETS, s / BLOCK_SHINGLES))
    sizes = sizes.select("family", "main", blocks(F.col("k"), F.col("s")).alias("m_blocks"), blocks(F.col("k") - F.col("most.k"), F.col("s") - F.col("most.s")).alias("q_blocks"))
    one = materialize(one.join(sizes, "family").where("q_blocks > 0"), "families")
    at = lambda n: F.pmod(F.xxhash64("sid", F.lit("block")), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    cols = ("family", "sid", "comp")
    inside = one.select(*cols, at(F.col("m_blocks")).alias("m"), "q_blocks").select(*cols, "m", every(F.col("q_blocks")).alias("q"))
    outside = one.where("comp <> main").select(*cols, at(F.col("q_blocks")).alias("q"), "m_blocks").select(*cols, every(F.col("m_blocks")).alias("m"), "q")
    known = sets.select("sid", "shingles")
    key = ["family", "m", "q"]
    names = ["sid", "family", "comp", "m", "q", "shingles"]
    inside, outside = (side.join(known, "sid").select(*names).toDF(*names) for side in (inside, outside))  # toDF: both sides stem from one table
    new = inside.groupBy(*key).cogroup(outside.groupBy(*key)).applyInArrow(_compare(percent), "a long, b long")
    return links.unionAll(materialize(new, "links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    bands: int = 32, rows: int = 8) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (the smallest id reachable
    over links of at least ``percent`` % Jaccard similarity), kept."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketches = materialize(texts.mapInArrow(_sketcher(bands, rows), "id long, n long, sid long, sid2 long, bands array<long>"), "sketch")
    known = sketches.where("id is not null and n > 0")
    group = ["n", "sid", "sid2"]
    reps = materialize(known.groupBy(*group).agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies")), "reps")

    at = reps.select("id", "sid", F.explode("bands").alias("key"))
    full = at.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialize(at.join(full, "key").select("key", "id", "sid"), "members")

    wanted = members.select("id", "sid").distinct()
    sets = materialize(texts.join(wanted, "id").mapInArrow(_setter, "sid long, n long, shingles array<long>"), "sets")
    flat = sets.select("sid", F.explode("shingles").alias("shingle"))
    common = flat.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = flat.join(common, "shingle", "left_semi").groupBy("sid").agg(F.count("*").alias("shared"))
    able = sets.select("sid", "n").distinct().join(shared, "sid").where(F.col("shared") * 100 >= F.col("n") * percent).select("sid", "n", "shared")
    able = materialize(able, "able")
    members = materialize(members.select("key", "sid").join(able, "sid"), "members")

    links = _links(members, sets, percent)
    ids = reps.select("sid", "id").distinct()
    edges = links.join(ids.select(F.col("sid").alias("a"), F.col("id").alias("ia")), "a").join(ids.select(F.col("sid").alias("b"), F.col("id").alias("ib")), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    # rows of one id that differ tie their groups together
    spans = [f(c).alias(f"{k}_{c}") for c in ("sid", "sid2") for k, f in (("low", F.min), ("high", F.max))]
    mixed = known.groupBy("id").agg(*spans).where("low_sid <> high_sid OR low_sid2 <> high_sid2").select("id")
    own = known.join(mixed, "id", "left_semi").join(reps.select(*group, F.col("id").alias("b")), group).select("id", "b").distinct()
    tied = own.join(own.groupBy("id").agg(F.min("b").alias("a")), "id").where("a <> b").select("a", "b")
    comp = components(edges.unionAll(tied)).where("node <> comp")
    named = reps.join(comp, reps["id"] == comp["node"], "left").select(*group, "copies", "id", F.coalesce("comp", "id").alias("component_id"))
    # exact copies need no links: their group's component is theirs; other groups of one row are their own
    moved = materialize(named.where("copies > 1 OR component_id <> id").select(*group, "copies", "component_id"), "named")
    least = max(HOT_COPIES, (reps.agg(F.sum("copies")).first()[0] or 0) // HOT_GROUPS)
    hot, rest = (moved.where(test).drop("copies") for test in (F.col("copies") >= least, F.col("copies") < least))
    cols = ("id", "n", "component_id")
    # at most HOT_GROUPS groups of so many copies, some 40 bytes each; a key of the other join has fewer rows
    in_hot = known.join(F.broadcast(hot), group).select(*cols)
    in_rest = known.join(F.broadcast(hot), group, "left_anti").join(rest, group, "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    blank = sketches.where("id is not null and n = 0")
    also = known.join(blank.select("id").distinct(), "id", "left_semi").join(moved, group).groupBy("id").agg(F.min("component_id").alias("component_id"))
    alone = sketches.where("id is null or n = 0").join(also, "id", "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    out = in_hot.unionAll(in_rest).unionAll(alone)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = 80, bands: int = 40, rows: int = 6) -> DataFrame:
    """The documents (all their columns) with the smallest id of their component; of rows that
    share that id the first by text stays, and rows without an id all do. 40 bands of 6 miss
    0.0005 % of the pairs of similarity 0.8, less above."""
    copies = materialize(near_duplicates(docs, percent=percent, bands=bands, rows=rows).where("not kept").select(F.col("doc_id").alias("copy")).distinct(), "copies")
    twice = materialize(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("copy")), "twice")
    left = docs.join(copies, docs["doc_id"] == copies["copy"], "left_anti")
    single = left.join(twice, left["doc_id"] == twice["copy"], "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = left.join(twice, left["doc_id"] == twice["copy"], "left_semi").select(F.col("doc_id").alias("_key"), row.alias("_row"))
    first = several.groupBy("_key").agg(F.min_by("_row", F.struct(F.col("_row.text"), F.xxhash64("_row"))).alias("_row"))
    return single.unionByName(first.select("_row.*"))


def op8(spark, sf_dir: str) -> DataFrame:
    from viewstar.llm.common import table
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
r(node, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.low FROM r JOIN e ON e.x = r.node WHERE r.low < e.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.low) AS component_id, d.doc_id = min(r.low) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n
"""
