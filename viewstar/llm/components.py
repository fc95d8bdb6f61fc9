"""Connected components of a link table, by alternating star contractions.

Each step is an aggregation (minimum neighbour, combined before its shuffle)
and an equi-join; no neighbour list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from viewstar.llm.common import materialize


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, with their number and a checksum, which show that a step changed nothing."""
    seen = Observation()
    table = materialize(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("sum")), "cc")
    return table, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (columns a, b; any direction,
    repeats and self links allowed): comp is the smallest node reachable.  Nodes
    without a link to another node are left out; an empty table gives none."""
    now, seen = _kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while seen[0]:
        # large star: the larger neighbours of u go to u's smallest neighbour (or u)
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        now, state = _kept(moved.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct())
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
