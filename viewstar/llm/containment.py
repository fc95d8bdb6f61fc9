"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity with it, so
equal signature coordinates say nothing.  The search is therefore asymmetric:

* items are partitioned by the number of their shingles (powers of two); in a
  partition every item's sketch is its bottom-k MinHash, k being what a
  containment of ``percent`` % at the partition's upper size leaves over plus one.
  A document that holds that share of the item must hold one of these k
  shingles, so the sketch loses no leak;
* documents too small for a partition skip its items;
* candidates are verified on all shingles, compared as text.

Only native expressions run.  Shingles are five consecutive words (runs of
letters and digits, lower-cased); an item of 1 to 4 words is one shingle of
all its words and looked up among a document's runs of that length.

Defined cases: null or wordless documents and items match nothing; rows of one
doc_id (null too) are one document, rows of one item_id one item; repeated rows
change nothing; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewstar.llm.common import broadcast_small, materialize, table

SIZE = 5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """A row for each run of ``length`` words: id, n (runs of the text), words, at."""
    n = F.size("words") - length + 1
    at = F.sequence(F.lit(0), F.size("words") - length)
    return docs.where(n > 0).select("id", n.alias("n"), "words", F.explode(at).alias("at"))


def _hash(length: int) -> Column:
    return F.xxhash64(*[F.get("words", F.col("at") + j) for j in range(length)])


def _item_shingles(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    """item, length, shingle, hash: the distinct shingles of each item."""
    items = bench.select(F.col(item_id).alias("item"), _words(F.col(text)).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(SIZE)))
    at = F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length")))
    cut = items.select("item", "length", "words", at.alias("at")).select("item", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("run"))
    return cut.select("item", "length", F.array_join("run", " ").alias("shingle"),
                      F.when(F.col("length") == SIZE, F.xxhash64(*[F.get("run", F.lit(j)) for j in range(SIZE)]))
                      .otherwise(F.coalesce(*[F.when(F.col("length") == k, F.xxhash64(*[F.get("run", F.lit(j)) for j in range(k)])) for k in range(1, SIZE)]))
                      .alias("hash")).distinct()


def containments(docs: DataFrame, bench: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item of which it holds at least ``percent`` % of
    the shingles: doc_id, item_id, n_item, n_shared, containment."""
    shingles = materialize(_item_shingles(bench, item_col, item_text), "items")
    sized = shingles.groupBy("item").agg(F.count("*").alias("n_item"))
    # partition by size; `most` and `least` bound the sizes of a partition's items
    part = F.floor(F.log2("n_item"))
    sized = sized.withColumn("least", F.pow(F.lit(2), part).cast("long")).withColumn("most", F.col("least") * 2 - 1)
    keep = F.col("most") - F.ceil(F.col("most") * percent / 100) + 1
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.hash(F.col("hash")), "hash"))
    sketch = shingles.join(sized, shingles["item"].eqNullSafe(sized["item"])).drop(sized["item"])
    sketch = sketch.withColumn("rank", rank).where(F.col("rank") <= keep)
    sketch = materialize(sketch.select("item", "length", "hash", F.ceil(F.col("least") * percent / 100).alias("floor")), "sketch")
    lengths = [r[0] for r in shingles.select("length").distinct().collect()]  # at most SIZE values

    texts = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("words"))
    index = broadcast_small(sketch)
    found = None
    for k in lengths or [SIZE]:
        own = index.where(F.col("length") == k)
        hits = _runs(texts, k).select("id", "n", _hash(k).alias("hash")).join(own, "hash").where(F.col("n") >= F.col("floor"))
        found = hits.select("id", "item", "length") if found is None else found.unionAll(hits.select("id", "item", "length"))
    candidates = materialize(found.distinct(), "candidates")

    held = None
    whole = broadcast_small(shingles)
    for k in lengths or [SIZE]:
        # at every length that a candidate's item has, whichever sketch found it
        with_k = shingles.where(F.col("length") == k).select(F.col("item").alias("kitem")).distinct()
        mine = candidates.join(with_k, F.col("item").eqNullSafe(F.col("kitem")), "left_semi").select(F.col("id").alias("cid")).distinct()
        near = texts.join(mine, F.col("id").eqNullSafe(F.col("cid")), "left_semi")
        runs = _runs(near, k).select("id", F.array_join(F.slice("words", F.col("at") + 1, k), " ").alias("shingle"))
        got = runs.join(whole.where(F.col("length") == k).drop("hash", "length"), "shingle")
        held = got if held is None else held.unionAll(got)
    shared = held.distinct().groupBy("id", "item").agg(F.count("*").alias("n_shared"))
    out = shared.join(sized.select(F.col("item").alias("i"), "n_item"), F.col("item").eqNullSafe(F.col("i")))
    out = out.join(candidates.select(F.col("id").alias("cid"), F.col("item").alias("citem")),
                   F.col("id").eqNullSafe(F.col("cid")) & F.col("item").eqNullSafe(F.col("citem")), "left_semi")
    return out.where(F.col("n_shared") * 100 >= F.col("n_item") * percent).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def clean_documents(docs: DataFrame, bench: DataFrame, percent: int = 80) -> DataFrame:
    """The documents that hold no benchmark item."""
    leaks = materialize(containments(docs, bench, percent).select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak"]), "left_anti")


def op4(spark, sf_dir: str) -> DataFrame:
    return containments(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
i AS (SELECT DISTINCT item_id, least(len(ws), 5) AS k, unnest(list_transform(range(1, len(ws) - least(len(ws), 5) + 2),
        lambda p: array_to_string(ws[p:p + least(len(ws), 5) - 1], ' '))) AS sh FROM iw WHERE len(ws) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY 1),
d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda p: array_to_string(ws[p:p + k - 1], ' '))) AS sh
      FROM dw, (SELECT DISTINCT k FROM i) WHERE len(ws) >= k),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (k, sh) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM s JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80
"""
