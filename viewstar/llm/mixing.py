"""Operator 5: mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree of domains, languages and sources.  A node's
budget is divided among its children by weight; a child whose subtree can't
supply its share (its tokens times ``max_epochs``) gets all it has, and what it
lacks goes to its siblings, again by weight, until all is placed.  As a node's
own budget never exceeds what its subtree supplies, a shortage reaches an
ancestor's siblings only when the node's own children are exhausted.

A leaf with budget b and T tokens gives b div T whole epochs, and of the next
epoch the documents of the token prefix of b mod T: a seeded hash of epoch and
doc_id orders each epoch.  The prefix is found without sorting a leaf: token sums
of 4,096 ranges of the hash say which range holds the cut, and only that range's
documents are ordered.

Only native expressions run.  Tokens are runs of non-blank characters.

Defined cases: a null lang or source counts as the name '' and weighs 1, as does
any name without a weight; a document without tokens is chosen if the prefix
reaches its place; shares are rounded down to whole tokens; rows of one id have
one place in the order, smaller ones first; a weight must be positive; an empty
table gives an empty result; other columns pass through ``mixed`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from viewstar.llm.common import broadcast_small, materialize, table

DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 2}
LEVELS = ("_domain", "_lang", "_source")
RANGES_BITS = 12
HASH_BITS = 60


def domain_of(source: Column) -> Column:
    """Sources are dealt to four domains by the number that ends their name; without one: 'other'."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(number == "", "other").otherwise(F.concat(F.lit("d"), F.try_to_number(number, F.lit("999999999")).cast("long") % 4))


def _tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for k, w in weights.items():
        out = F.when(name == k, w).otherwise(out)
    return out


def _place(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch: 60 bits of an md5."""
    text = F.concat_ws(":", F.lit(seed), epoch, F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _divide(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to children (parent columns, name, cap, weight, given: the parent's budget)."""
    dec = "decimal(38,0)"
    order = W.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*parent)
    c = children.withColumn("w_rest", (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(dec))
    c = c.withColumn("b_rest", (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(dec))
    c = c.withColumn("all_of_it", F.col("cap") * F.col("w_rest") <= F.col("weight") * F.col("b_rest"))
    # what the children that give all they have leave to the others
    c = c.withColumn("left", F.col("given") - F.coalesce(F.sum(F.when(F.col("all_of_it"), F.col("cap"))).over(whole), F.lit(0)))
    c = c.withColumn("w_left", F.sum(F.when(~F.col("all_of_it"), F.col("weight"))).over(whole))
    share = F.expr("cast((cast(weight as decimal(19,0)) * cast(left as decimal(19,0))) div w_left as long)")
    return c.withColumn("budget", F.when(F.col("all_of_it"), F.col("cap")).otherwise(share)).drop("w_rest", "b_rest", "all_of_it", "left", "w_left", "given")


def leaf_budgets(leaves: DataFrame, fraction_percent: int, max_epochs: int) -> DataFrame:
    """leaves: _domain, _lang, _source, tokens -> the same with budget, epochs (whole ones) and rest."""
    d, g, s = LEVELS
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {fraction_percent} div 100").alias("given"))
    top = caps.groupBy(d).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col(d), DOMAIN_WEIGHTS))
    top = top.withColumn("given", total.scalar()).withColumn("root", F.lit(0))
    top = _divide(top, ["root"], d).select(d, F.col("budget").alias("given"))
    mid = caps.groupBy(d, g).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col(g), LANG_WEIGHTS)).join(top, d)
    mid = _divide(mid, [d], g).select(d, g, F.col("budget").alias("given"))
    low = caps.withColumn("weight", F.lit(1)).join(mid, [d, g])
    return _divide(low, [d, g], s).select(*LEVELS, "tokens", "budget",
                                          F.expr("case when tokens = 0 then 0 else budget div tokens end").alias("epochs"),
                                          F.expr("case when tokens = 0 then 0 else budget % tokens end").alias("rest"))


def decisions(rows: DataFrame, seed: int, fraction_percent: int, max_epochs: int) -> DataFrame:
    """Per leaf: epochs, rest, and the hash range that holds the cut with the tokens before it.

    rows: _domain, _lang, _source, _id, _tokens."""
    leaves = rows.groupBy(*LEVELS).agg(F.sum("_tokens").alias("tokens"))
    plan = materialize(leaf_budgets(leaves, fraction_percent, max_epochs), "leaves")
    small = broadcast_small(plan)
    part = F.shiftright(_place(seed, F.col("epochs") + 1, F.col("_id")), HASH_BITS - RANGES_BITS).alias("range")
    sums = rows.join(small.select(*LEVELS, "epochs"), list(LEVELS)).groupBy(*LEVELS, part).agg(F.sum("_tokens").alias("n"))
    upto = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("range").rowsBetween(W.unboundedPreceding, 0))
    cut = sums.withColumn("upto", upto).join(plan.select(*LEVELS, "rest"), list(LEVELS)).where("upto > rest")
    cut = cut.groupBy(*LEVELS).agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("cut"))
    return materialize(plan.join(cut, list(LEVELS), "left").select(*LEVELS, "epochs", "rest", "cut.range", "cut.before"), "decisions")


def chosen(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """The rows (with _domain, _lang, _source, _id, _tokens) and the copies of each, where over 0."""
    small = broadcast_small(plan)
    placed = rows.join(small, list(LEVELS)).withColumn("_place", _place(seed, F.col("epochs") + 1, F.col("_id")))
    at = F.shiftright("_place", HASH_BITS - RANGES_BITS)
    edge = F.coalesce(at == F.col("range"), F.lit(False))
    sure = placed.where(~edge).withColumn("_copies", F.col("epochs") + F.coalesce(at < F.col("range"), F.lit(True)).cast("long"))
    order = W.partitionBy(*LEVELS).orderBy("_place", "_id", "_tokens").rowsBetween(W.unboundedPreceding, 0)
    last = placed.where(edge).withColumn("_copies", F.col("epochs") + (F.col("before") + F.sum("_tokens").over(order) <= F.col("rest")).cast("long"))
    return sure.unionByName(last).where("_copies > 0").drop("epochs", "rest", "range", "before", "_place")


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(domain_of(F.col("source")).alias("_domain"), F.coalesce("lang", F.lit("")).alias("_lang"), F.coalesce("source", F.lit("")).alias("_source"),
                       F.col("doc_id").alias("_id"), _tokens(F.col("text")).alias("_tokens"), *more)


def selection(docs: DataFrame, seed: int = 11, fraction_percent: int = 60, max_epochs: int = 2) -> DataFrame:
    """doc_id, domain, lang, source ('' for null), n_tokens, copies of the chosen documents."""
    rows = materialize(_rows(docs), "tokens")
    out = chosen(rows, decisions(rows, seed, fraction_percent, max_epochs), seed)
    return out.select(F.col("_id").alias("doc_id"), F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
                      F.col("_tokens").alias("n_tokens"), F.col("_copies").alias("copies"))


def mixed(docs: DataFrame, seed: int = 11, fraction_percent: int = 60, max_epochs: int = 2) -> DataFrame:
    """The chosen documents, each as many times as epochs chose it, with all their columns."""
    rows = materialize(_rows(docs), "tokens")
    plan = decisions(rows, seed, fraction_percent, max_epochs)
    whole = _rows(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    out = chosen(whole, plan, seed)
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    return selection(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other'
         ELSE 'd' || (regexp_extract(source, '([0-9]{1,9})$', 1)::BIGINT % 4) END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents),
leaf AS (SELECT domain, lang, source, sum(n)::HUGEINT AS tokens, sum(n)::HUGEINT * 2 AS cap, 1 AS w FROM t GROUP BY ALL),
total AS (SELECT sum(tokens) * 60 // 100 AS given FROM leaf),
c1 AS (SELECT domain, sum(cap) AS cap, CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS w,
         (SELECT given FROM total) AS given FROM leaf GROUP BY 1),
s1 AS (SELECT *, cap * (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) <= w * (given - coalesce(sum(cap) OVER b, 0)) AS f
       FROM c1 WINDOW b AS (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b1 AS (SELECT domain, CASE WHEN f THEN cap ELSE w * (given - coalesce(sum(cap) FILTER (f) OVER (), 0)) // (sum(w) FILTER (NOT f) OVER ()) END AS given FROM s1),
c2 AS (SELECT domain, lang, sum(cap) AS cap, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS w FROM leaf GROUP BY 1, 2),
s2 AS (SELECT c2.*, given, cap * (sum(w) OVER (PARTITION BY domain) - coalesce(sum(w) OVER b, 0)) <= w * (given - coalesce(sum(cap) OVER b, 0)) AS f
       FROM c2 JOIN b1 USING (domain) WINDOW b AS (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b2 AS (SELECT domain, lang, CASE WHEN f THEN cap ELSE w * (given - coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain), 0))
         // (sum(w) FILTER (NOT f) OVER (PARTITION BY domain)) END AS given FROM s2),
s3 AS (SELECT leaf.*, given, cap * (sum(w) OVER (PARTITION BY domain, lang) - coalesce(sum(w) OVER b, 0)) <= w * (given - coalesce(sum(cap) OVER b, 0)) AS f
       FROM leaf JOIN b2 USING (domain, lang) WINDOW b AS (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b3 AS (SELECT domain, lang, source, tokens, CASE WHEN f THEN cap ELSE w * (given - coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain, lang), 0))
         // (sum(w) FILTER (NOT f) OVER (PARTITION BY domain, lang)) END AS budget FROM s3),
e AS (SELECT *, CASE WHEN tokens = 0 THEN 0 ELSE budget // tokens END AS epochs, CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM b3),
p AS (SELECT doc_id, domain, lang, source, n, epochs, rest,
        ('0x' || substr(md5('11:' || (epochs + 1) || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM t JOIN e USING (domain, lang, source)),
q AS (SELECT *, epochs + (sum(n) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n ROWS UNBOUNDED PRECEDING) <= rest)::BIGINT AS copies FROM p)
SELECT doc_id, domain, lang, source, n AS n_tokens, copies::BIGINT AS copies FROM q WHERE copies > 0
"""
