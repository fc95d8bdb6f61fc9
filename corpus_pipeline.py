"""A pipeline from documents to training tokens, five operators in turn.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept
and returns documents (the last: the digest of the token shards); ``run`` writes
each result as Parquet in the shared folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewstar.llm.circulant_minhash import deduplicated
from viewstar.llm.common import materialize, table
from viewstar.llm.containment import clean_documents
from viewstar.llm.mixing import mixed
from viewstar.llm.rank_order import identified
from viewstar.llm.repair import encoded

#: Neither the tokenizer nor the language model of the first stage can be put in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or unlike every language learned go."""
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen by the budget of their domain, language and source, once for each epoch that chose them."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token shards and returns what they hold of each document."""
    import public_tokenizers
    return encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
