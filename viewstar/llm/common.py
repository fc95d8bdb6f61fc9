"""Helpers shared by the operators: shared scratch tables and table readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before under the folder that spark.checkpoint.dir names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder: a lost executor costs
    a re-read of that table, never a second run of what made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables of at most so many bytes, measured, are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def broadcast_small(df: DataFrame) -> DataFrame:
    """Broadcast a materialised table only when its rows, measured as text with 64 bytes more each, fit."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + F.lit(64).cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, n: int):
    """crc32 of the id's decimal text, modulo n: the folds of the contracts."""
    return F.crc32(F.col(col).cast("string")) % n
