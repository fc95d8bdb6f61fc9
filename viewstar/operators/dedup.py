"""Deduplication.

Batch: one survivor per key, chosen deterministically (smallest row by the
given ordering).  Expressed as an aggregation, not a window: the partial
(map-side) aggregate collapses a hot key before the shuffle, so a key that
holds a third of all rows never lands in one task whole.

Batch, wide rows: few keys repeat, so `repeated_keys` finds them by a hash
aggregate over the key alone; rows of other keys pass without a shuffle, and
only rows of repeated keys are compared column by column.

Stream: first arrival wins, with state bounded by the event-time
watermark (`dropDuplicatesWithinWatermark` evicts a key once the watermark
passes it; plain `dropDuplicates` on a key without event time would keep
every key forever).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUP_HORIZON = "1 day"
#: Repeated keys of at most so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20


def dedup_stable(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the minimum of (order..., remaining columns)."""
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_survivor")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_survivor.{c}").alias(c) for c in order + rest]).select(*df.columns)


class Repeated(NamedTuple):
    keys: DataFrame
    rows: int
    bytes: int


def repeated_keys(df: DataFrame, key: str) -> Repeated:
    """The keys of more than one row, cached, with their number and bytes (a job;
    the caller unpersists `keys`)."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull()).select(key).persist()
    rows, size = keys.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()
    return Repeated(keys, rows, size or 0)


def dedup_wide(df: DataFrame, key: str, order: list[str], repeated: Repeated) -> DataFrame:
    """dedup_stable for a table that is cheap to read twice: rows of the repeated
    keys go through it, all others (and rows without a key) stay as they are."""
    if repeated.rows == 0:
        return df
    side = F.broadcast(repeated.keys) if repeated.bytes <= BROADCAST_BYTES else repeated.keys
    once = df.join(side, key, "left_anti")
    return once.unionByName(dedup_stable(df.join(side, key, "left_semi"), [key], order))


SALT_BUCKETS = 64


def dedup_stream(df: DataFrame, key: str = "id", event_time: str = "event_ts",
                 horizon: str = DEDUP_HORIZON, salt: str | None = None,
                 buckets: int = SALT_BUCKETS) -> DataFrame:
    """Streaming dedup by key under a watermark on the event time.

    A stateful operator has no map-side combine: every copy of a key is
    shuffled to the key's one state partition.  With `salt` (the name of a
    column that identifies the record's position in the source, e.g. Kafka
    partition:offset or file:row -- deterministic on replay), dedup runs in
    two stateful steps: first on (key, hash(salt) % buckets), which spreads
    the copies of a hot key over `buckets` tasks and keeps at most one per
    bucket, then on the key alone, which sees at most `buckets` copies.
    The result is the same set of keys: one first arrival per key within
    the watermark."""
    w = df.withWatermark(event_time, horizon)
    if salt is None:
        return w.dropDuplicatesWithinWatermark([key])
    spread = w.withColumn("_salt_bucket", F.pmod(F.hash(F.col(salt)), F.lit(buckets)))
    first = spread.dropDuplicatesWithinWatermark([key, "_salt_bucket"])
    return first.dropDuplicatesWithinWatermark([key]).drop("_salt_bucket", salt)
