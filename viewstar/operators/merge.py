"""Idempotent merges of a staged batch into a keyed table.

insert-if-absent  = INSERT ... ON CONFLICT (key) DO NOTHING: the first write
                    of a key wins, also among duplicates inside the batch.
coalescing update = ON CONFLICT (key) DO UPDATE SET c = COALESCE(new.c, old.c)
                    for the update columns; other columns keep the old row.

Both are pure DataFrame plans; applying the same batch twice changes nothing.

Scale: the batch is small next to the target.  Instead of shuffling the
whole target against the batch, the target's key column is first reduced
to the keys the batch mentions (a semi-join whose build side is the batch's
keys, broadcast only when their bytes are known to be below a bound), and the
batch is anti-joined against that small set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.operators.dedup import dedup_stable

#: A batch's keys of at most so many bytes are broadcast.
BROADCAST_BYTES = 64 << 20
#: Bytes of a row besides its key.
ROW_BYTES = 16


def rows_with_keys(target: DataFrame, batch_keys: DataFrame, key: str, key_bytes: int | None) -> DataFrame:
    """The target's rows whose key the batch mentions; `key_bytes` bounds the size of all its keys."""
    probe = F.broadcast(batch_keys) if key_bytes is not None and key_bytes <= BROADCAST_BYTES else batch_keys
    return target.join(probe, key, "left_semi")


def merge_insert_absent(target: DataFrame, batch: DataFrame, key: str,
                        order: list[str] | None = None, count_keys: bool = False) -> DataFrame:
    """Target rows plus batch rows whose key is not in the target."""
    new = dedup_stable(batch.where(F.col(key).isNotNull()), [key], order)
    fresh = new_rows(target, new, key, count_keys)
    return target.unionByName(fresh.select(*target.columns))


def new_rows(target: DataFrame, deduped_batch: DataFrame, key: str, count_keys: bool = False,
             key_bytes: int | None = None) -> DataFrame:
    """Rows of an already key-unique batch whose key the target lacks.

    `key_bytes` is a known upper bound on the bytes of the batch's keys and
    ROW_BYTES for each; without one, `count_keys` sums them (a job at plan time)
    or the choice is left to adaptive execution.  Under BROADCAST_BYTES the
    keys are broadcast and the target's key column is probed map-side (no
    shuffle of the target); above it the semi-join shuffles both sides."""
    keys = deduped_batch.select(key)
    if key_bytes is None and count_keys:
        key_bytes = keys.agg(F.sum(F.octet_length(F.col(key).cast("string")) + ROW_BYTES)).first()[0] or 0
    present = rows_with_keys(target.select(key), keys, key, key_bytes)
    return deduped_batch.join(present, key, "left_anti")


def merge_coalesce_update(target: DataFrame, batch: DataFrame, key: str,
                          update_columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Insert new keys; for existing keys set c = coalesce(new.c, old.c) on
    the update columns and keep the old value elsewhere."""
    new = dedup_stable(batch.where(F.col(key).isNotNull()), [key], order)
    t, s = target.alias("t"), new.alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_target = F.col(f"t.{key}").isNotNull()
    cols = []
    for c in target.columns:
        if c in update_columns:
            cols.append(F.when(in_target, F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")))
                        .otherwise(F.col(f"s.{c}")).alias(c))
        else:
            cols.append(F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*cols)
