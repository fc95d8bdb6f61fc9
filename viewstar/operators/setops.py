"""Set difference used to track values not seen before (e.g. new browser
families in a batch), then appended to the seen set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unseen_values(batch: DataFrame, seen: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of `column` in the batch that `seen` lacks
    (EXCEPT DISTINCT, planned as an anti-join on the aggregated values)."""
    current = batch.select(column).where(F.col(column).isNotNull())
    return current.subtract(seen.select(column))
