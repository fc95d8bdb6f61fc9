"""Loader query: cleaned-event files -> foreachBatch -> warehouse, exactly once."""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from viewstar.sources.streams import DEFAULT_MAX_FILES, cleaned_events_stream
from viewstar.streaming.warehouse import KEY_HORIZON_DAYS, Warehouse

DEFAULT_TRIGGER = "30 seconds"
DEFAULT_QUERY_NAME = "star_loader"
KEEP_RESULTS = 1000


def checkpoint_query_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's stable identity: the id in the checkpoint's metadata
    file (kept across restarts, new for a new checkpoint)."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


class _BatchLoader:
    def __init__(self, warehouse: Warehouse, query_name: str, checkpoint: str, ingestion_timestamp=None,
                 key_horizon_days: int | None = KEY_HORIZON_DAYS):
        self.warehouse, self.query_name, self.checkpoint = warehouse, query_name, checkpoint
        self.ingestion_timestamp = ingestion_timestamp
        self.key_horizon_days = key_horizon_days
        self.run_id = None
        # the last results only: a loader runs for months
        self.results: deque[dict] = deque(maxlen=KEEP_RESULTS)

    def __call__(self, batch: DataFrame, batch_id: int):
        if self.run_id is None:
            self.run_id = checkpoint_query_id(batch.sparkSession, self.checkpoint)
        self.results.append(self.warehouse.load_batch(batch, batch_id, self.query_name, self.run_id,
                                                      self.ingestion_timestamp,
                                                      key_horizon_days=self.key_horizon_days))


def start_loader(spark: SparkSession, source_path: str, warehouse_root: str, checkpoint: str,
                 query_name: str = DEFAULT_QUERY_NAME, trigger: str | None = None,
                 max_files: int | None = DEFAULT_MAX_FILES, ingestion_timestamp=None,
                 key_horizon_days: int | None = KEY_HORIZON_DAYS):
    """Start the loader; returns (query, batch_loader)."""
    loader = _BatchLoader(Warehouse(spark, warehouse_root), query_name, checkpoint, ingestion_timestamp,
                          key_horizon_days)
    w = (cleaned_events_stream(spark, source_path, max_files).writeStream
         .foreachBatch(loader).outputMode("append")
         .option("checkpointLocation", checkpoint).queryName(query_name))
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger or DEFAULT_TRIGGER)
    q: StreamingQuery = w.start()
    return q, loader
