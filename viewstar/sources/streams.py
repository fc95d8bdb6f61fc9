"""Stream sources.

The decode step takes any DataFrame with a `value` column, so the broker
source and a file source are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewstar.schemas import CLEAN_EVENT

DEFAULT_MAX_FILES = 10


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Broker source (needs the Kafka connector on the classpath).  Only
    `value` is used downstream (plus topic/partition/offset when the dedup
    is salted by position); `startingOffsets` defaults to 'latest'.

    `minPartitions` defaults to the cluster's parallelism: a topic with few
    partitions is split into more offset ranges (no shuffle), so the
    CPU-heavy cleaning uses every core."""
    opts = {"startingOffsets": "latest",
            "minPartitions": str(spark.sparkContext.defaultParallelism), **options}
    return spark.readStream.format("kafka").options(**opts).load()


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Message values from Parquet files with one `value BINARY` column."""
    r = spark.readStream.schema("value binary")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def cleaned_events_stream(spark: SparkSession, path: str,
                          max_files: int | None = DEFAULT_MAX_FILES) -> DataFrame:
    """Cleaned events written by the ingest query (either of its sinks), at most
    `max_files` new files per trigger, with the declared schema (nothing inferred)."""
    r = spark.readStream.schema(CLEAN_EVENT).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)
