"""JDBC staging sink and warehouse reader for a relational warehouse.
Code path only here: no database runs in this environment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_WRITERS = 4


def write_staging(df: DataFrame, url: str, table: str, properties: dict[str, str],
                  writers: int = DEFAULT_WRITERS) -> None:
    """Overwrite a staging table with `writers` parallel JDBC connections
    (numPartitions caps the connections; no extra shuffle)."""
    (df.write.format("jdbc").mode("overwrite")
       .option("url", url).option("dbtable", table).option("numPartitions", str(writers))
       .options(**properties).save())


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """Read a warehouse table; with a numeric partition column the read is
    split into `partitions` parallel range queries."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and partitions:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    return r.load()
