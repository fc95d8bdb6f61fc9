"""Ingest query: messages -> decode -> clean -> watermark dedup -> Parquet.

The dedup state is bounded by the 1-day watermark on event_ts
(dropDuplicatesWithinWatermark), so it does not grow with the stream's
lifetime.  A batch writes files of about `file_bytes`: its rows are dealt anew
after the stateful stage, whose parallelism (`spark.sql.shuffle.partitions` at
the first run of a checkpoint) stays as it is, and adaptive execution makes as
many files, and writing tasks, as the batch's shuffled bytes ask for.

The same query counts its rows and takes a bounded sample of them by an observed
metric; `BatchMonitor` hears of both when the batch is done.
"""

from __future__ import annotations

import json
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from viewstar.operators.clean import clean, decode
from viewstar.operators.dedup import dedup_stream

DEFAULT_TRIGGER = "30 seconds"
#: Shuffled bytes (compressed) of the rows that share an output file.
DEFAULT_FILE_BYTES = 16 << 20
MONITOR_COLUMNS = ["id", "event_ts", "email", "product_id", "store_id", "current_url"]
SAMPLE_ROWS = 5
METRIC = "cleaned_events"


POSITION = "_position"


def kafka_position():
    """Record position in a Kafka source (deterministic on replay)."""
    return F.concat_ws(":", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))


def file_position():
    """Record position in a file source: file path and row index."""
    return F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))


def ingest_plan(messages: DataFrame, position=None) -> DataFrame:
    """The cleaned, deduplicated event stream (or batch) from raw messages.

    With `position` (kafka_position() or file_position()), the dedup is
    salted by record position so a key repeated across a large share of a
    micro-batch is spread over many tasks (see dedup_stream)."""
    if position is None:
        return dedup_stream(clean(decode(messages), observe="rejected"))
    m = messages.withColumn(POSITION, position)
    return dedup_stream(clean(decode(m, keep=(POSITION,)), keep=(POSITION,), observe="rejected"), salt=POSITION)


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def observed(events: DataFrame, sample_rows: int = SAMPLE_ROWS, name: str = METRIC) -> DataFrame:
    """Attach a per-batch row count and sample as an observed metric: the sink's
    own job computes them and reports them in the query progress
    (`observedMetrics[name]`), so neither costs an extra pass.

    The sample is the `sample_rows` rows of smallest md5(id): each partition
    keeps that many, and merging two partitions' rows keeps that many again."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if sample_rows:
        row = F.struct(F.md5("id").alias("order"), *[F.col(c).cast("string").alias(c) for c in MONITOR_COLUMNS])
        metrics.append(InternalFunction.collect_top_k(row, sample_rows, True).alias("sample"))
    return events.observe(name, *metrics)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={int(batch_id):012d}"


def _write_batch(path: str, file_bytes: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf  # the query's own session
        conf.set("spark.sql.adaptive.enabled", "true")
        conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes))
        conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(min(file_bytes, 1 << 20)))
        # a replayed batch replaces its own folder
        batch.hint("rebalance").write.mode("overwrite").parquet(batch_folder(path, batch_id))
    return write


def start_ingest(events: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 output_files: int | None = None, query_name: str | None = None,
                 observe_rows: bool = True, sample_rows: int = SAMPLE_ROWS, file_bytes: int = DEFAULT_FILE_BYTES) -> StreamingQuery:
    """Append the cleaned stream to Parquet at `path`, checkpointed, each batch
    into a folder of its own that a replay replaces; `read_ingested` and
    `cleaned_events_stream` read it.  With `observe_rows` the per-batch row
    count and sample are reported in the progress.

    With `output_files` the stream goes to Spark's file sink instead, in so
    many files a batch (which are then its writing tasks, too)."""
    out = observed(events, sample_rows) if observe_rows else events
    if output_files:
        w = out.repartition(output_files).writeStream.format("parquet").option("path", path)
    else:
        w = out.writeStream.foreachBatch(_write_batch(path, file_bytes))
    w = w.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned events written by the ingest query, of either sink."""
    from viewstar.schemas import CLEAN_EVENT
    return spark.read.schema(CLEAN_EVENT).option("recursiveFileLookup", "true").parquet(path)


class BatchMonitor(StreamingQueryListener):
    """Per micro-batch with rows: their number and up to `sample_rows` of them as
    JSON, printed or written to `sink` (a folder a batch, so a replay replaces
    it).  It only hears what the ingest query observed: no second stream, and a
    message is read once.

        monitor = BatchMonitor(spark, sink)
        spark.streams.addListener(monitor)
    """

    def __init__(self, spark: SparkSession, sink: str | None = None, keep: int = 1000):
        self.spark, self.sink = spark, sink
        # the last batches only: the query runs for months
        self.batches: deque[tuple[int, int]] = deque(maxlen=keep)
        self._seen: deque[tuple[str, int]] = deque(maxlen=keep)
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def drain(self, query: StreamingQuery) -> None:
        """Record what a stopped query reported and the listener hasn't heard yet (its events come later)."""
        for progress in query.recentProgress:
            self.record(progress)

    def record(self, progress) -> None:
        metric = progress.observedMetrics.get(METRIC)
        if metric is None or not metric["rows"]:
            return
        key = (str(progress.id), int(progress.batchId))
        with self._lock:
            if key in self._seen:
                return
            self._seen.append(key)
            self._write(int(progress.batchId), int(metric["rows"]), metric["sample"] if "sample" in metric else [])

    def _write(self, batch_id: int, rows: int, sample) -> None:
        found = [r if isinstance(r, dict) else r.asDict() for r in sample or []]
        samples = [json.dumps({c: r[c] for c in MONITOR_COLUMNS if r.get(c) is not None}) for r in found]
        self.batches.append((batch_id, rows))
        if self.sink:
            summary = self.spark.createDataFrame([(batch_id, rows, samples)], "batch_id long, rows long, samples array<string>")
            summary.coalesce(1).write.mode("overwrite").parquet(f"{self.sink.rstrip('/')}/batch={batch_id}")
        else:
            print(json.dumps({"batch": batch_id, "rows": rows, "samples": [json.loads(s) for s in samples]}))
