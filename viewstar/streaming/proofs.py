"""Streaming runs used by the registered proofs.

Each run writes into a fresh folder under the session's checkpoint
directory (spark.checkpoint.dir), uses `availableNow` triggers and returns
the resulting tables.  Runs are memoised per (application, input folder) so
several proofs share one ingest and one load.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.batch import unique_clicks
from viewstar.schemas import RAW_COLUMNS
from viewstar.session import scratch_dir
from viewstar.sources.fixtures import clicks, messages
from viewstar.sources.streams import file_messages
from viewstar.streaming.ingest import METRIC, BatchMonitor, file_position, ingest_plan, read_ingested, start_ingest
from viewstar.streaming.loader import start_loader
from viewstar.streaming.warehouse import Warehouse

PROOF_LOAD_TIME = _dt.datetime(2024, 2, 1, tzinfo=_dt.timezone.utc)
LOADER_BATCHES = 4
_RUNS: dict = {}


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)


#: Last dates of the parts that the proofs deliver one after the other.
PART_ENDS = (_dt.date(2024, 1, 10), _dt.date(2024, 1, 20))


def span_of(d):
    """Which of the parts (1, 2, 3) a date belongs to."""
    return 1 + sum((d > F.lit(end)).cast("int") for end in PART_ENDS)


def _so_far(folder: str, last: int) -> str:
    return f"{folder}/part={{{','.join(map(str, range(last + 1)))}}}"


def ingest_run(spark: SparkSession, sf_dir: str) -> dict:
    """Messages of three spans of dates as Parquet files -> the ingest query with
    its monitor, a batch for each span."""
    k = _key(spark, sf_dir, "ingest")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_dir(spark, "ingest")
    msgs, out, sink = f"{root}/messages", f"{root}/cleaned", f"{root}/monitor"
    messages(spark, sf_dir, span_of(F.col("d"))).write.partitionBy("part").parquet(msgs)
    monitor = BatchMonitor(spark, sink)
    spark.streams.addListener(monitor)
    input_rows = 0
    try:
        for part in range(1, len(PART_ENDS) + 2):
            q = start_ingest(ingest_plan(file_messages(spark, _so_far(msgs, part))), out, f"{root}/ckpt_ingest", trigger="availableNow")
            q.awaitTermination()
            monitor.drain(q)
            input_rows += sum(p.numInputRows for p in q.recentProgress)
    finally:
        spark.streams.removeListener(monitor)
    run = {"root": root, "messages": f"{msgs}/part=*", "cleaned": out, "monitor": sink, "input_rows": input_rows}
    _RUNS[k] = run
    return run


def salted_ingest_run(spark: SparkSession, sf_dir: str) -> str:
    """The ingest query with its dedup salted by record position, to Spark's file sink."""
    k = _key(spark, sf_dir, "salted")
    if k in _RUNS:
        return _RUNS[k]
    ing = ingest_run(spark, sf_dir)
    root = scratch_dir(spark, "salted")
    q = start_ingest(ingest_plan(file_messages(spark, ing["messages"]), file_position()), f"{root}/out",
                     f"{root}/ckpt", trigger="availableNow", output_files=8)
    q.awaitTermination()
    _RUNS[k] = f"{root}/out"
    return _RUNS[k]


def _as_messages(raw: DataFrame) -> DataFrame:
    return raw.select(F.to_json(F.struct(*RAW_COLUMNS)).cast("binary").alias("value"))


def late_rows_run(spark: SparkSession, sf_dir: str) -> list[tuple[int, int, int]]:
    """Three triggers, the watermark moving between them: (trigger, rows out, rows
    dropped as late).  The third brings new ids of 3 January (late), ids of 2
    January again with a time of 21 January (their state has expired: emitted
    again) and rows of 20 January again (still in the state: dropped as copies)."""
    k = _key(spark, sf_dir, "late")
    if k in _RUNS:
        return _RUNS[k]
    root = scratch_dir(spark, "late")
    raw = clicks(spark, sf_dir)
    ms = F.col("time_stamp") > 10 ** 12
    d = F.when(ms, F.timestamp_millis("time_stamp")).otherwise(F.timestamp_seconds("time_stamp")).cast("date")
    day = lambda n: raw.where(d == F.lit(_dt.date(2024, 1, n)))
    moved = F.col("time_stamp") + F.when(ms, 19 * 86_400_000).otherwise(19 * 86_400)
    real_id = F.trim("id") != ""
    parts = [raw.where(d <= F.lit(PART_ENDS[0])), raw.where((d > F.lit(PART_ENDS[0])) & (d <= F.lit(PART_ENDS[1]))),
             day(3).where(real_id).withColumn("id", F.concat(F.lit("late-"), "id")).unionByName(day(2).withColumn("time_stamp", moved)).unionByName(day(20))]
    rows = []
    for part, some in enumerate(parts):
        _as_messages(some).write.parquet(f"{root}/messages/part={part}")
        q = start_ingest(ingest_plan(file_messages(spark, _so_far(f"{root}/messages", part))), f"{root}/out", f"{root}/ckpt", trigger="availableNow")
        q.awaitTermination()
        rows.append((part + 1, sum(p.observedMetrics[METRIC]["rows"] for p in q.recentProgress if METRIC in p.observedMetrics),
                     sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)))
    _RUNS[k] = rows
    return rows


def timed_run(spark: SparkSession, sf_dir: str) -> str:
    """The ingest query under a processing-time trigger while its source drips:
    each part is delivered when the one before has come through; then it is stopped."""
    k = _key(spark, sf_dir, "timed")
    if k in _RUNS:
        return _RUNS[k]
    msgs = ingest_run(spark, sf_dir)["messages"].removesuffix("/part=*")
    root = scratch_dir(spark, "timed")
    q = None
    try:
        for part in range(len(PART_ENDS) + 2):
            spark.read.schema("value binary").parquet(f"{msgs}/part={part}").write.parquet(f"{root}/messages/part={part}")
            q = q or start_ingest(ingest_plan(file_messages(spark, f"{root}/messages/part=*")), f"{root}/out", f"{root}/ckpt", trigger="1 second")
            q.processAllAvailable()
    finally:
        if q is not None:
            q.stop()
    _RUNS[k] = f"{root}/out"
    return _RUNS[k]


def roundtrip_run(spark: SparkSession, sf_dir: str) -> str:
    """Ingest output -> Parquet file stream source (a few files per trigger)
    -> Parquet stream sink, checkpointed; returns the sink folder."""
    k = _key(spark, sf_dir, "roundtrip")
    if k in _RUNS:
        return _RUNS[k]
    from viewstar.sources.streams import cleaned_events_stream
    ing = ingest_run(spark, sf_dir)
    n_files = len(read_ingested(spark, ing["cleaned"]).inputFiles())
    root = scratch_dir(spark, "roundtrip")
    src = cleaned_events_stream(spark, ing["cleaned"], max(1, math.ceil(n_files / LOADER_BATCHES)))
    q = start_ingest(src, f"{root}/out", f"{root}/ckpt", trigger="availableNow", observe_rows=False)
    q.awaitTermination()
    _RUNS[k] = f"{root}/out"
    return _RUNS[k]


def load_run(spark: SparkSession, sf_dir: str) -> dict:
    """Ingest output -> loader query (several micro-batches) -> warehouse."""
    k = _key(spark, sf_dir, "load")
    if k in _RUNS:
        return _RUNS[k]
    ing = ingest_run(spark, sf_dir)
    n_files = len(read_ingested(spark, ing["cleaned"]).inputFiles())
    per_batch = max(1, math.ceil(n_files / LOADER_BATCHES))
    root = scratch_dir(spark, "warehouse")
    q, loader = start_loader(spark, ing["cleaned"], f"{root}/wh", f"{root}/ckpt_loader",
                             trigger="availableNow", max_files=per_batch,
                             ingestion_timestamp=PROOF_LOAD_TIME)
    q.awaitTermination()
    run = {"root": f"{root}/wh", "results": loader.results, "run_id": loader.run_id}
    _RUNS[k] = run
    return run


class CrashingWarehouse(Warehouse):
    """A writer that dies when its tables are written, before the ledger row."""

    def _commit(self, query_name: str, run_id: str, batch_id: int, lid: str) -> None:
        raise RuntimeError(f"simulated crash before the commit of batch {batch_id}")


def replay_run(spark: SparkSession, sf_dir: str, a_last: _dt.date, b_first: _dt.date) -> Warehouse:
    """Batch 0 commits; batch 1 fails after writing its tables and before
    the ledger; batch 1 is replayed (commits) and replayed again (skipped)."""
    k = _key(spark, sf_dir, "replay")
    if k in _RUNS:
        return _RUNS[k]
    cleaned = _unique_events(spark, sf_dir)
    root = f"{scratch_dir(spark, 'replay')}/wh"
    wh = Warehouse(spark, root)
    b0 = cleaned.where(F.col("event_date") <= F.lit(a_last))
    b1 = cleaned.where(F.col("event_date") >= F.lit(b_first))
    log = [wh.load_batch(b0, 0, "replay", "run-1", PROOF_LOAD_TIME)]
    try:
        CrashingWarehouse(spark, root).load_batch(b1, 1, "replay", "run-1", PROOF_LOAD_TIME)
    except RuntimeError:
        log.append({"batch_id": 1, "status": "failed"})
    visible_after_failure = wh.read("fact_log_event").count()
    log.append(wh.load_batch(b1, 1, "replay", "run-1", PROOF_LOAD_TIME))
    log.append(wh.load_batch(b1, 1, "replay", "run-1", PROOF_LOAD_TIME))
    wh.log = log
    wh.visible_after_failure = visible_after_failure
    _RUNS[k] = wh
    return wh


def evolved_run(spark: SparkSession, sf_dir: str, a_last: _dt.date, b_first: _dt.date) -> Warehouse:
    """A warehouse whose batch 0 was written in layout 1 (no browser, no email,
    narrower counts) and batch 1, which overlaps it, in today's."""
    k = _key(spark, sf_dir, "evolved")
    if k in _RUNS:
        return _RUNS[k]
    cleaned = _unique_events(spark, sf_dir)
    root = f"{scratch_dir(spark, 'evolved')}/wh"
    Warehouse(spark, root, layout=1).load_batch(cleaned.where(F.col("event_date") <= F.lit(a_last)), 0, "evolved", "run-1", PROOF_LOAD_TIME)
    wh = Warehouse(spark, root)
    wh.load_batch(cleaned.where(F.col("event_date") >= F.lit(b_first)), 1, "evolved", "run-1", PROOF_LOAD_TIME)
    _RUNS[k] = wh
    return wh


def seen_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Batch 0 holds the events of two stores, batch 1 all events."""
    k = _key(spark, sf_dir, "seen")
    if k not in _RUNS:
        cleaned = _unique_events(spark, sf_dir)
        wh = Warehouse(spark, f"{scratch_dir(spark, 'seen')}/wh")
        wh.load_batch(cleaned.where(F.col("store_id").isin("0", "1")), 0, "seen", "run-1", PROOF_LOAD_TIME)
        wh.load_batch(cleaned, 1, "seen", "run-1", PROOF_LOAD_TIME)
        _RUNS[k] = wh
    return _RUNS[k]


def redelivered_run(spark: SparkSession, sf_dir: str, a_last: _dt.date) -> Warehouse:
    """Ids of the first five days come again: those that end in 7 in batch 1 with
    times 20 days later (let in by the bounded look-up), those that end in 6 in
    batch 2 with their own times (found)."""
    k = _key(spark, sf_dir, "redelivered")
    if k not in _RUNS:
        cleaned = _unique_events(spark, sf_dir)
        old = cleaned.where(F.col("event_date") <= F.lit(_dt.date(2024, 1, 5)))
        moved = old.where(F.col("id").endswith("7")).withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 20 DAYS"))
        moved = moved.withColumn("event_date", F.to_date("event_ts")).select(*cleaned.columns)
        batches = [cleaned.where(F.col("event_date") <= F.lit(a_last)), cleaned.where(F.col("event_date") > F.lit(a_last)).unionByName(moved),
                   old.where(F.col("id").endswith("6"))]
        wh = Warehouse(spark, f"{scratch_dir(spark, 'redelivered')}/wh")
        for i, batch in enumerate(batches):
            wh.load_batch(batch, i, "redelivered", "run-1", PROOF_LOAD_TIME)
        _RUNS[k] = wh
    return _RUNS[k]


def with_violations(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star tables with rows added that break every rule: copies of some rows,
    rows of NULLs, facts with a negative count and facts that point nowhere."""
    out = {}
    for name, c, two, none in (
            ("dim_date", "date_key", "3$", "4$"), ("dim_product", "product_id", "3$", "4$"), ("dim_location", "ip", "3$", "4$"),
            ("dim_customer", "email", "3@", "4@"), ("fact_log_event", "store_id", "3$", "4$")):
        df = tables[name]
        added = [(F.col(c).rlike(two), {}), (F.col(c).rlike(none), {col: F.lit(None) for col in df.columns})]
        if name == "fact_log_event":
            added.append((F.expr("store_id = '5'"), {"event_key": F.concat(F.lit("neg-"), "event_key"), "event_count": F.lit(-1)}))
            added.append((F.expr("store_id = '6'"), {"event_key": F.concat(F.lit("fk-"), "event_key")}
                          | {k: F.lit("nowhere") for k in ("date_key", "product_key", "location_key", "customer_key")}))
        out[name] = _with_changed_copies(df, added)
    return out


def _with_changed_copies(df: DataFrame, added: list) -> DataFrame:
    """The rows and, for each (condition, changes), a copy of those that meet the
    condition, with the changes.  The table, which may be costly, is read once."""
    copy = F.array(F.lit(0), *[F.when(condition, F.lit(i)) for i, (condition, _) in enumerate(added, 1)])
    rows = df.select("*", F.explode(F.array_compact(copy)).alias("_copy"))

    def column(f):
        value = F.col(f.name)
        for i, (_, changes) in enumerate(added, 1):
            if f.name in changes:
                value = F.when(F.col("_copy") == i, changes[f.name].cast(f.dataType)).otherwise(value)
        return value.alias(f.name)
    return rows.select(*[column(f) for f in df.schema.fields])


def _unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events, one row an id, as a table."""
    return unique_clicks(spark, sf_dir)


def two_queries_run(spark: SparkSession, sf_dir: str, a_last: _dt.date) -> DataFrame:
    """Batch 0 of two queries with one run id, each loaded twice: events and days of each status."""
    cleaned = _unique_events(spark, sf_dir)
    wh = Warehouse(spark, f"{scratch_dir(spark, 'two')}/wh")
    parts = {"daily": cleaned.where(F.col("event_date") <= F.lit(a_last)), "backfill": cleaned.where(F.col("event_date") > F.lit(a_last))}
    rows = [(name, wh.load_batch(part, 0, name, "run-1", PROOF_LOAD_TIME)["status"], wh.read("fact_log_event").count())
            for name, part in [*parts.items(), *parts.items()]]
    return spark.createDataFrame(rows, "query_name string, status string, events_after long")


def monitor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(ingest_run(spark, sf_dir)["monitor"])
