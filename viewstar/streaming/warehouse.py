"""The star-schema warehouse on Parquet, loaded batch by batch, exactly once.

Layout under `root`:

    fact_log_event/date_key=<yyyyMMdd>/load_id=<query>.<run>.<batch>/part-*.parquet
    dim_<x>/load_id=<query>.<run>.<batch>/part-*.parquet   (only if the batch has new rows)
    _seen_browser/load_id=<query>.<run>.<batch>/...  (browser families no earlier batch had)
    _day_views/load_id=<query>.<run>.<batch>/part-*.parquet  (date_key, views) of the batch's new view facts
    _ledger/load_id=<query>.<run>.<batch>/part-*.parquet   (query_name, run_id, batch_id, processed_at, layout)

Each batch writes only rows whose key is new (insert-if-absent, first write
wins), into its own `load_id=...` folders, overwriting those only -- so
replaying a batch after a failure rewrites the same files.  The ledger row is
written last and is the commit point.  A run's batches commit in order, so what
is committed is a range of load ids per run, up to the run's last ledger row:
readers keep only folders in these ranges, so a batch that failed half-way is
invisible, and all tables of a batch become visible together.  The ledger also
names the layout that a load was written in; older layouts are read with their
own columns and types and widened to today's.  For `dim_customer.email` (the one
update column) a batch may also append a row for an existing key whose stored
email is NULL; readers resolve it per key as the non-NULL value when there is
one (COALESCE(new, old); the email is a function of the key, so non-NULL values
of one key agree).

One writer per warehouse (the loader query).  The ledger key is
(query_name, run_id, batch_id) where run_id is the streaming checkpoint's
query id, so a lost checkpoint restarting batch ids at 0 is not mistaken
for already-loaded data.

Scale: the fact is laid out by day first, so a day's report and a batch's key
look-up list and read the folders of their days only, however long the history.
The look-up takes the days of the batch and `key_horizon_days` around them: a
redelivered event has its old event time, so it is found; what a client sends
under an old id with another, distant time is let in and found by
`duplicate_events`, an exact audit to run from time to time.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import math
import re

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampType,
)

from viewstar.operators.dedup import repeated_keys
from viewstar.operators.merge import ROW_BYTES, new_rows, rows_with_keys
from viewstar.operators.quality import align_to
from viewstar.operators.setops import unseen_values
from viewstar.plans.reports import VIEW_COLLECTION, is_report_day
from viewstar.operators.star import Star, base_frame, build_star
from viewstar.schemas import LAYOUT, LAYOUTS, LEDGER, LOAD_ORDER, STAR_TABLES

LEDGER_DIR = "_ledger"
DAYS_DIR = "_day_views"
DAY_VIEWS = StructType([StructField("date_key", StringType(), True),
                        StructField("views", LongType(), True)])
LOAD_COLUMN = "load_id"
FACT = "fact_log_event"
SEEN = StructType([StructField("browser", StringType(), True)])
SEEN_DIR = "_seen_browser"
#: A look-up of more days than this reads the whole key column, cut to those days.
MAX_LOOKUP_DAYS = 400
#: Rows of a dimension's file, about: a batch's few new rows need no file from each task.
FILE_ROWS = 100_000
KEY_HORIZON_DAYS = 1


class Loads(NamedTuple):
    """Committed loads of one run in one layout: a range of load ids."""
    run: str
    layout: int
    first: str
    last: str

_TYPES = {
    "date": DateType(), "year": IntegerType(), "quarter": IntegerType(), "month": IntegerType(),
    "week_of_year": IntegerType(), "day": IntegerType(), "day_of_week": IntegerType(),
    "is_weekend": BooleanType(), "valid_from": DateType(), "valid_to": DateType(),
    "is_current": BooleanType(), "latitude": DoubleType(), "longitude": DoubleType(),
    "event_timestamp": TimestampType(), "show_recommendation": BooleanType(),
    "event_count": IntegerType(), "ingestion_timestamp": TimestampType(),
}


def table_schema(name: str, layout: int = LAYOUT) -> StructType:
    """The table's columns and types in a layout."""
    spec = LAYOUTS[layout].get(name, {"missing": [], "types": {}})
    old = {c: StructType.fromDDL(f"c {t}")["c"].dataType for c, t in spec["types"].items()}
    return StructType([StructField(c, old.get(c) or _TYPES.get(c, StringType()), True)
                       for c in STAR_TABLES[name].columns if c not in spec["missing"]])


def _stored_schema(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(LOAD_COLUMN, StringType(), True)])


def _folder_name(text: str) -> str:
    """The text in characters that need no escape in a path, made unique by a hash."""
    return f"{re.sub('[^A-Za-z0-9]', '_', text)[:40]}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def load_prefix(query_name: str, run_id: str) -> str:
    return f"{_folder_name(query_name)}.{_folder_name(run_id)}"


def load_id(query_name: str, run_id: str, batch_id: int) -> str:
    """Folder key of one loaded batch: query and run, then the zero-padded
    batch id, so ids order by batch within a run."""
    return f"{load_prefix(query_name, run_id)}.{int(batch_id):012d}"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


class Warehouse:
    """The warehouse under `root`.  A reader sees what the ledger holds when it
    asks; the writer (`load_batch`) reads the ledger once and then keeps it."""

    def __init__(self, spark: SparkSession, root: str, layout: int = LAYOUT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout
        self._loads: list[Loads] | None = None

    # ------------------------------------------------------------ paths
    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read_or_empty(self, path: str, schema: StructType, base: str | None = None) -> DataFrame:
        try:
            reader = self.spark.read.schema(schema)
            return (reader.option("basePath", base) if base else reader).parquet(path)
        except AnalysisException as e:  # nothing written yet
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    # ------------------------------------------------------------ reads
    def ledger(self) -> DataFrame:
        return self._read_or_empty(self._path(LEDGER_DIR), _stored_schema(LEDGER))

    def is_committed(self, query_name: str, run_id: str, batch_id: int) -> bool:
        hit = self.ledger().where((F.col("query_name") == query_name) & (F.col("run_id") == run_id)
                                  & (F.col("batch_id") == int(batch_id)))
        return not hit.isEmpty()

    def committed_loads(self) -> list[Loads]:
        """Snapshot of what is committed: the range of load ids of each run and
        layout.  A row for each checkpoint that ever loaded."""
        prefix = F.regexp_replace(LOAD_COLUMN, r"\.[0-9]+$", "")
        runs = self.ledger().groupBy(prefix.alias("run"), F.coalesce("layout", F.lit(LAYOUT)).alias("layout"))
        found = runs.agg(F.min(LOAD_COLUMN).alias("first"), F.max(LOAD_COLUMN).alias("last")).collect()
        return sorted(Loads(r["run"], r["layout"], r["first"], r["last"]) for r in found)

    def _committed(self, stored: DataFrame, loads: list[Loads]) -> DataFrame:
        """Rows of committed loads only.  Each run is a literal range of load
        ids, so Spark prunes the uncommitted and newer folders at file listing
        (static partition pruning) and every table of one Star reads the same
        snapshot even while the loader commits new batches."""
        known = F.lit(False)
        for r in loads:
            known = known | F.col(LOAD_COLUMN).between(r.first, r.last)
        return stored.where(known)

    def _committed_rows(self, table: str, loads: list[Loads] | None = None,
                        schema: StructType | None = None, days: list[str] | None = None) -> DataFrame:
        """Committed rows of a table with their load id; with `days` only the
        folders of those days are listed (tables laid out by day)."""
        loads = self.committed_loads() if loads is None else loads
        root = self._path(table)
        if days is not None and not days:
            return self._committed_rows(table, loads, schema).limit(0)
        path = root if days is None else f"{root}/date_key={{{','.join(sorted(days))}}}"
        base = root if days is not None else None
        if schema is not None:
            return self._committed(self._read_or_empty(path, _stored_schema(schema), base), loads)
        now, out = _stored_schema(table_schema(table)), None
        for layout in sorted({r.layout for r in loads}) or [LAYOUT]:
            stored = self._read_or_empty(path, _stored_schema(table_schema(table, layout)), base)
            rows = align_to(self._committed(stored, [r for r in loads if r.layout == layout]), now)
            out = rows if out is None else out.unionByName(rows)
        return out

    def _resolved(self, table: str, rows: DataFrame) -> DataFrame:
        spec = STAR_TABLES[table]
        if not spec.update_columns:
            return rows.select(*spec.columns)
        others = [c for c in spec.columns if c != spec.key and c not in spec.update_columns]
        aggs = [F.max(F.struct(F.col(c).isNotNull(), F.col(LOAD_COLUMN), F.col(c))).getField(c).alias(c)
                for c in spec.update_columns]
        aggs += [F.min(F.struct(F.col(LOAD_COLUMN), F.col(c))).getField(c).alias(c) for c in others]
        return rows.groupBy(spec.key).agg(*aggs).select(*spec.columns)

    def read(self, table: str, loads: list[Loads] | None = None) -> DataFrame:
        return self._resolved(table, self._committed_rows(table, loads))

    def day_views(self, loads: list[Loads] | None = None) -> DataFrame:
        """(date_key, views) of committed view facts, from the per-batch
        summaries (a few rows per batch) instead of the fact table."""
        rows = self._committed_rows(DAYS_DIR, loads, DAY_VIEWS)
        return rows.groupBy("date_key").agg(F.sum("views").alias("views"))

    def seen_browsers(self, loads: list[Loads] | None = None) -> DataFrame:
        """(browser, load_id): every browser family and the load that first had it."""
        return self._committed_rows(SEEN_DIR, loads, SEEN)

    def star(self) -> Star:
        """The five tables (and the day summary) at one committed snapshot."""
        loads = self.committed_loads()
        return Star(*[self.read(t, loads) for t in LOAD_ORDER], day_views=self.day_views(loads))

    def day_star(self, report_date=None) -> tuple[Star, _dt.date | None]:
        """A Star whose fact holds one day only, for the daily reports: the
        fact's folder of that day is the only one listed and read.
        `report_date=None` picks the newest day with views (one scalar from the
        summaries).  Returns the Star and the resolved date."""
        loads = self.committed_loads()
        if report_date is None:
            days = self._committed_rows(DAYS_DIR, loads, DAY_VIEWS).where((F.col("views") > 0) & is_report_day("date_key"))
            newest = days.agg(F.max("date_key")).first()[0]
            if newest is None:
                return self.star(), None
            report_date = _dt.datetime.strptime(newest, "%Y%m%d").date()
        elif isinstance(report_date, str):
            report_date = _dt.date.fromisoformat(report_date)
        fact = self._committed_rows(FACT, loads, days=[report_date.strftime("%Y%m%d")])
        dims = [self.read(t, loads) for t in LOAD_ORDER[:-1]]
        star = Star(*dims, fact.select(*STAR_TABLES[FACT].columns), day_views=self.day_views(loads))
        return star, report_date

    def duplicate_events(self) -> DataFrame:
        """Exact audit of the fact's key over the whole history: (event_key,
        copies, first_day, last_day) of keys that a bounded look-up let in twice."""
        rows = self._committed_rows(FACT).groupBy("event_key").agg(
            F.count(F.lit(1)).alias("copies"), F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"))
        return rows.where(F.col("copies") > 1)

    # ------------------------------------------------------------ writes
    def _write(self, df: DataFrame, table: str, lid: str):
        # Static overwrite: the whole folder of this load is replaced, so a
        # replay never leaves files of an earlier attempt behind.
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self._path(table)}/{LOAD_COLUMN}={lid}")

    def _write_facts(self, df: DataFrame, lid: str):
        # Only the folders date_key=.../load_id=<this load> are replaced.  A
        # replayed batch meets the same committed rows, so it writes the same days.
        # A day's rows come together first: a file for each task and day would
        # be many small ones.
        (df.hint("rebalance", "date_key").withColumn(LOAD_COLUMN, F.lit(lid)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("date_key", LOAD_COLUMN).parquet(self._path(FACT)))

    def _commit(self, query_name: str, run_id: str, batch_id: int, lid: str) -> None:
        row = self.spark.createDataFrame([(query_name, run_id, int(batch_id), _now(), self.layout)], LEDGER)
        self._write(row.coalesce(1), LEDGER_DIR, lid)

    def facts_near(self, days: DataFrame, horizon_days: int, loads: list[Loads]) -> DataFrame:
        """Committed facts of the days (date_key) and of `horizon_days` before and after each."""
        day = F.to_date(F.when(is_report_day("date_key") & F.col("date_key").between("00020101", "99981231"), F.col("date_key")), "yyyyMMdd")
        around = F.transform(F.sequence(F.date_sub(day, horizon_days), F.date_add(day, horizon_days)), lambda d: F.date_format(d, "yyyyMMdd"))
        # a day beyond the calendar stands for itself
        near = days.select(F.explode(F.coalesce(around, F.array("date_key"))).alias("date_key")).distinct()
        found = [r[0] for r in near.limit(MAX_LOOKUP_DAYS + 1).collect()]
        if len(found) <= MAX_LOOKUP_DAYS:
            return self._committed_rows(FACT, loads, days=found)
        return self._committed_rows(FACT, loads).join(near, "date_key", "left_semi")

    def load_batch(self, cleaned: DataFrame, batch_id: int, query_name: str, run_id: str,
                   ingestion_timestamp=None, key_horizon_days: int | None = KEY_HORIZON_DAYS) -> dict:
        """Load one micro-batch of cleaned events; a no-op when the batch is
        empty or already in the ledger.  `cleaned` is read several times, a few
        columns at a time: files or a table, as the loader query gives it.

        `key_horizon_days` bounds where an event_key is looked up before insert:
        the days of the batch and so many around them.  None looks it up in the
        whole history (reads the committed key column)."""
        lid = load_id(query_name, run_id, batch_id)
        prefix = load_prefix(query_name, run_id)
        if self._loads is None:
            self._loads = self.committed_loads()
        loads = self._loads
        mine = [r for r in loads if r.run == prefix]
        if mine and lid <= max(r.last for r in mine):
            if self.is_committed(query_name, run_id, batch_id):
                return {"batch_id": batch_id, "status": "already-loaded"}
            # Its folders would count as committed before they are complete.
            raise ValueError(f"batch {batch_id} comes after {max(r.last for r in mine)}: the batches of a run are loaded in order")
        if mine and self.layout < max(r.layout for r in mine):
            raise ValueError(f"run {run_id} has loads of a newer layout than {self.layout}")
        # `loads` is the committed snapshot; it never includes this load's
        # folders, which are about to be overwritten (pruned, not even listed).
        repeated = repeated_keys(cleaned, "id")
        # Without repeated ids the base is a projection of `cleaned`, and every
        # table reads the few columns that it uses; a wide copy in memory costs
        # more.  Else it is kept, so that repeated rows are compared once.
        base = base_frame(cleaned, repeated)
        if repeated.rows:
            base = base.persist()
        try:
            # The base's rows bound the keys of every table built from it, so
            # no per-table counting jobs.
            input_rows, id_bytes = base.agg(F.count(F.lit(1)), F.sum(F.octet_length("event_key"))).first()
            if input_rows == 0:  # empty micro-batch: nothing to write or commit
                return {"batch_id": batch_id, "status": "empty"}
            star = build_star(base, ingestion_timestamp or _now())
            for name in LOAD_ORDER[:-1]:
                spec = STAR_TABLES[name]
                # grouped from the batch once, for all the joins below
                batch_rows = getattr(star, name).persist()
                try:
                    committed = self._committed_rows(name, loads)
                    key_bytes = input_rows * (64 + ROW_BYTES)  # a SHA-256 in hex at most
                    fresh = new_rows(committed, batch_rows, spec.key, key_bytes=key_bytes)
                    layout = table_schema(name, self.layout)
                    if set(spec.update_columns) & set(layout.names):
                        fresh = fresh.unionByName(self._filled_updates(committed, batch_rows, spec, key_bytes))
                    self._write_some(align_to(fresh, layout), name, lid)
                finally:
                    batch_rows.unpersist()
            if key_horizon_days is None:
                committed = self._committed_rows(FACT, loads)
            else:
                days = base.where(F.col("date_key").isNotNull()).select("date_key").distinct()
                committed = self.facts_near(days, key_horizon_days, loads)
            fresh = new_rows(committed, star.fact_log_event, "event_key", key_bytes=id_bytes + input_rows * ROW_BYTES)
            # The wide rows go to their files and nowhere else; what is asked of
            # them besides comes from a pass over four columns of `base`.
            few = (fresh.groupBy("date_key", "browser").agg(F.count_if(F.col("collection") == VIEW_COLLECTION).alias("views"))).persist()
            try:
                days = few.where("views > 0").groupBy("date_key").agg(F.sum("views").alias("views"))
                self._write(days.coalesce(1), DAYS_DIR, lid)
                self._write_some(unseen_values(few, self.seen_browsers(loads), "browser"), SEEN_DIR, lid)
            finally:
                few.unpersist()
            self._write_facts(align_to(fresh, table_schema(FACT, self.layout)), lid)
            # Commit point: written last.
            self._commit(query_name, run_id, batch_id, lid)
            same = next((r for r in mine if r.layout == self.layout), None)
            self._loads = [r for r in loads if r is not same] + [Loads(prefix, self.layout, same.first if same else lid, lid)]
        finally:
            if repeated.rows:
                base.unpersist()
            repeated.keys.unpersist()
        return {"batch_id": batch_id, "status": "committed", "input_rows": input_rows}

    def _write_some(self, rows: DataFrame, table: str, lid: str) -> None:
        """Most batches bring few new rows or none: computed once, and no folder for none."""
        rows = rows.persist()
        try:
            n = rows.count()
            if n:
                self._write(rows.coalesce(math.ceil(n / FILE_ROWS)), table, lid)
        finally:
            rows.unpersist()

    @staticmethod
    def _filled_updates(committed: DataFrame, batch_rows: DataFrame, spec, key_bytes: int) -> DataFrame:
        """Rows for existing keys whose stored update column is NULL and the
        batch brings a value (COALESCE(new, old) changes the row).  The stored
        rows are cut to the batch's keys before they are grouped."""
        cols = spec.update_columns
        stored_null = (rows_with_keys(committed, batch_rows.select(spec.key), spec.key, key_bytes).groupBy(spec.key)
                       .agg(*[F.max(F.col(c).isNotNull()).alias(f"_has_{c}") for c in cols]))
        cond = None
        for c in cols:
            t = (~F.col(f"_has_{c}")) & F.col(c).isNotNull()
            cond = t if cond is None else cond | t
        return (batch_rows.join(stored_null, spec.key, "inner").where(cond)
                .select(*batch_rows.columns))
