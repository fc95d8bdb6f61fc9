"""Constraint audit and additive schema evolution for the star tables.

The warehouse is files, so the database constraints of the specification
(primary keys, NOT NULL, foreign keys, a CHECK and a unique date) become an
audit job: one row per (table, rule) with the number of violations.

Each table is scanned once.  A row yields an entry for each of its keys and for
each NULL or bad value it holds; entries of one rule and key are added up (first
within each task, so a hot foreign key is one entry a task), uses and targets of a
foreign key side by side, and one more aggregation counts each rule's violations.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewstar.schemas import STAR_TABLES

AUDIT_COLUMNS = ["table_name", "rule", "violations"]
FACT = "fact_log_event"
LEDGER_KEY = ["query_name", "run_id", "batch_id"]


def _entry(rule: int, when: Column, key: Column | None = None, use: int = 1, target: int = 0) -> Column:
    key = F.lit(None).cast("string") if key is None else key.cast("string")
    return F.when(when, F.struct(F.lit(rule).alias("rule"), key.alias("key"),
                                 F.lit(use).cast("long").alias("uses"), F.lit(target).cast("long").alias("targets")))


def _key_of(columns: list[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def _table_entries(name: str, df: DataFrame, audited: set[str], numbers: dict[tuple[str, str], int]) -> tuple[list[str], list[Column]]:
    """The table's rules and the entries of one of its rows.  An entry has its
    rule's number: it is as small as its key."""
    rules, out = [], []

    def number(table: str, rule: str) -> int:
        return numbers.setdefault((table, rule), len(numbers))

    spec = STAR_TABLES.get(name)
    unique = [("primary_key", LEDGER_KEY)] if spec is None else [("primary_key", [spec.key])]
    if name == "dim_date":
        unique.append(("unique", ["date"]))
    for kind, columns in unique:
        rules.append(f"{kind}:{','.join(columns)}")
        out.append(_entry(number(name, rules[-1]), reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]), _key_of(columns)))
    if spec is None:
        return rules, out
    for c in [spec.key] + [c for c in spec.not_null if c in df.columns]:
        rules.append(f"not_null:{c}")
        out.append(_entry(number(name, rules[-1]), F.col(c).isNull()))
    if name == FACT:
        rules.append("check:event_count>=0")
        out.append(_entry(number(name, rules[-1]), F.col("event_count") < 0))
    for fk, dim in spec.foreign_keys.items():
        if dim in audited:
            rules.append(f"foreign_key:{fk}")
            out.append(_entry(number(name, rules[-1]), F.col(fk).isNotNull(), F.col(fk)))
    if name != FACT and FACT in audited:
        out.append(_entry(number(FACT, f"foreign_key:{spec.key}"), F.col(spec.key).isNotNull(), F.col(spec.key), 0, 1))
    return rules, out


def constraint_audit(tables: dict[str, DataFrame], ledger: DataFrame | None = None,
                     first_day: _dt.date | str | None = None, last_day: _dt.date | str | None = None) -> DataFrame:
    """(table_name, rule, violations) for every constraint of the star; with
    first_day or last_day only facts of those days (their folders) are audited."""
    tables = dict(tables)
    for day, side in ((first_day, Column.__ge__), (last_day, Column.__le__)):
        if day is not None and FACT in tables:
            tables[FACT] = tables[FACT].where(side(F.col("date_key"), str(day).replace("-", "")))
    if ledger is not None:
        tables["stream_batch_log"] = ledger
    rules, parts, numbers = [], [], {}
    for name, df in tables.items():
        own, entries = _table_entries(name, df, set(tables), numbers)
        rules += [(name, r) for r in own]
        parts.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    spark = next(iter(tables.values())).sparkSession
    by_key = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(F.sum("uses").alias("uses"), F.sum("targets").alias("targets"))

    def is_kind(*kinds: str) -> Column:
        return F.col("rule").isin([n for (_, rule), n in numbers.items() if rule.startswith(kinds)])
    bad = (F.when(is_kind("foreign_key"), F.when(F.col("targets") == 0, F.col("uses")))
           .when(is_kind("primary_key", "unique"), (F.col("uses") > 1).cast("long"))
           .otherwise(F.col("uses")))
    counted = by_key.groupBy("rule").agg(F.sum(bad).alias("violations")).withColumnRenamed("rule", "number")
    every = spark.createDataFrame([(*r, numbers[r]) for r in rules], "table_name string, rule string, number int")
    return every.join(counted, "number", "left").select("table_name", "rule", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame in another layout: columns of `schema` missing from `df` are
    added as typed NULLs, others cast to its types, in its order; columns it
    lacks go.  Existing data is never rewritten."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
    return df.select(*[column(f) for f in schema.fields])


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of an old-layout table and a new-layout batch as one table; the
    columns only the new layout has are NULL for old rows."""
    return old.unionByName(new, allowMissingColumns=True)
