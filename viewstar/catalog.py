"""Registered proofs: one Spark query per operator of the survey, each with
an independent DuckDB SQL twin (see viewstar.oracle.duck) where SQL can
express it.

Every query reads the driver tables (`events`, `pages`) whole and derives
everything else with Spark.  Timestamps are returned as TIMESTAMP_NTZ so
the comparison with DuckDB's naive timestamps is exact.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import TimestampType

from viewstar.batch import base_from_tables, cleaned_clicks, star_from_tables
from viewstar.functions import (
    country_code, country_name, domain_of, epoch_to_ts, nonblank, nonblank_lower,
    parse_local_time, report_browser, report_os, with_clean_url,
)
from viewstar.functions.keys import first_option
from viewstar.operators.clean import decode
from viewstar.operators.merge import merge_coalesce_update, merge_insert_absent
from viewstar.operators.quality import constraint_audit, evolve
from viewstar.operators.setops import unseen_values
from viewstar.operators.star import dim_customer, dim_product, fact_log_event
from viewstar.plans import reports as R
from viewstar.session import BASE_CONF
from viewstar.sources.fixtures import clicks, messages
from viewstar.streaming import proofs
from viewstar.streaming.ingest import read_ingested
from viewstar.streaming.warehouse import Warehouse

CODE_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Report parameters.
REPORT_COUNTRY = "United Kingdom"
REPORT_PRODUCT = "7"
# Two overlapping load batches for the merge proofs.
BATCH_A_LAST = _dt.date(2024, 1, 20)
BATCH_B_FIRST = _dt.date(2024, 1, 15)


def ntz(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def _flat_option(df: DataFrame) -> DataFrame:
    opt = first_option("option")
    return df.select(*[c for c in df.columns if c != "option"],
                     F.when(F.col("option").isNotNull(), F.size("option")).alias("n_options"),
                     opt.getField("option_id").alias("opt_id"),
                     opt.getField("option_label").alias("opt_label"))


# ------------------------------------------------------------------ Spark
def q_decode_messages(spark, sf):
    return _flat_option(decode(messages(spark, sf)))


def q_normalize_text(spark, sf):
    return clicks(spark, sf).select(
        nonblank("id").alias("id"), nonblank("email").alias("email"),
        nonblank("product_id").alias("product_id"), nonblank("store_id").alias("store_id"),
        nonblank("ip").alias("ip"), nonblank_lower("collection").alias("collection"))


def _page_urls(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return p.select("page_id", "url",
                    F.concat("url", F.lit("/")).alias("u_slash"),
                    F.concat(F.upper(F.substring("url", 1, 8)), F.expr("substring(url, 9)"),
                             F.lit(";p=1")).alias("u_params"),
                    F.concat("url", F.lit("/x y%zz+*~é%26/")).alias("u_escape"))


def q_clean_url(spark, sf):
    df = _page_urls(spark, sf)
    for c in ["url", "u_slash", "u_params", "u_escape"]:
        df = with_clean_url(df, c, f"clean_{c}")
    return df.select("page_id", "clean_url", "clean_u_slash", "clean_u_params", "clean_u_escape")


def q_extract_domain(spark, sf):
    df = with_clean_url(_page_urls(spark, sf), "u_params", "clean")
    return df.select("page_id", domain_of("url").alias("raw_domain"),
                     domain_of("clean").alias("clean_domain"))


def q_parse_local_time(spark, sf):
    c = clicks(spark, sf)
    return ntz(c.select("local_time", parse_local_time(nonblank("local_time")).alias("local_ts")))


def q_epoch_to_ts(spark, sf):
    return ntz(clicks(spark, sf).select("time_stamp", epoch_to_ts("time_stamp").alias("event_ts")))


def q_event_parts(spark, sf):
    return ntz(cleaned_clicks(spark, sf).select("id", "event_ts", "event_date", "event_hour"))


def q_clean_events(spark, sf):
    return ntz(_flat_option(cleaned_clicks(spark, sf)))


def q_country_code(spark, sf):
    c = cleaned_clicks(spark, sf)
    return c.select("current_domain", country_code("current_domain").alias("country_code")).distinct()


def q_country_name(spark, sf):
    c = cleaned_clicks(spark, sf)
    code = country_code("current_domain")
    return c.select(code.alias("country_code"), country_name(code).alias("country")).distinct()


def q_classify_ua(spark, sf):
    c = cleaned_clicks(spark, sf)
    return c.select("user_agent", "browser", report_browser("user_agent").alias("report_browser"),
                    report_os("user_agent").alias("report_os")).distinct()


def q_first_option(spark, sf):
    opt = first_option("option")
    return clicks(spark, sf).select(
        F.when(F.col("option").isNotNull(), F.size("option")).alias("n_options"),
        opt.getField("option_id").alias("opt_id"), opt.getField("option_label").alias("opt_label"))


def q_surrogate_keys(spark, sf):
    return base_from_tables(spark, sf).select("event_key", "date_key", "product_key", "customer_key",
                                              "location_key", "country_code", "country")


def _star(spark, sf):
    return star_from_tables(spark, sf, materialize=True)


def q_dim_date(spark, sf):
    return _star(spark, sf).dim_date


def q_dim_product(spark, sf):
    return _star(spark, sf).dim_product


def q_dim_location(spark, sf):
    return _star(spark, sf).dim_location


def q_dim_customer(spark, sf):
    return _star(spark, sf).dim_customer


def q_fact_log_event(spark, sf):
    return ntz(_star(spark, sf).fact_log_event.drop("ingestion_timestamp"))


def q_star_join(spark, sf):
    s = _star(spark, sf)
    f = s.fact_log_event.select("event_key", "date_key", "product_key", "location_key")
    return (f.join(s.dim_date.select("date_key", "date"), "date_key")
             .join(s.dim_product.select("product_key", "product_id", "option_id"), "product_key", "left")
             .join(s.dim_location.select("location_key", "country"), "location_key", "left")
             .select("event_key", "date", "product_id", "option_id", "country"))


def _report(fn, *args):
    return lambda spark, sf: fn(_star(spark, sf), *args)


def _batches(spark, sf):
    base = base_from_tables(spark, sf)
    a = base.where(F.col("event_date") <= F.lit(BATCH_A_LAST))
    b = base.where(F.col("event_date") >= F.lit(BATCH_B_FIRST))
    return a, b


def q_merge_insert_absent(spark, sf):
    a, b = _batches(spark, sf)
    return merge_insert_absent(dim_product(a), dim_product(b), "product_key")


def q_merge_coalesce_update(spark, sf):
    a, b = _batches(spark, sf)
    old = dim_customer(a).withColumn("email", F.lit(None).cast("string"))
    return merge_coalesce_update(old, dim_customer(b), "customer_key", ["email"])


def q_evolve_schema(spark, sf):
    a, b = _batches(spark, sf)
    old = fact_log_event(a).drop("browser")
    new = fact_log_event(b.where(F.col("event_date") > F.lit(BATCH_A_LAST)))
    return evolve(old, new).select("event_key", "browser")


def q_new_browsers(spark, sf):
    fact = _star(spark, sf).fact_log_event
    seen = fact.where(F.col("store_id").isin("0", "1"))
    return unseen_values(fact, seen, "browser")


def q_new_browsers_by_batch(spark, sf):
    """The seen set grows with each commit: every family under the batch that first had it."""
    seen = proofs.seen_run(spark, sf).seen_browsers()
    return seen.select("browser", F.regexp_extract("load_id", r"([0-9]+)$", 1).cast("int").alias("batch"))


def q_duplicate_events(spark, sf):
    """What a bounded key look-up let in, found by the exact audit."""
    return proofs.redelivered_run(spark, sf, BATCH_A_LAST).duplicate_events()


def q_evolve_warehouse(spark, sf):
    fact = proofs.evolved_run(spark, sf, BATCH_A_LAST, BATCH_B_FIRST).read("fact_log_event")
    return fact.select("event_key", "browser", "event_count")


def q_evolve_customers(spark, sf):
    return proofs.evolved_run(spark, sf, BATCH_A_LAST, BATCH_B_FIRST).read("dim_customer")


def q_constraint_audit_planted(spark, sf):
    """Violations of every rule, planted in the star tables."""
    return constraint_audit(proofs.with_violations(_star(spark, sf).as_dict()))


def q_constraint_audit(spark, sf):
    return constraint_audit(_star(spark, sf).as_dict())


# ------------------------------------------------------------- streaming
def _ingested(spark, path):
    return ntz(_flat_option(read_ingested(spark, path)))


def q_stream_dedup(spark, sf):
    return _ingested(spark, proofs.ingest_run(spark, sf)["cleaned"])


def q_stream_dedup_salted(spark, sf):
    return _ingested(spark, proofs.salted_ingest_run(spark, sf))


def q_stream_file_roundtrip(spark, sf):
    return _ingested(spark, proofs.roundtrip_run(spark, sf))


def q_batch_monitor(spark, sf):
    """Each batch's rows and the ids of its sample, heard from the ingest query itself."""
    ids = F.transform("samples", lambda j: F.get_json_object(j, "$.id"))
    in_order = F.row_number().over(Window.orderBy("batch_id"))  # a row a batch
    return proofs.monitor_table(spark, sf).select(in_order.alias("part"), "rows", F.concat_ws(",", F.array_sort(ids)).alias("sample_ids"))


def q_stream_late_rows(spark, sf):
    return spark.createDataFrame(proofs.late_rows_run(spark, sf), "trigger int, rows_out long, late_dropped long")


def q_stream_timed_trigger(spark, sf):
    """Events by the span of dates delivered, and whether the timed triggers came to several batches."""
    out = read_ingested(spark, proofs.timed_run(spark, sf))
    batch = F.regexp_extract(F.col("_metadata.file_path"), "batch_id=([0-9]+)", 1)
    several = out.select(batch.alias("b")).agg((F.count_distinct("b") > 1).alias("s")).scalar()
    return out.groupBy(proofs.span_of(F.col("event_date")).alias("part")).agg(F.count(F.lit(1)).alias("events")).withColumn("several_batches", several)


def _loaded(spark, sf):
    return Warehouse(spark, proofs.load_run(spark, sf)["root"])


def q_loader_final_state(spark, sf):
    return ntz(_loaded(spark, sf).read("fact_log_event").drop("ingestion_timestamp"))


def q_loader_dim_location(spark, sf):
    return _loaded(spark, sf).read("dim_location")


def q_loader_dim_customer(spark, sf):
    return _loaded(spark, sf).read("dim_customer")


def q_warehouse_top_products(spark, sf):
    return R.top_products(_loaded(spark, sf).star())


def q_warehouse_summary_metrics(spark, sf):
    return R.summary_metrics(_loaded(spark, sf).star())


def q_loader_constraint_audit(spark, sf):
    wh = _loaded(spark, sf)
    return constraint_audit(wh.star().as_dict(), wh.ledger())


def q_warehouse_day_top_countries(spark, sf):
    star, day = _loaded(spark, sf).day_star()
    return R.top_countries(star, day)


def q_warehouse_day_browser_hourly(spark, sf):
    star, day = _loaded(spark, sf).day_star()
    return R.browser_hourly(star, day)


def q_ledger_replay(spark, sf):
    wh = proofs.replay_run(spark, sf, BATCH_A_LAST, BATCH_B_FIRST)
    return wh.read("fact_log_event").groupBy("date_key").agg(F.count(F.lit(1)).alias("events"))


def q_ledger_two_queries(spark, sf):
    """Two queries load batch 0 under one run id: both are kept, a replay of either is not."""
    return proofs.two_queries_run(spark, sf, BATCH_A_LAST)


def q_ledger_statuses(spark, sf):
    wh = proofs.replay_run(spark, sf, BATCH_A_LAST, BATCH_B_FIRST)
    first = wh.read("fact_log_event").where(F.col("date_key") <= F.date_format(F.lit(BATCH_A_LAST), "yyyyMMdd")).count()
    rows = [(i, int(r["batch_id"]), r["status"], wh.visible_after_failure - first) for i, r in enumerate(wh.log)]
    return spark.createDataFrame(rows, "step int, batch_id int, status string, extra_visible_after_failure long")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_messages": q_decode_messages,
    "normalize_text": q_normalize_text,
    "clean_url": q_clean_url,
    "extract_domain": q_extract_domain,
    "parse_local_time": q_parse_local_time,
    "epoch_to_ts": q_epoch_to_ts,
    "event_parts": q_event_parts,
    "clean_events": q_clean_events,
    "country_code": q_country_code,
    "country_name": q_country_name,
    "classify_ua": q_classify_ua,
    "first_option": q_first_option,
    "surrogate_keys": q_surrogate_keys,
    "dim_date": q_dim_date,
    "dim_product": q_dim_product,
    "dim_location": q_dim_location,
    "dim_customer": q_dim_customer,
    "fact_log_event": q_fact_log_event,
    "star_join": q_star_join,
    "top_products": _report(R.top_products),
    "top_countries": _report(R.top_countries),
    "top_referrers": _report(R.top_referrers),
    "store_views_by_country": _report(R.store_views_by_country, REPORT_COUNTRY),
    "product_hourly": _report(R.product_hourly, REPORT_PRODUCT),
    "browser_os_hourly": _report(R.browser_os_hourly),
    "browser_hourly": _report(R.browser_hourly),
    "os_hourly": _report(R.os_hourly),
    "summary_metrics": _report(R.summary_metrics),
    "available_dates": lambda spark, sf: R.available_dates(_star(spark, sf)),
    "country_options": _report(R.country_options),
    "product_options": _report(R.product_options),
    "merge_insert_absent": q_merge_insert_absent,
    "merge_coalesce_update": q_merge_coalesce_update,
    "evolve_schema": q_evolve_schema,
    "new_browsers": q_new_browsers,
    "constraint_audit": q_constraint_audit,
    "constraint_audit_planted": q_constraint_audit_planted,
    "new_browsers_by_batch": q_new_browsers_by_batch,
    "duplicate_events": q_duplicate_events,
    "evolve_warehouse": q_evolve_warehouse,
    "evolve_customers": q_evolve_customers,
    "stream_dedup": q_stream_dedup,
    "stream_dedup_salted": q_stream_dedup_salted,
    "stream_file_roundtrip": q_stream_file_roundtrip,
    "batch_monitor": q_batch_monitor,
    "stream_late_rows": q_stream_late_rows,
    "stream_timed_trigger": q_stream_timed_trigger,
    "loader_final_state": q_loader_final_state,
    "loader_dim_location": q_loader_dim_location,
    "loader_dim_customer": q_loader_dim_customer,
    "warehouse_top_products": q_warehouse_top_products,
    "warehouse_summary_metrics": q_warehouse_summary_metrics,
    "warehouse_day_top_countries": q_warehouse_day_top_countries,
    "warehouse_day_browser_hourly": q_warehouse_day_browser_hourly,
    "loader_constraint_audit": q_loader_constraint_audit,
    "ledger_replay": q_ledger_replay,
    "ledger_two_queries": q_ledger_two_queries,
    "ledger_statuses": q_ledger_statuses,
}


def _utc(fn):
    """Event dates and hours are defined in UTC; pin the session time zone
    before building the plan, and the limit that keeps the cleaning's generated
    code compiled (a session that isn't ours lacks it)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set(CODE_LIMIT, BASE_CONF[CODE_LIMIT])
        return fn(spark, sf_dir.rstrip("/"))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _utc(v) for k, v in _QUERIES.items()}
