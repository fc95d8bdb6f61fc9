"""Plan checks: no Python in the hot path, pruning reaches the scans."""

import os
import tempfile

from viewstar.batch import star_from_tables
from viewstar.plans import reports as R
from viewstar.sources.fixtures import clicks
from viewstar.streaming.warehouse import Warehouse
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    star = star_from_tables(spark, SF_SMALL)
    for df in [R.top_products(star), R.browser_os_hourly(star), R.summary_metrics(star),
               star.fact_log_event]:
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_page_scan_prunes_html(spark):
    plan = _plan(clicks(spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "pages.parquet" in line]
    assert scans and all("html" not in line.split("ReadSchema:")[-1] for line in scans)


def test_report_on_warehouse_prunes_date_partitions(spark):
    from viewstar.batch import cleaned_clicks
    from viewstar.operators.dedup import dedup_stable
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="whp-") + "/wh")
    wh.load_batch(dedup_stable(cleaned_clicks(spark, SF_SMALL), ["id"], ["event_ts"]), 0, "q", "r")
    df = R.top_products(wh.star(), "2024-01-07")
    df.collect()
    plan = _plan(df)
    fact_scans = [l for l in plan.splitlines() if "fact_log_event" in l and "PartitionFilters" in l]
    assert fact_scans and all("date_key" in l.split("PartitionFilters:")[1] for l in fact_scans)


def test_merge_probes_target_keys_with_broadcast_batch_keys(spark):
    from viewstar.operators.merge import new_rows
    target = spark.range(1000).selectExpr("cast(id as string) as k", "'old' as v")
    batch = spark.range(990, 1010).selectExpr("cast(id as string) as k", "'new' as v")
    fresh = new_rows(target, batch, "k", key_bytes=2000)
    plan = _plan(fresh)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "LeftAnti" in plan
    assert sorted(r.k for r in fresh.collect()) == [str(i) for i in range(1000, 1010)]


def test_ingest_plan_stays_in_the_jvm(spark):
    from viewstar.sources.fixtures import messages
    from viewstar.operators.clean import clean, decode
    from viewstar.operators.star import base_frame
    df = base_frame(clean(decode(messages(spark, SF_SMALL))))
    df.collect()  # the final adaptive plan shows the codegen stages
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "*(" in plan
