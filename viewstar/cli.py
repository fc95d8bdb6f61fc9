"""Command line: run the ingest query, the loader query, or print a report.

    python -m viewstar.cli ingest --kafka kafka.bootstrap.servers=host:9092 --kafka subscribe=clicks \
        --out <shared>/cleaned --checkpoint <shared>/ckpt_ingest [--monitor]
    python -m viewstar.cli ingest --messages <folder of value-BINARY Parquet> ...
    python -m viewstar.cli load --source <shared>/cleaned --warehouse <shared>/wh \
        --checkpoint <shared>/ckpt_loader [--max-files 10] [--trigger "30 seconds"]
    python -m viewstar.cli report top_products --warehouse <shared>/wh [--date 2024-05-28]
    python -m viewstar.cli audit --warehouse <shared>/wh [--first 2024-05-01] [--last 2024-05-31]
    python -m viewstar.cli report store_views_by_country --warehouse <shared>/wh --country Chile

Streaming commands block until the queries stop (or one fails).
"""

from __future__ import annotations

import argparse

from viewstar.plans import reports as R

REPORTS = {
    "available_dates": lambda star, a: R.available_dates(star),
    "summary_metrics": lambda star, a: R.summary_metrics(star, a.date),
    "top_products": lambda star, a: R.top_products(star, a.date),
    "top_countries": lambda star, a: R.top_countries(star, a.date),
    "top_referrers": lambda star, a: R.top_referrers(star, a.date),
    "country_options": lambda star, a: R.country_options(star, a.date),
    "product_options": lambda star, a: R.product_options(star, a.date),
    "store_views_by_country": lambda star, a: R.store_views_by_country(star, a.country, a.date),
    "product_hourly": lambda star, a: R.product_hourly(star, a.product, a.date),
    "browser_os_hourly": lambda star, a: R.browser_os_hourly(star, a.date),
    "browser_hourly": lambda star, a: R.browser_hourly(star, a.date),
    "os_hourly": lambda star, a: R.os_hourly(star, a.date),
}


def _kv(items) -> dict[str, str]:
    """key=value pairs, passed to the Kafka source as given
    (e.g. kafka.bootstrap.servers=host:9092, subscribe=clicks)."""
    return dict(item.split("=", 1) for item in items or [])


def _first(df, column: str):
    row = df.first()
    return row[column] if row else None


def _print_rows(report) -> None:
    """All rows as tab-separated lines, fetched a partition at a time."""
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv=None):
    p = argparse.ArgumentParser(prog="viewstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--kafka", action="append", help="Kafka source option key=value")
    i.add_argument("--messages", help="folder of Parquet files with a value BINARY column")
    i.add_argument("--out", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--trigger", default="30 seconds")
    i.add_argument("--monitor", action="store_true", help="also print per-batch samples")
    i.add_argument("--sample-rows", type=int, default=5)
    i.add_argument("--output-files", type=int, default=None, help="files that a batch writes (default: by its bytes)")
    i.add_argument("--no-salt", dest="salt", action="store_false",
                   help="dedup without salt: half the state, but a hot id is one task")
    ld = sub.add_parser("load")
    ld.add_argument("--source", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--checkpoint", required=True)
    ld.add_argument("--query-name", default="star_loader")
    ld.add_argument("--max-files", type=int, default=10)
    ld.add_argument("--trigger", default="30 seconds")
    ld.add_argument("--key-horizon-days", type=int, default=1,
                    help="look an event's key up in the days of its batch and so many around them; -1: in all history")
    au = sub.add_parser("audit")
    au.add_argument("--warehouse", required=True)
    au.add_argument("--first", default=None, help="first day of facts to audit, yyyy-MM-dd")
    au.add_argument("--last", default=None, help="last day of facts to audit, yyyy-MM-dd")
    r = sub.add_parser("report")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--warehouse", required=True)
    r.add_argument("--date", default=None, help="yyyy-MM-dd; default: newest day with views")
    r.add_argument("--country", default=None, help="default: the day's country with most views")
    r.add_argument("--product", default=None, help="default: the day's product with most views")
    r.add_argument("--out", default=None, help="folder for all rows; without it the rows are printed")
    r.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    r.add_argument("--rows", type=int, default=None, help="print so many rows at most (default: all)")
    a = p.parse_args(argv)

    from viewstar.session import get_session
    spark = get_session()
    if a.cmd == "ingest":
        from viewstar.sources.streams import file_messages, kafka_messages
        from viewstar.streaming.ingest import BatchMonitor, file_position, ingest_plan, kafka_position, start_ingest
        src = kafka_messages(spark, _kv(a.kafka)) if a.kafka else file_messages(spark, a.messages)
        pos = (kafka_position() if a.kafka else file_position()) if a.salt else None
        if a.monitor:
            spark.streams.addListener(BatchMonitor(spark))
        start_ingest(ingest_plan(src, pos), a.out, a.checkpoint, trigger=a.trigger, query_name="ingest",
                     output_files=a.output_files, sample_rows=a.sample_rows if a.monitor else 0)
        spark.streams.awaitAnyTermination()
    elif a.cmd == "load":
        from viewstar.streaming.loader import start_loader
        q, _ = start_loader(spark, a.source, a.warehouse, a.checkpoint, a.query_name, a.trigger,
                            a.max_files, key_horizon_days=None if a.key_horizon_days < 0 else a.key_horizon_days)
        q.awaitTermination()
    elif a.cmd == "audit":
        from viewstar.operators.quality import constraint_audit
        from viewstar.streaming.warehouse import Warehouse
        wh = Warehouse(spark, a.warehouse)
        _print_rows(constraint_audit(wh.star().as_dict(), wh.ledger(), a.first, a.last))
        _print_rows(wh.duplicate_events())
    else:
        from viewstar.streaming.warehouse import Warehouse
        wh = Warehouse(spark, a.warehouse)
        if a.name == "available_dates":
            star = wh.star()
        else:
            star, a.date = wh.day_star(a.date)  # list only the day's folders
        if a.name == "store_views_by_country" and a.country is None:
            a.country = _first(R.top_countries(star, a.date, limit=1), "country") or "Unknown"
        if a.name == "product_hourly" and a.product is None:
            a.product = _first(R.top_products(star, a.date, limit=1), "product_id")
            if a.product is None:
                raise SystemExit("no product was viewed on that day")
        report = REPORTS[a.name](star, a)
        if a.out:
            report.write.mode("errorifexists").option("header", "true").format(a.format).save(a.out)
        else:
            _print_rows(report.limit(a.rows) if a.rows else report)


if __name__ == "__main__":
    main()
