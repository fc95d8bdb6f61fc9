"""Adapter from the driver's test tables to raw click events.

`events` supplies one click per row; `pages` supplies the visited and the
referring URL (`page_id = event_id % n` and `(event_id*7+3) % n`).  Every
field is a deterministic function of the inputs, chosen to exercise the
cleaning rules (blanks, bad local times, epoch seconds vs milliseconds,
option edge cases, duplicates).

Scale notes: `pages` is reduced to (page_id, url) before the join; it is
broadcast only after its row count and URL bytes were measured below a
bound, otherwise the join shuffles on the page id.  Duplicates (every
event with event_id % 10 = 0 appears twice) are produced with a generator
after the joins, so the inputs are scanned and joined once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.schemas import RAW_COLUMNS, OPTION

# Largest page table (bytes of url text) that is broadcast to the join.
BROADCAST_BYTES = 64 * 1024 * 1024
# Most events that a task of the adapter takes.
TASK_ROWS = 100_000

# The eight user agents of the fixture, chosen by user_id % 9
# (remainder 8 -> NULL).  Chrome/Windows, Firefox/Ubuntu, Safari/macOS,
# Mobile Safari/iOS, Chrome Mobile/Android, Edge/Windows,
# Samsung Internet/Android, and an unknown client.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/124.0.0.0 Safari/537.36",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:125.0) Gecko/20100101 Firefox/125.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/17.4 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_4 like Mac OS X) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/17.4 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/124.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/124.0.0.0 Safari/537.36 Edg/124.0.2478.80",
    "Mozilla/5.0 (Linux; Android 14; SM-S918B) AppleWebKit/537.36 (KHTML, like Gecko) "
    "SamsungBrowser/24.0 Chrome/117.0.0.0 Mobile Safari/537.36",
    "curl/8.0",
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster has
    cores or than its rows ask for: events are narrow here and become wide and
    costly when cleaned, so that a file split of the usual size is far too much
    for a task.  A scan with enough partitions is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df.select().agg(F.count(F.lit(1))).first()[0]
    tasks = cores * max(1, math.ceil(rows / task_rows / cores))  # whole rounds of the cores
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def _page_urls(spark: SparkSession, sf_dir: str):
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    n, url_bytes = pages.agg(F.count(F.lit(1)), F.sum(F.length("url"))).first()
    small = (url_bytes or 0) + 16 * n <= BROADCAST_BYTES
    return pages, int(n), small


def _opt(option_id: Column, label: str) -> Column:
    return F.struct(option_id.alias("option_id"), F.lit(label).alias("option_label"))


def _clicks_with_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, n, small = _page_urls(spark, sf_dir)
    if n == 0:
        raise ValueError("pages table is empty")
    cur = pages.select(F.col("page_id").alias("cur_page"), F.col("url").alias("cur_url"))
    ref = pages.select(F.col("page_id").alias("ref_page"), F.col("url").alias("ref_url"))
    if small:
        cur, ref = F.broadcast(cur), F.broadcast(ref)

    e = spread(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"))
    e = (e
         .withColumn("cur_page", F.col("event_id") % n)
         .withColumn("ref_page", (F.col("event_id") * 7 + 3) % n))
    j = e.join(cur, "cur_page").join(ref, "ref_page")

    eid, uid = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").try_cast("int")
    lang = F.regexp_extract("cur_url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)", 1)
    tld = (F.when(lang.isin("fr", "de", "es"), lang)
            .when(F.col("cur_page") % 3 == 0, F.lit("uk"))
            .when(F.col("cur_page") % 3 == 1, F.lit("com"))
            .otherwise(F.lit("eu")))
    option = (F.when(k % 4 == 0,
                     F.when(eid % 2 == 0, F.array().cast(OPTION))
                      .otherwise(F.array(_opt(F.lit(""), ""))))
               .when(k % 4 == 2, F.array(_opt((k % 3).cast("string"), "diamond")))
               .when(k % 4 == 3, F.array(_opt(F.lit(""), "x"), _opt(F.lit("2"), "gold")))
               .cast(OPTION))
    uid_s = uid.cast("string")
    cols = {
        "id": F.when(eid % 97 == 0, F.lit("  ")).otherwise(F.concat(F.lit("ev-"), eid.cast("string"))),
        "time_stamp": F.when(eid % 2 == 0, F.unix_seconds(ts)).otherwise(F.unix_millis(ts)),
        "ip": F.when(uid % 7 != 0, F.concat(F.lit("10.0."), (uid % 4).cast("string"), F.lit("."), uid_s)),
        "user_agent": F.get(F.array(*[F.lit(u) for u in USER_AGENTS]), (uid % 9).cast("int")),
        "resolution": F.lit("1920x1080"),
        "device_id": F.concat(F.lit("dev-"), uid_s),
        "api_version": F.lit("1.0"),
        "store_id": F.when(eid % 13 == 0, F.lit("")).otherwise((uid % 9).cast("string")),
        "local_time": F.when(eid % 89 == 0, F.lit("bad-time"))
                       .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        "show_recommendation": eid % 2 == 0,
        "current_url": F.regexp_replace("cur_url", r"\.example\.(com|net|org)/",
                                        F.concat(F.lit(".example."), tld, F.lit("/"))),
        "referrer_url": F.when(eid % 5 == 0, F.lit(None).cast("string"))
                         .when(eid % 5 == 1, F.lit(""))
                         .otherwise(F.concat("ref_url", F.lit("/"))),
        "email": F.when(uid % 4 == 0, F.lit(None).cast("string"))
                  .when(uid % 4 == 1, F.concat(F.lit(" User"), uid_s, F.lit("@Example.com ")))
                  .otherwise(F.concat(F.lit("user"), uid_s, F.lit("@example.com"))),
        "collection": F.when(F.col("event_type") == "view", F.lit(" View_Product_Detail "))
                       .otherwise(F.col("event_type")),
        "product_id": F.when(eid % 11 == 0, F.lit(" ")).otherwise((k % 25).cast("string")),
        "option": option,
    }
    rows = j.select(eid.alias("event_id"), *[v.alias(name) for name, v in cols.items()])
    # Every tenth event is delivered twice (identical copies).
    copies = F.explode(F.when(eid % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("*", copies.alias("_copy")).drop("_copy")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw click events (the 16-field raw event schema) from the driver tables."""
    return _clicks_with_event_id(spark, sf_dir).select(*RAW_COLUMNS)


def messages(spark: SparkSession, sf_dir: str, date_part: Column | None = None) -> DataFrame:
    """Message values as a broker would deliver them: one `value BINARY`
    column with each click as JSON, a malformed `{bad` after every event with
    event_id % 101 = 0, and one each of `[]`, empty text and NULL.  With
    `date_part`, an expression over the event's date `d`, its value is a column
    `part` beside them (0 for the odd ones)."""
    c = _clicks_with_event_id(spark, sf_dir)
    as_json = F.to_json(F.struct(*RAW_COLUMNS))
    values = F.when(F.col("event_id") % 101 == 0, F.array(as_json, F.lit("{bad"))).otherwise(F.array(as_json))
    d = F.when(F.col("time_stamp") > 10 ** 12, F.timestamp_millis("time_stamp")).otherwise(F.timestamp_seconds("time_stamp")).cast("date")
    part = [] if date_part is None else [F.col("part")]
    body = c.withColumn("d", d).withColumn("part", F.lit(0) if date_part is None else date_part.cast("int")).select(F.explode(values).alias("value"), *part)
    odd = spark.createDataFrame([("[]",), ("",), (None,)], "value string").withColumn("part", F.lit(0)).select("value", *part)
    return body.unionByName(odd).select(F.col("value").cast("binary").alias("value"), *part)
