"""The daily view reports, as lazy DataFrames over the star tables.

Common base: fact rows with collection = 'view_product_detail' on the
report day, kept only when their date_key exists in dim_date for that day
(the inner join of the specification, as a semi-join against at most one
dim_date row).  The day filter is also stated on fact.date_key itself so a
warehouse partitioned by date_key reads one partition.

Plan shape: every report first aggregates the day's facts by the foreign
key it needs (partial aggregation, so a hot key is combined before the
shuffle), and only then joins the dimension -- the join sees one row per
distinct key instead of one per event.  Left joins to a dimension with a
unique key never change fact multiplicity, so reports that need no
dimension column skip the join.

`report_date=None` means the newest day with views.  It is resolved
lazily as a scalar subquery, so building a report runs no job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.functions import report_browser, report_os, unknown_bucket
from viewstar.operators.star import Star

VIEW_COLLECTION = "view_product_detail"
HOURS = 24


def _date_value(star: Star, report_date) -> Column:
    if report_date is None:
        return newest_date(star)
    if isinstance(report_date, str):
        report_date = _dt.date.fromisoformat(report_date)
    return F.lit(report_date)


def _views(star: Star) -> DataFrame:
    return star.fact_log_event.where(F.col("collection") == VIEW_COLLECTION)


def day_views(star: Star, report_date=None) -> DataFrame:
    """The day's view facts (base of every report)."""
    d = _date_value(star, report_date)
    day = star.dim_date.where(F.col("date") == d).select("date_key")
    facts = _views(star).where(F.col("date_key") == F.date_format(d, "yyyyMMdd"))
    # dim_date has one row per date (unique), so this side is at most one row.
    return facts.join(F.broadcast(day), "date_key", "left_semi")


def is_report_day(date_key) -> Column:
    """Days with a four-digit year, the only ones that reports offer or take as
    newest; their keys order as their dates.  Events beyond (a client's clock or
    unit is wrong) stay in the fact."""
    return F.col(date_key).rlike("^[0-9]{8}$")


def _view_days(star: Star) -> DataFrame:
    """date_key of every day with at least one view: from the loader's small
    day summary when the star has one, else from the fact itself."""
    keys = (star.day_views.where(F.col("views") > 0) if star.day_views is not None else _views(star)).select("date_key")
    return keys.where(is_report_day("date_key")).distinct()


def available_dates(star: Star) -> DataFrame:
    """R8: days with views, newest first."""
    keys = _view_days(star)
    return (keys.join(star.dim_date.select("date_key", "date"), "date_key")
                .select("date").distinct().orderBy(F.col("date").desc()))


def newest_date(star: Star) -> Column:
    keys = _view_days(star)
    dates = keys.join(star.dim_date.select("date_key", "date"), "date_key")
    return dates.agg(F.max("date")).scalar()


def _ranked(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    out = df.orderBy(F.col("views").desc(), F.col(key).asc())
    return out.limit(limit) if limit else out


def _product_views(star: Star, report_date) -> DataFrame:
    by_key = (day_views(star, report_date).where(F.col("product_key").isNotNull())
              .groupBy("product_key").agg(F.sum("event_count").alias("views")))
    named = by_key.join(star.dim_product.select("product_key", "product_id"), "product_key", "left")
    return (named.where(F.col("product_id").isNotNull())
                 .groupBy("product_id").agg(F.sum("views").alias("views")))


def top_products(star: Star, report_date=None, limit: int = 10) -> DataFrame:
    """R1: product_id, views -- top 10 by views, ties by product_id."""
    return _ranked(_product_views(star, report_date), "product_id", limit)


def product_options(star: Star, report_date=None) -> DataFrame:
    """R10: all products of the day ranked."""
    return _ranked(_product_views(star, report_date), "product_id", None)


def _country_of(by_location: DataFrame, star: Star) -> DataFrame:
    named = by_location.join(star.dim_location.select("location_key", "country"), "location_key", "left")
    return named.withColumn("country", unknown_bucket("country"))


def _country_views(star: Star, report_date) -> DataFrame:
    by_key = (day_views(star, report_date)
              .groupBy("location_key").agg(F.sum("event_count").alias("views")))
    return (_country_of(by_key, star)
            .groupBy("country").agg(F.sum("views").alias("views")))


def top_countries(star: Star, report_date=None, limit: int = 10) -> DataFrame:
    """R2: country, views -- NULL/empty country is 'Unknown'."""
    return _ranked(_country_views(star, report_date), "country", limit)


def country_options(star: Star, report_date=None) -> DataFrame:
    """R9: all countries of the day ranked."""
    return _ranked(_country_views(star, report_date), "country", None)


def top_referrers(star: Star, report_date=None, limit: int = 5) -> DataFrame:
    """R3: referrer_url, views -- top 5 non-empty referrers."""
    ref = F.nullif(F.col("referrer_url"), F.lit(""))
    agg = (day_views(star, report_date).where(ref.isNotNull())
           .groupBy("referrer_url").agg(F.sum("event_count").alias("views")))
    return _ranked(agg, "referrer_url", limit)


def store_views_by_country(star: Star, country: str, report_date=None) -> DataFrame:
    """R4: store_id, views for one country (after the Unknown bucket)."""
    by_key = (day_views(star, report_date)
              .groupBy("location_key", unknown_bucket("store_id").alias("store_id"))
              .agg(F.sum("event_count").alias("views")))
    named = _country_of(by_key, star).where(F.col("country") == country)
    agg = named.groupBy("store_id").agg(F.sum("views").alias("views"))
    return _ranked(agg, "store_id", None)


def _hours(spark: SparkSession) -> DataFrame:
    return spark.range(HOURS).select(F.col("id").cast("int").alias("event_hour"))


def product_hourly(star: Star, product_id: str, report_date=None) -> DataFrame:
    """R5: event_hour 0..23, views for one product; hours without views are 0."""
    keys = star.dim_product.where(F.col("product_id") == product_id).select("product_key")
    by_key = (day_views(star, report_date).where(F.col("product_key").isNotNull())
              .groupBy("product_key", F.hour("event_timestamp").alias("event_hour"))
              .agg(F.sum("event_count").alias("views")))
    agg = (by_key.join(keys, "product_key", "left_semi")
           .groupBy("event_hour").agg(F.sum("views").alias("views")))
    spark = star.fact_log_event.sparkSession
    return (_hours(spark).join(agg, "event_hour", "left")
            .select("event_hour", F.coalesce("views", F.lit(0)).cast("bigint").alias("views"))
            .orderBy("event_hour"))


def browser_os_hourly(star: Star, report_date=None) -> DataFrame:
    """R6: event_hour, browser, os, views.  Facts are first reduced to
    (hour, user agent) groups; only those few groups are classified."""
    by_ua = (day_views(star, report_date)
             .groupBy(F.hour("event_timestamp").alias("event_hour"),
                      F.coalesce("user_agent", F.lit("")).alias("user_agent"))
             .agg(F.sum("event_count").alias("views")))
    classified = by_ua.select("event_hour", report_browser("user_agent").alias("browser"),
                              report_os("user_agent").alias("os"), "views")
    return (classified.groupBy("event_hour", "browser", "os").agg(F.sum("views").alias("views"))
            .orderBy("event_hour", F.col("views").desc(), "browser", "os"))


def _zero_fill_hours(df: DataFrame, category: str) -> DataFrame:
    """Every (hour, category) pair for the categories present; missing pairs
    are 0.  Hours are generated per category (no cross join); no rows in,
    no rows out."""
    grid = (df.select(category).distinct()
            .select(F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))).alias("event_hour"), category))
    return (grid.join(df, ["event_hour", category], "left")
            .select("event_hour", category, F.coalesce("views", F.lit(0)).cast("bigint").alias("views"))
            .orderBy("event_hour", category))


def browser_hourly(star: Star, report_date=None) -> DataFrame:
    """R6a: R6 rolled up to browser, zero-filled over 24 hours."""
    r6 = browser_os_hourly(star, report_date)
    agg = r6.groupBy("event_hour", "browser").agg(F.sum("views").alias("views"))
    return _zero_fill_hours(agg, "browser")


def os_hourly(star: Star, report_date=None) -> DataFrame:
    """R6b: R6 rolled up to operating system, zero-filled over 24 hours."""
    r6 = browser_os_hourly(star, report_date)
    agg = r6.groupBy("event_hour", "os").agg(F.sum("views").alias("views"))
    return _zero_fill_hours(agg, "os")


def summary_metrics(star: Star, report_date=None) -> DataFrame:
    """R7: total_views, unique_products, unique_countries, unique_referrers.

    One scan of the day: each fact becomes a row for the total and for each of
    its keys, combined to one row per key before the shuffle; dimensions are
    looked up for distinct keys, and distinct values counted at the end."""
    key = lambda m, c: F.struct(F.lit(m).alias("m"), c.cast("string").alias("k"))
    keys = F.array(key("views", F.lit(None)), key("product", F.col("product_key")), key("country", F.col("location_key")),
                   key("referrer", F.nullif(F.col("referrer_url"), F.lit(""))))
    by_key = (day_views(star, report_date).select("event_count", F.inline(keys))
              .groupBy("m", "k").agg(F.sum("event_count").alias("n")))
    products = star.dim_product.select(F.lit("product").alias("m"), F.col("product_key").alias("k"), "product_id")
    places = star.dim_location.select(F.lit("country").alias("m"), F.col("location_key").alias("k"), "country")
    named = by_key.join(products, ["m", "k"], "left").join(places, ["m", "k"], "left")
    m, v = F.col("m"), F.col("v")
    value = F.when(m == "product", F.col("product_id")).when(m == "country", F.col("country")).when(m == "referrer", F.col("k"))
    u = named.groupBy("m", value.alias("v")).agg(F.sum("n").alias("n"))
    return u.agg(
        F.coalesce(F.sum(F.when(m == "views", F.col("n"))), F.lit(0)).cast("bigint").alias("total_views"),
        F.count(F.when(m == "product", v)).alias("unique_products"),
        F.count(F.when(m == "country", v)).alias("unique_countries"),
        F.count(F.when(m == "referrer", v)).alias("unique_referrers"),
    )
