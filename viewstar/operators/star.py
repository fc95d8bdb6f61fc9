"""Star-schema builders: cleaned events -> base frame -> five tables.

Every builder is a plain DataFrame -> DataFrame function; nothing is
collected.  Dimension builders are aggregations (partial aggregation before
the shuffle), so a product or customer with a huge share of events costs
no more than a small one.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.functions import (
    country_code, country_name, customer_key, date_key, first_option, location_key,
    product_key,
)
from viewstar.operators.dedup import Repeated, dedup_stable, dedup_wide
from viewstar.schemas import (
    DIM_CUSTOMER_COLUMNS, DIM_DATE_COLUMNS, DIM_LOCATION_COLUMNS, DIM_PRODUCT_COLUMNS,
    FACT_COLUMNS,
)


class Star(NamedTuple):
    dim_date: DataFrame
    dim_product: DataFrame
    dim_location: DataFrame
    dim_customer: DataFrame
    fact_log_event: DataFrame
    # Optional (date_key, views) summary of view facts kept by the loader;
    # lets "which days have views" avoid scanning the fact.
    day_views: DataFrame | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        d = self._asdict()
        d.pop("day_views")
        return d


def base_frame(cleaned: DataFrame, repeated: Repeated | None = None) -> DataFrame:
    """Cleaned events, one row per event_key (= id; stable survivor: earliest
    event_ts, then local_ts, then the other columns), plus option fields,
    surrogate keys and country.

    The dedup runs first, on the cleaned columns only, so the shuffle does
    not carry the three 64-character keys and the derived columns, and the
    hashes are computed once per event rather than once per copy.  With
    `repeated` (repeated_keys(cleaned, "id")) only the rows of those ids are
    shuffled and compared."""
    order = ["event_ts", "local_ts"]
    unique = dedup_stable(cleaned, ["id"], order) if repeated is None else dedup_wide(cleaned, "id", order, repeated)
    opt = first_option("option")
    df = unique.select(
        "*",
        opt.getField("option_id").alias("option_id"),
        opt.getField("option_label").alias("option_label"),
        date_key("event_date").alias("date_key"),
        country_code("current_domain").alias("country_code"),
    )
    return df.select(
        "*",
        product_key("product_id", "option_id", "option_label").alias("product_key"),
        customer_key("email").alias("customer_key"),
        country_name("country_code").alias("country"),
        location_key("ip", "country_code").alias("location_key"),
        F.col("id").alias("event_key"),
    )


def dim_date(base: DataFrame) -> DataFrame:
    d = F.col("date")
    days = (base.where(F.col("date_key").isNotNull() & F.col("event_date").isNotNull())
                .groupBy("date_key").agg(F.min("event_date").alias("date")))
    return days.select(
        "date_key", "date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ).select(*DIM_DATE_COLUMNS)


def dim_product(base: DataFrame) -> DataFrame:
    """One row per product_key.  NULL and '' option fields hash to the same
    key, so the option fields are taken as max(nullif(x, '')) per key; ids
    whose text with their options makes the same key share its row.

    Least and greatest texts need sorted rows, so they are taken over the few
    distinct ones, which a hash aggregate finds."""
    few = (base.where(F.col("product_key").isNotNull())
               .groupBy("product_key", "product_id", F.nullif("option_id", F.lit("")).alias("option_id"),
                        F.nullif("option_label", F.lit("")).alias("option_label"))
               .agg(F.min("event_date").alias("valid_from")))
    return (few.groupBy("product_key")
                .agg(F.min("product_id").alias("product_id"),
                     F.max("option_id").alias("option_id"),
                     F.max("option_label").alias("option_label"),
                     F.min("valid_from").alias("valid_from"))
                .select(*DIM_PRODUCT_COLUMNS[:5],
                        F.lit(None).cast("date").alias("valid_to"),
                        F.lit(True).alias("is_current")))


def dim_location(base: DataFrame) -> DataFrame:
    """One row per location_key; ip, country and code are functions of it (the
    least of several, over the distinct ones, as in dim_product)."""
    nulls = [F.lit(None).cast("double" if c in ("latitude", "longitude") else "string").alias(c)
             for c in DIM_LOCATION_COLUMNS[4:]]
    return (base.where(F.col("location_key").isNotNull())
                .groupBy("location_key", "ip", "country", "country_code")
                .agg(F.count(F.lit(1)).alias("events"))
                .where("events > 0")  # else Spark drops the inner aggregate
                .groupBy("location_key")
                .agg(F.min(F.struct("ip", "country", "country_code")).alias("v"))
                .select("location_key", "v.ip", "v.country", "v.country_code", *nulls))


def dim_customer(base: DataFrame) -> DataFrame:
    return (base.where(F.col("customer_key").isNotNull())
                .select("customer_key", F.lower("email").alias("email"))
                .distinct()
                .select(*DIM_CUSTOMER_COLUMNS))


def fact_log_event(base: DataFrame, ingestion_timestamp: Column | _dt.datetime | None = None) -> DataFrame:
    """The event fact: one row per event_key, additive event_count = 1.
    `ingestion_timestamp` defaults to the query's current_timestamp()."""
    if ingestion_timestamp is None:
        ts = F.current_timestamp()
    elif isinstance(ingestion_timestamp, Column):
        ts = ingestion_timestamp
    else:
        # a time without a zone is UTC, whatever the driver's zone
        ts = F.lit(ingestion_timestamp if ingestion_timestamp.tzinfo else
                   ingestion_timestamp.replace(tzinfo=_dt.timezone.utc)).cast("timestamp")
    cols = {
        "event_id": F.col("id"),
        "event_timestamp": F.col("event_ts"),
        "event_count": F.lit(1),
        "ingestion_timestamp": ts,
    }
    return (base.where(F.col("event_key").isNotNull())
                .select(*[cols.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS]))


def build_star(base: DataFrame, ingestion_timestamp=None) -> Star:
    return Star(dim_date(base), dim_product(base), dim_location(base), dim_customer(base),
                fact_log_event(base, ingestion_timestamp))
