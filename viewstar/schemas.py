"""Declared schemas and star-table metadata.

Nothing is schema-inferred: the raw event, the cleaned event and the five
warehouse tables are fixed here.

Fixed values: names, types and order of the fields and columns are the data
contract.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

OPTION = ArrayType(StructType([
    StructField("option_id", StringType(), True),
    StructField("option_label", StringType(), True),
]))

RAW_EVENT = StructType([
    StructField("id", StringType(), True),
    StructField("time_stamp", LongType(), True),
    StructField("ip", StringType(), True),
    StructField("user_agent", StringType(), True),
    StructField("resolution", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("api_version", StringType(), True),
    StructField("store_id", StringType(), True),
    StructField("local_time", StringType(), True),
    StructField("show_recommendation", BooleanType(), True),
    StructField("current_url", StringType(), True),
    StructField("referrer_url", StringType(), True),
    StructField("email", StringType(), True),
    StructField("collection", StringType(), True),
    StructField("product_id", StringType(), True),
    StructField("option", OPTION, True),
])

CLEAN_EVENT = StructType(list(RAW_EVENT.fields) + [
    StructField("local_ts", TimestampType(), True),
    StructField("event_ts", TimestampType(), True),
    StructField("current_domain", StringType(), True),
    StructField("referrer_domain", StringType(), True),
    StructField("browser", StringType(), True),
    StructField("event_date", DateType(), True),
    StructField("event_hour", IntegerType(), True),
])

RAW_COLUMNS = [f.name for f in RAW_EVENT.fields]
CLEAN_COLUMNS = [f.name for f in CLEAN_EVENT.fields]

DIM_DATE_COLUMNS = ["date_key", "date", "year", "quarter", "month", "month_name",
                    "week_of_year", "day", "day_of_week", "day_name", "is_weekend"]
DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "option_id", "option_label",
                       "valid_from", "valid_to", "is_current"]
DIM_LOCATION_COLUMNS = ["location_key", "ip", "country", "country_code", "region", "city",
                        "postal_code", "latitude", "longitude", "timezone", "isp"]
DIM_CUSTOMER_COLUMNS = ["customer_key", "email"]
FACT_COLUMNS = ["date_key", "product_key", "event_key", "event_id", "event_timestamp", "ip",
                "device_id", "user_agent", "browser", "resolution", "api_version",
                "location_key", "store_id", "local_time", "collection", "current_url",
                "referrer_url", "show_recommendation", "event_count", "ingestion_timestamp",
                "customer_key"]

LEDGER = StructType([
    StructField("query_name", StringType(), False),
    StructField("run_id", StringType(), False),
    StructField("batch_id", LongType(), False),
    StructField("processed_at", TimestampType(), False),
    StructField("layout", IntegerType(), True),
])


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    columns: list[str]
    update_columns: list[str] = field(default_factory=list)
    # Foreign keys: column -> referenced table (its key has the same name).
    foreign_keys: dict[str, str] = field(default_factory=dict)
    not_null: list[str] = field(default_factory=list)


STAR_TABLES: dict[str, TableSpec] = {
    "dim_date": TableSpec("dim_date", "date_key", DIM_DATE_COLUMNS,
                          not_null=["date", "year", "quarter", "month", "month_name",
                                    "week_of_year", "day", "day_of_week", "day_name",
                                    "is_weekend"]),
    "dim_product": TableSpec("dim_product", "product_key", DIM_PRODUCT_COLUMNS,
                             not_null=["product_id", "is_current"]),
    "dim_location": TableSpec("dim_location", "location_key", DIM_LOCATION_COLUMNS),
    "dim_customer": TableSpec("dim_customer", "customer_key", DIM_CUSTOMER_COLUMNS,
                              update_columns=["email"]),
    "fact_log_event": TableSpec(
        "fact_log_event", "event_key", FACT_COLUMNS,
        foreign_keys={"date_key": "dim_date", "product_key": "dim_product",
                      "location_key": "dim_location", "customer_key": "dim_customer"},
        not_null=["event_count", "ingestion_timestamp"]),
}

# Dimensions are merged before the fact so foreign keys resolve.
LOAD_ORDER = ["dim_date", "dim_product", "dim_location", "dim_customer", "fact_log_event"]

#: Layouts that loads were written in: by table, the columns it hadn't yet and those of a narrower type.
LAYOUT = 2
LAYOUTS: dict[int, dict[str, dict]] = {
    1: {"fact_log_event": {"missing": ["browser"], "types": {"event_count": "smallint"}},
        "dim_customer": {"missing": ["email"], "types": {}}},
    2: {},
}
