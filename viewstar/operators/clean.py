"""Message decoding and event cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.functions import (
    browser_family, epoch_to_ts, nonblank, nonblank_lower, parse_local_time,
    plain_url, url_is_valid, with_clean_url,
)
from viewstar.schemas import CLEAN_COLUMNS, RAW_EVENT

# Fields trimmed to NULL-if-blank (resolution and option are kept as sent).
_NONBLANK = ["id", "api_version", "current_url", "referrer_url", "device_id", "email", "ip",
             "local_time", "product_id", "store_id", "user_agent"]


def decode(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """`value` bytes -> UTF-8 text -> JSON with the fixed raw-event schema.

    Rows whose text is NULL or empty decode to NULL and are dropped.  A
    malformed document decodes to a struct of NULLs, which the validity
    filter of clean() removes (its id is NULL); a bad field only nulls that
    field.  Columns named in `keep` are carried along."""
    text = F.col(value_col).cast("string")
    ev = F.from_json(F.col("_text"), RAW_EVENT)
    # Filters on the fields stay above the generator, so that each message is
    # parsed once; below it they would be rewritten into a parse for each.
    # A text of blanks has no document, just as an empty one.
    return (messages.select(text.alias("_text"), *keep).where(~F.col("_text").rlike(r"^[ \t\r\n]*$"))
            .select(F.inline(F.array(ev)), *keep))


_PLAIN, _VALID = "_url_if_plain", "_url_is_valid"


def rejects() -> list:
    """Counts of invalid rows by the first reason that holds."""
    reasons = {"no_id": F.col("id").isNull(), "no_local_time": F.col("local_ts").isNull(),
               "epoch_out_of_range": F.col("event_ts").isNull() & F.col("time_stamp").isNotNull(),
               "no_epoch": F.col("event_ts").isNull(), "no_url": ~F.col(_VALID)}
    out, none_before = [], F.lit(True)
    for name, test in reasons.items():
        out.append(F.count_if(none_before & test).alias(name))
        none_before = none_before & ~test
    return out


def clean(raw: DataFrame, keep: tuple[str, ...] = (), observe: str | None = None) -> DataFrame:
    """Raw events -> cleaned events (23 fields), invalid rows removed.

    Valid = id, current_url, local_ts and event_ts all present.  The test on
    current_url uses url_is_valid (the exact non-NULL condition of the URL
    cleaning), so the filter runs before the URL work and only surviving
    rows are canonicalised.  With `observe`, the invalid rows are counted by
    reason in an observed metric of that name."""
    c = {name: F.col(name) for name in raw.columns}
    for name in _NONBLANK:
        c[name] = nonblank(name)
    c["collection"] = nonblank_lower("collection")
    df = raw.select(*[c[f.name].alias(f.name) for f in RAW_EVENT.fields], *keep)
    df = df.select(
        "*",
        parse_local_time("local_time").alias("local_ts"),
        epoch_to_ts("time_stamp").alias("event_ts"),
        plain_url("current_url").alias(_PLAIN),
    )
    # tested once: counted, filtered and cleaned by the two columns
    df = df.select("*", ((F.col(_PLAIN) != "") | F.coalesce(url_is_valid("current_url"), F.lit(False))).alias(_VALID))
    if observe:
        df = df.observe(observe, *rejects())
    df = df.where(F.col("id").isNotNull() & F.col("local_ts").isNotNull()
                  & F.col("event_ts").isNotNull() & F.col(_VALID)).drop(_VALID)
    df = with_clean_url(df, "current_url", domain="current_domain", plain=_PLAIN)
    df = with_clean_url(df, "referrer_url", domain="referrer_domain")
    return df.select(
        *[F.col(n) for n in RAW_EVENT.fieldNames()], "local_ts", "event_ts", "current_domain", "referrer_domain",
        browser_family("user_agent").alias("browser"),
        F.to_date("event_ts").alias("event_date"),
        F.hour("event_ts").alias("event_hour"),
        *keep,
    ).select(*CLEAN_COLUMNS, *keep)
