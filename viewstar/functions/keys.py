"""Surrogate keys of the star schema (SHA-256 hex text)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewstar.functions._col import as_col

KEY_SEP = "||"


def first_option(option) -> Column:
    """Element 0 of the option array; NULL for a NULL or empty array."""
    return F.get(as_col(option), 0)


def date_key(d) -> Column:
    return F.date_format(as_col(d), "yyyyMMdd")


def _blank(c) -> Column:
    return F.coalesce(as_col(c), F.lit(""))


def product_key(product_id, option_id, option_label) -> Column:
    pid = as_col(product_id)
    return F.when(pid.isNotNull(),
                  F.sha2(F.concat_ws(KEY_SEP, pid, _blank(option_id), _blank(option_label)), 256))


def customer_key(email) -> Column:
    e = as_col(email)
    return F.when(e.isNotNull(), F.sha2(F.lower(e), 256))


def location_key(ip, code) -> Column:
    i, c = as_col(ip), as_col(code)
    return F.when(i.isNotNull() | c.isNotNull(),
                  F.sha2(F.concat_ws(KEY_SEP, _blank(i), _blank(c)), 256))
