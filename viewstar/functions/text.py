"""Text normalisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewstar.functions._col import as_col


def nonblank(c) -> Column:
    """Trim spaces; empty text becomes NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def nonblank_lower(c) -> Column:
    """nonblank, then lower case."""
    return F.lower(nonblank(c))


def unknown_bucket(c) -> Column:
    """Report bucket: NULL or empty text is shown as 'Unknown'."""
    return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit("Unknown"))
