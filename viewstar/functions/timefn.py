"""Event time parsing."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewstar.functions._col import as_col

LOCAL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Epoch values strictly above this are milliseconds; this value itself is seconds.
MILLIS_THRESHOLD = 1_000_000_000_000
# Outside these bounds the microsecond count would overflow a long; such
# values give NULL instead of failing the job under ANSI mode.
_MAX_MILLIS = 9_223_372_036_854_775
_MAX_SECONDS = 9_223_372_036_854


def parse_local_time(c) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text to TIMESTAMP; unparsable text gives NULL."""
    return F.try_to_timestamp(as_col(c), F.lit(LOCAL_TIME_FORMAT))


def epoch_to_ts(c) -> Column:
    """Epoch number to TIMESTAMP: milliseconds when > 10^12, else seconds."""
    x = as_col(c)
    return (F.when(x > F.lit(MILLIS_THRESHOLD),
                   F.when(x <= F.lit(_MAX_MILLIS), F.timestamp_millis(x)))
             .when(x >= F.lit(-_MAX_SECONDS), F.timestamp_seconds(x)))
