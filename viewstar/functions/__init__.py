"""Column -> Column functions.  All are native Spark expressions: no Python
worker runs per row, so they stay inside whole-stage codegen and keep
predicate pushdown intact."""

from viewstar.functions.text import nonblank, nonblank_lower, unknown_bucket
from viewstar.functions.timefn import epoch_to_ts, parse_local_time
from viewstar.functions.url import with_clean_url, domain_of, plain_url, url_is_valid
from viewstar.functions.geo import country_code, country_name, COUNTRY_BY_TLD
from viewstar.functions.useragent import browser_family, os_family, report_browser, report_os
from viewstar.functions.keys import (
    first_option, date_key, product_key, customer_key, location_key,
)

__all__ = [
    "nonblank", "nonblank_lower", "unknown_bucket", "epoch_to_ts", "parse_local_time",
    "with_clean_url", "plain_url", "url_is_valid", "domain_of", "country_code", "country_name", "COUNTRY_BY_TLD",
    "browser_family", "os_family", "report_browser", "report_os", "first_option",
    "date_key", "product_key", "customer_key", "location_key",
]
