"""Country from a site's domain."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewstar.functions._col import as_col

# Two-letter top-level domain -> country name, in the order
# the lookup is specified.  A code missing here is shown as the code itself.
COUNTRY_BY_TLD = {
    "ar": "Argentina",
    "at": "Austria",
    "au": "Australia",
    "be": "Belgium",
    "bg": "Bulgaria",
    "br": "Brazil",
    "ca": "Canada",
    "ch": "Switzerland",
    "cl": "Chile",
    "co": "Colombia",
    "cz": "Czech Republic",
    "de": "Germany",
    "dk": "Denmark",
    "ee": "Estonia",
    "es": "Spain",
    "fi": "Finland",
    "fr": "France",
    "gr": "Greece",
    "hr": "Croatia",
    "hu": "Hungary",
    "ie": "Ireland",
    "il": "Israel",
    "in": "India",
    "it": "Italy",
    "jp": "Japan",
    "lt": "Lithuania",
    "lu": "Luxembourg",
    "lv": "Latvia",
    "mx": "Mexico",
    "nl": "Netherlands",
    "no": "Norway",
    "nz": "New Zealand",
    "pl": "Poland",
    "pt": "Portugal",
    "ro": "Romania",
    "se": "Sweden",
    "sg": "Singapore",
    "si": "Slovenia",
    "sk": "Slovakia",
    "tr": "Turkey",
    "uk": "United Kingdom",
    "us": "United States",
}


def country_code(domain) -> Column:
    """Last non-empty dot-separated label of the domain, upper-cased, when it
    is exactly two letters (any script); otherwise NULL.  A port or an IP
    address therefore gives NULL."""
    d = F.lower(F.regexp_replace(as_col(domain), r"^\s+|\s+$", ""))
    # Empty labels are ignored: drop trailing dots, then take the last label.
    last = F.substring_index(F.regexp_replace(d, r"\.+$", ""), ".", -1)
    return F.when(last.rlike(r"^\p{L}{2}$"), F.upper(last))


def _country_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(COUNTRY_BY_TLD.items())])


def country_name(code) -> Column:
    """Country name for a code from country_code(); unmapped codes stay as
    they are, NULL stays NULL."""
    c = as_col(code)
    return F.coalesce(F.try_element_at(_country_map(), F.lower(c)), c)
