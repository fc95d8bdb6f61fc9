"""Browser and operating-system families from a user-agent string.

An ordered rule list (first match wins) compiled into one CASE expression of
byte searches, and regular expressions behind them: evaluated in the JVM, per
row, with no Python worker.  Order matters: Edge, Opera and Samsung Internet also announce
Chrome; Chrome announces Safari; iOS announces 'Mac OS X'.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewstar.functions._col import as_col

# Fixed values: (pattern, family) in priority order.
BROWSER_RULES = [
    # crawlers and libraries first: many carry a browser's string as well
    (r"Googlebot", "Googlebot"),
    (r"[Bb]ingbot|BingPreview", "bingbot"),
    (r"YandexBot", "YandexBot"),
    (r"facebookexternalhit", "FacebookBot"),
    (r"[Bb]ot\b|[Cc]rawler|[Ss]pider", "Other Bot"),
    # apps that show pages in a frame of their own
    (r"FBAN/|FBAV/", "Facebook"),
    (r"Instagram", "Instagram"),
    (r"EdgA/|EdgiOS/|Edge?/.* Mobile|Mobile.* Edge/", "Edge Mobile"),
    (r"Edge?/", "Edge"),
    (r"Opera Mini|OPiOS/|OPT/", "Opera Mini"),
    (r"OPR/.*Mobile|Mobile.*OPR/|Opera Mobi", "Opera Mobile"),
    (r"OPR/|Opera", "Opera"),
    (r"UCBrowser/|UCWEB", "UC Browser"),
    (r"YaBrowser/", "Yandex Browser"),
    (r"SamsungBrowser/", "Samsung Internet"),
    (r"CriOS/", "Chrome Mobile iOS"),
    (r"FxiOS/", "Firefox iOS"),
    (r"; wv\)|Version/[0-9.]+ Chrome/", "Chrome Mobile WebView"),
    (r"Chrome/[0-9.]+ Mobile", "Chrome Mobile"),
    (r"Chrome/|Chromium/", "Chrome"),
    (r"Mobile.*Firefox/|Android.*Firefox/", "Firefox Mobile"),
    (r"Firefox/", "Firefox"),
    (r"(iPhone|iPad|iPod).*Safari/", "Mobile Safari"),
    (r"(iPhone|iPad|iPod).*AppleWebKit/", "Mobile Safari UI/WKWebView"),
    (r"Android.*Version/[0-9.]+.*Safari/", "Android"),
    (r"Version/[0-9.]+.*Safari/", "Safari"),
    (r"MSIE |Trident/", "IE"),
]

OS_RULES = [
    (r"Windows Phone|IEMobile", "Windows Phone"),
    (r"Windows", "Windows"),
    (r"iPhone|iPad|iPod", "iOS"),
    (r"Android", "Android"),
    (r"CrOS", "Chrome OS"),
    (r"Mac OS X|Macintosh", "Mac OS X"),
    (r"Ubuntu", "Ubuntu"),
    (r"Linux", "Linux"),
]

OTHER = "Other"
UNKNOWN = "Unknown"


def _alternatives(pattern: str) -> list[str]:
    """The pattern cut at its outermost '|'."""
    out, depth, start, i = [], 0, 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 1
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "|" and depth == 0:
            out.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*out, pattern[start:]]


def _literals(pattern: str) -> tuple[list[str], bool]:
    """Texts that every match of a pattern without an outermost '|' holds, and
    whether they are all the pattern says."""
    runs, run, whole, depth, i = [], "", True, 0, 0
    while i < len(pattern):
        ch, plain = pattern[i], False
        if ch == "\\":
            i += 1
            ch, plain = pattern[i], not pattern[i].isalnum()
        elif ch not in "^$.[]()*+?|{}":
            plain = True
        if depth == 0 and plain:
            run += ch
        else:
            whole = False
            if depth == 0 and not plain and ch in "?*{":
                run = run[:-1]  # the character before may be missing
            runs.append(run)
            run = ""
            if not plain:
                depth += (ch in "([") - (ch in ")]")
        i += 1
    return [r for r in [*runs, run] if len(r) > 1], whole


def matches(c: Column, pattern: str) -> Column:
    """rlike, by byte searches first: an alternative is tried as a regular
    expression only where its literal texts occur."""
    test = None
    for alternative in _alternatives(pattern):
        texts, whole = _literals(alternative)
        hit = reduce(lambda a, b: a & b, [c.contains(t) for t in texts] + ([] if whole and texts else [c.rlike(alternative)]))
        test = hit if test is None else test | hit
    return test


def _first_match(c: Column, rules) -> Column:
    expr = None
    for pattern, family in rules:
        test = matches(c, pattern)
        expr = F.when(test, F.lit(family)) if expr is None else expr.when(test, F.lit(family))
    return expr.otherwise(F.lit(OTHER))


def browser_family(ua) -> Column:
    """Browser family; NULL user agent -> NULL, unmatched -> 'Other'."""
    c = as_col(ua)
    return F.when(c.isNotNull(), _first_match(c, BROWSER_RULES))


def os_family(ua) -> Column:
    """Operating-system family; NULL user agent -> NULL, unmatched -> 'Other'."""
    c = as_col(ua)
    return F.when(c.isNotNull(), _first_match(c, OS_RULES))


def report_browser(ua) -> Column:
    """Report form: empty or NULL user agent -> 'Unknown'."""
    c = F.nullif(as_col(ua), F.lit(""))
    return F.coalesce(browser_family(c), F.lit(UNKNOWN))


def report_os(ua) -> Column:
    c = F.nullif(as_col(ua), F.lit(""))
    return F.coalesce(os_family(c), F.lit(UNKNOWN))
