"""URL canonicalisation and host extraction as native Spark expressions.

with_clean_url(df, u) follows the semantics of a parse / unquote / quote /
unparse round trip:

1. NULL or blank -> NULL; tab, CR and LF are removed, outer whitespace cut.
2. The scheme (text before the first ':' made of scheme characters, starting
   with a letter) is lower-cased; a missing scheme becomes 'http'.
3. The authority ('//' up to the next '/', '?' or '#') is lower-cased; an
   unbalanced '[' or ']' in it makes the whole URL invalid -> NULL.
4. '#fragment' is dropped; for parameter-carrying schemes so is ';params' of
   the last path segment.
5. Path and query are percent-decoded (UTF-8) and re-encoded, keeping
   alphanumerics, '_.-~' and a per-part safe set -- lossy on purpose:
   '%26' in a path comes back as a literal '&'.
6. One trailing '/' of the whole result is removed.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.functions._col import as_col

# The URL-quoting contract to reproduce.
PATH_SAFE = "/:@&+$,;="
QUERY_SAFE = "=&?/:@+,$;"
# Schemes whose last path segment may carry ';params' (dropped).
PARAM_SCHEMES = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
                 "rtspu", "sip", "sips", "mms", "sftp", "tel"]
# Schemes written with a '//' authority even when it is empty.
NETLOC_SCHEMES = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
                  "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtspu", "rsync",
                  "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss"]

_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _percent(ch: str) -> str:
    return "%" + format(ord(ch), "02X")


_UNRESERVED = "A-Za-z0-9_.~\\-"


def _already_quoted(x: Column, safe: str) -> Column:
    """True when decoding then encoding cannot change x: no '%' and only
    unreserved or safe characters.  Most URLs take this branch, so the
    decode/encode chain runs only for the rest."""
    cls = "".join("\\" + ch for ch in safe)
    return x.rlike(f"^[{_UNRESERVED}{cls}]*$")


def quote_part(c, safe: str) -> Column:
    """Percent-decode then re-encode as UTF-8, keeping alphanumerics, '_.-~'
    and the characters of `safe`.

    Built on url_decode/url_encode (form encoding), corrected to plain
    percent-encoding: '+' is protected before decoding, a '%' not followed by
    two hex digits is kept literally, and the encoder's '+', '*' and '%7E'
    are mapped to '%20', '%2A' and '~'.
    """
    src = as_col(c)
    x = F.replace(src, F.lit("+"), F.lit("%2B"))
    x = F.regexp_replace(x, r"%(?![0-9A-Fa-f]{2})", "%25")
    x = F.url_encode(F.url_decode(x))
    x = F.replace(x, F.lit("+"), F.lit("%20"))
    x = F.replace(x, F.lit("*"), F.lit("%2A"))
    x = F.replace(x, F.lit("%7E"), F.lit("~"))
    for ch in safe:
        x = F.replace(x, F.lit(_percent(ch)), F.lit(ch))
    return F.when(_already_quoted(src, safe), src).otherwise(x)


def _strip_ws(c: Column) -> Column:
    c = F.regexp_replace(c, r"[\t\r\n]", "")
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _authority(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^//([^/?#]*)", 1)


#: Characters whose compatibility form (NFKC) holds one of / ? # @ :, by the Unicode data.
_SPLITTING = "".join(chr(i) for i in range(0x80, 0x10000) if set(unicodedata.normalize("NFKC", chr(i))) & set("/?#@:"))


def _bad_authority(netloc: Column) -> Column:
    """Brackets out of balance, or characters that would move the authority's end once normalised."""
    has_open = F.instr(netloc, "[") > 0
    has_close = F.instr(netloc, "]") > 0
    return (has_open != has_close) | netloc.rlike(f"[{_SPLITTING}]")


#: URLs of which the cleaning only drops the fragment and a last slash: lower-case
#: scheme and host, nothing to encode, decode or cut.
_PLAIN = (rf"(?s)^(https?://[a-z0-9][a-z0-9.\-]*(?::[0-9]+)?(?:/[{_UNRESERVED}/:@&+$,=]*)?"
          rf"(?:\?[{_UNRESERVED}=&?/:@+,$;]+)?)(?:#.*)?\z")


def plain_url(c) -> Column:
    """What most URLs of browsers become, but for a last slash; '' for URLs that need more, or for none."""
    return F.coalesce(F.regexp_extract(as_col(c), _PLAIN, 1), F.lit(""))


def with_clean_url(df: DataFrame, src: str, dst: str | None = None, domain: str | None = None, plain: str | None = None) -> DataFrame:
    """Add (or replace) column `dst` = clean_url(`src`), and with `domain` its
    domain_of under that name.  `plain` names a column that holds plain_url(src)
    already; it is dropped.

    Written as a few successive projections: each intermediate part (scheme,
    authority, path, query, their encodings) is computed once and referenced
    by name.  Catalyst does not collapse projections when that would
    duplicate expensive expressions, so the generated code stays linear in
    the number of steps instead of growing with every reuse.  A plain URL has
    NULL parts, which cost next to nothing."""
    dst = dst or src
    t = f"__cu_{dst}_"
    n = lambda x: F.col(t + x)
    cols = [c for c in df.columns if c != plain]
    df = df.select(*cols, (F.col(plain) if plain else plain_url(src)).alias(t + "plain"))
    df = df.select("*", F.when(n("plain") == "", F.nullif(_strip_ws(F.col(src)), F.lit(""))).alias(t + "s"))
    df = df.select("*",
                   F.lower(F.regexp_extract(n("s"), _SCHEME_RE, 1)).alias(t + "scheme"),
                   F.regexp_replace(n("s"), _SCHEME_RE, "").alias(t + "rest"))
    df = df.select("*",
                   F.lower(_authority(n("rest"))).alias(t + "netloc"),
                   F.regexp_extract(n("rest"), r"^(?://[^/?#]*)?([^?#]*)", 1).alias(t + "path0"),
                   F.regexp_extract(n("rest"), r"^(?://[^/?#]*)?[^?#]*\?([^#]*)", 1).alias(t + "query"))
    path = F.when(n("scheme").isin(PARAM_SCHEMES) & (F.instr(n("path0"), ";") > 0),
                  F.regexp_replace(n("path0"), r"^((?:[\s\S]*/)?[^/;]*);[^/]*$", "$1")).otherwise(n("path0"))
    df = df.select("*",
                   quote_part(path, PATH_SAFE).alias(t + "epath"),
                   quote_part(n("query"), QUERY_SAFE).alias(t + "equery"),
                   F.when(n("scheme") == "", F.lit("http")).otherwise(n("scheme")).alias(t + "scheme2"))
    epath, scheme, netloc, equery = n("epath"), n("scheme2"), n("netloc"), n("equery")
    with_authority = (netloc != "") | (scheme.isin(NETLOC_SCHEMES) & ~epath.startswith("//"))
    slash_path = F.when((epath != "") & ~epath.startswith("/"),
                        F.concat(F.lit("/"), epath)).otherwise(epath)
    body = F.when(with_authority, F.concat(F.lit("//"), netloc, slash_path)).otherwise(epath)
    url = F.concat(scheme, F.lit(":"), body,
                   F.when(equery != "", F.concat(F.lit("?"), equery)).otherwise(F.lit("")))
    url = F.regexp_replace(url, "/$", "")
    short = F.when(n("plain").endswith("/"), F.substr(n("plain"), F.lit(1), F.length(n("plain")) - 1)).otherwise(n("plain"))
    df = df.select(*cols, n("plain"), F.when(n("plain") != "", short).when(n("s").isNotNull() & ~_bad_authority(netloc), url).alias(t + "url"))
    out = [n("url").alias(dst) if c == dst else F.col(c) for c in cols]
    if dst not in cols:
        out.append(n("url").alias(dst))
    if domain:
        # a plain host has no capital, no bracket and no splitting character
        host = F.substring_index(F.substring_index(F.substring_index(n("url"), "/", 3), "/", -1), "?", 1)
        out.append(F.when(n("plain") != "", host).otherwise(domain_of(n("url"))).alias(domain))
    return df.select(*out)


# Authority with '[' but no ']' or ']' but no '[' (an invalid IPv6 host), or with a splitting character.
_BAD_AUTHORITY = (r"(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
                  r"(?:(?:[^/?#\]]*\[[^/?#\]]*|[^/?#\[]*\][^/?#\[]*)(?:[/?#]|$)"
                  rf"|[^/?#]*[{_SPLITTING}])")


def url_is_valid(c) -> Column:
    """True exactly when with_clean_url gives a non-NULL result: the text is
    not blank and its authority is acceptable.

    One regular expression over the stripped text, so a filter can run it
    before the URL work (filters get no common-subexpression elimination,
    so repeated sub-expressions would be evaluated twice there)."""
    return _strip_ws(as_col(c)).rlike(rf"^(?!{_BAD_AUTHORITY})(?s:.)")


def domain_of(c) -> Column:
    """Lower-cased authority of a URL (user info and port included); NULL
    when there is none or the URL is invalid."""
    s = F.regexp_replace(as_col(c), _SCHEME_RE, "")
    netloc = F.lower(_authority(s))
    return F.when(~_bad_authority(netloc), F.nullif(netloc, F.lit("")))
