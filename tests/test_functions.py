"""Hand-computed cases for the column functions (FIXTURES.md section 4)."""

import datetime as dt
from urllib.parse import quote, unquote

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from viewstar.functions import (
    country_code, country_name, domain_of, epoch_to_ts, nonblank, nonblank_lower,
    plain_url, parse_local_time, report_browser, report_os, url_is_valid, with_clean_url, browser_family,
    os_family,
)
from viewstar.functions.url import PATH_SAFE, QUERY_SAFE, quote_part
from viewstar.sources.fixtures import USER_AGENTS


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def _clean(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in with_clean_url(df, "x", "y").orderBy("i").collect()]


def test_nonblank(spark):
    assert _one(spark, [None, "", "   ", " a ", "B"], nonblank) == [None, None, None, "a", "B"]
    assert _one(spark, [" View_Product_Detail ", "  "], nonblank_lower) == ["view_product_detail", None]


def test_clean_url_cases(spark):
    cases = {
        None: None,
        "   ": None,
        "HTTP://u@A.CL:80/a;p=1?q=%26x#f": "http://u@a.cl:80/a?q=&x",
        "http://a.com/": "http://a.com",
        "http://a.com/?r=/": "http://a.com/?r=",
        "//a.cl/x": "http://a.cl/x",
        "http://[bad/x": None,
        "http://a.com/a b/é/%zz/+/*/~": "http://a.com/a%20b/%C3%A9/%25zz/+/%2A/~",
        "http://a.com/x%3By": "http://a.com/x;y",
        "www.foo.com/p": "http:///www.foo.com/p",
        "mailto:x@y.com": "mailto:x@y.com",
        "https://a.com/p/q;x=1/r;y=2?k=v;w#frag": "https://a.com/p/q;x=1/r?k=v;w",
    }
    got = _clean(spark, list(cases))
    assert got == list(cases.values())


def test_clean_url_not_idempotent(spark):
    # '%3B' decodes to ';' which a second pass treats as ';params'.
    once = _clean(spark, ["http://a.com/x%3By"])[0]
    assert once == "http://a.com/x;y"
    assert _clean(spark, [once])[0] == "http://a.com/x"


def test_url_is_valid_matches_clean_url(spark):
    values = [None, "", " ", "http://[bad/x", "http://a]/", "http://[::1]/x", "a", "//x"]
    valid = _one(spark, values, url_is_valid)
    cleaned = _clean(spark, values)
    assert [bool(v) for v in valid] == [c is not None for c in cleaned]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab%2F3Aé+*~ ;=&?/:@$,#zZ9", max_size=12), min_size=1, max_size=8))
def test_quote_part_matches_stdlib(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select(quote_part(F.col("x"), PATH_SAFE).alias("p"),
                     quote_part(F.col("x"), QUERY_SAFE).alias("q")).collect()
    for t, r in zip(texts, rows):
        assert r.p == quote(unquote(t), safe=PATH_SAFE)
        assert r.q == quote(unquote(t), safe=QUERY_SAFE)


def test_domain_of(spark):
    got = _one(spark, ["http://u@A.CL:80/a", "http:///x", None, "https://b.com?x", "http://[bad/"], domain_of)
    assert got == ["u@a.cl:80", None, None, "b.com", None]


def test_country_code_and_name(spark):
    domains = ["a.cl", "a.cl.", "A.CO.UK", "x.eu", "a.рф", "1.2.3.44", "a.cl:80", "com", "", None, "shop.us"]
    codes = _one(spark, domains, country_code)
    assert codes == ["CL", "CL", "UK", "EU", "РФ", None, None, None, None, None, "US"]
    names = _one(spark, ["CL", "UK", "EU", "GB", None], country_name)
    assert names == ["Chile", "United Kingdom", "EU", "GB", None]


def test_epoch_to_ts(spark):
    values = [None, -5, 1716885082, 1716885082123, 1000000000000, 1000000000001]
    micros = _one(spark, values, lambda c: F.unix_micros(epoch_to_ts(c)), "bigint")
    assert micros == [None, -5_000_000, 1716885082_000000, 1716885082_123000,
                      10**18, 1000000000001 * 1000]  # exactly 10^12 is seconds


def test_parse_local_time(spark):
    got = _one(spark, ["2024-05-28 08:31:22", "bad-time", None, "2024-13-01 00:00:00"], parse_local_time)
    assert got == [dt.datetime(2024, 5, 28, 8, 31, 22), None, None, None]


def test_user_agent_families(spark):
    uas = USER_AGENTS + [None, ""]
    b = _one(spark, uas, browser_family)
    o = _one(spark, uas, os_family)
    assert b[:8] == ["Chrome", "Firefox", "Safari", "Mobile Safari", "Chrome Mobile", "Edge",
                     "Samsung Internet", "Other"]
    assert o[:8] == ["Windows", "Ubuntu", "Mac OS X", "iOS", "Android", "Windows", "Android", "Other"]
    assert b[8] is None and o[8] is None
    assert _one(spark, [None, ""], report_browser) == ["Unknown", "Unknown"]
    assert _one(spark, [None, ""], report_os) == ["Unknown", "Unknown"]


def test_user_agents_seen_daily(spark):
    """Hand-written families of crawlers, in-app browsers, web views and other mobile browsers."""
    cases = [
        ("Mozilla/5.0 (Linux; Android 6.0.1; Nexus 5X) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Mobile Safari/537.36 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot", "Android"),
        ("Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)", "bingbot", "Other"),
        ("Mozilla/5.0 (Linux; Android 13; SM-A536B Build/TP1A; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/116.0.0.0 Mobile Safari/537.36", "Chrome Mobile WebView", "Android"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS;FBAV/440.0]", "Facebook", "iOS"),
        ("Mozilla/5.0 (Linux; Android 10; K) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Mobile Safari/537.36 EdgA/124.0", "Edge Mobile", "Android"),
        ("Mozilla/5.0 (Linux; Android 10; K) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Mobile Safari/537.36 OPR/76.0", "Opera Mobile", "Android"),
        ("Mozilla/5.0 (Linux; U; Android 4.0.3; de-de; Galaxy S II) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Mobile Safari/534.30", "Android", "Android"),
        ("Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1; Microsoft; Lumia 950) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/52.0 Mobile Safari/537.36 Edge/15.15063", "Edge Mobile", "Windows Phone"),
        ("Mozilla/5.0 (Linux; U; Android 9; en-US; X) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0 UCBrowser/13.4 Mobile Safari/537.36", "UC Browser", "Android"),
        ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/122.0 YaBrowser/24.4 Safari/537.36", "Yandex Browser", "Windows"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 Instagram 300.0", "Instagram", "iOS"),
    ]
    uas = [u for u, _, _ in cases]
    assert _one(spark, uas, browser_family) == [b for _, b, _ in cases]
    assert _one(spark, uas, os_family) == [o for _, _, o in cases]


def test_urls_longer_than_any_cut_and_authorities_that_split(spark):
    from viewstar.catalog import QUERIES
    import os
    import tempfile
    folder = tempfile.mkdtemp(prefix="urls-")
    long_url = "http://a.example.com/" + "x" * 20_000
    spark.createDataFrame([(1, long_url, "h"), (2, "http://a\u2100b.cl/x", "h"), (3, "http://\uff1a\uff0fa.cl/x", "h"), (4, "http://a.cl/\u2100", "h")],
                          "page_id long, url string, html string").write.parquet(os.path.join(folder, "pages.parquet"))
    got = {r.page_id: r for r in QUERIES["clean_url"](spark, folder).collect()}
    assert got[1].clean_u_params == long_url and got[1].clean_url == long_url
    assert got[2].clean_url is None and got[3].clean_url is None and got[4].clean_url == "http://a.cl/%E2%84%80"
    domains = {r.page_id: r.raw_domain for r in QUERIES["extract_domain"](spark, folder).collect()}
    assert domains[1] == "a.example.com" and domains[2] is None and domains[4] == "a.cl"


def test_clean_url_matches_duckdb_twin_on_random_urls(spark):
    """Two independent implementations (Spark regex/url_decode vs DuckDB RE2/
    url_decode) agree on random URL-like strings, domains included."""
    import random
    from urllib.parse import unquote_to_bytes

    import duckdb

    from viewstar.oracle.duck import clean_url_sql, domain_sql

    def utf8_ok(u):
        try:
            unquote_to_bytes(u.replace("+", "%2B")).decode("utf-8")
            return True
        except UnicodeDecodeError:
            return False

    rnd = random.Random(11)
    parts = ["http", "HTTPS", "ftp", "mailto", "x+y", ":", "//", "/", "?", "#", ";", "=", "&", "%", "%2F",
             "%zz", "%41", "%e2%82%ac", "+", "*", "~", " ", "a", "B", "é", "[", "]", "@", "host.CL", ".", "80"]
    urls = [u for u in ("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9))) for _ in range(800))
            if utf8_ok(u)][:500]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string")
    got = {r.i: (r.c, r.d) for r in with_clean_url(df, "u", "c").select(
        "i", "c", domain_of("c").alias("d")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, u VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(urls)))
    want = {i: (c, d) for i, c, d in con.execute(
        f"SELECT i, c, {domain_sql('c')} FROM (SELECT i, {clean_url_sql('u')} AS c FROM t)").fetchall()}
    assert got == want


def test_plain_urls_equal_the_whole_cleaning(spark):
    import random
    rng = random.Random(11)
    parts = ["http://", "https://", "HTTP://", "ftp://", "//", "a.cl", "A.cl", "x-y.com", ":80", "u@", "/", "/p", "/p;q=1", "//", "/a b", "/%41", "/%", "/~x", "?", "?q=1", "?q=/", "&r=a+b", "?é", "#f", "/", "[", "\n", ""] + ["http://a.cl", "https://x.com", "/p/q", "?z=1"] * 4
    urls = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(3000)] + ["http://a.cl", "http://a.cl\n", "http://a.cl/x?y", "https://a-b.cl:8/x/y.html?z=1&a=//b"]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string").withColumn("no", F.lit(""))
    short = with_clean_url(df.drop("no"), "u", "c", domain="d").withColumn("canonical", plain_url("u") != "")
    whole = with_clean_url(df, "u", "c", domain="d", plain="no")
    a = {r.i: (r.c, r.d) for r in short.collect()}
    assert a == {r.i: (r.c, r.d) for r in whole.collect()}
    assert all(r.d == r.want for r in whole.withColumn("want", domain_of("c")).collect())
    assert 40 < sum(r.canonical for r in short.collect()) < 1500


def test_agent_rules_by_byte_search_equal_the_patterns(spark):
    import random
    from viewstar.functions.useragent import BROWSER_RULES, OS_RULES, matches
    rng = random.Random(5)
    words = ["Googlebot", "bot", "Bot;", "robots", "bingbot", "Crawler", "spider ", "FBAV/", "EdgA/", "Edg/1", "Edge/1", "Edg/", "Mobile", " Mobile", "OPR/2", "Opera", "Opera Mobi", "Chrome/1.2", "Chrome/", "Chromium/",
             "; wv)", "Version/1.0 ", "Android", "iPhone", "iPad", "AppleWebKit/", "Safari/", "Firefox/", "MSIE 8", "Trident/", "Windows", "Windows Phone", "Mac OS X", " ", ";", "x", "Linux", "CrOS", "IEMobile"]
    agents = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(0, 7))) for _ in range(1500)]
    df = spark.createDataFrame([(a,) for a in agents], "a string")
    rules = [p for p, _ in BROWSER_RULES + OS_RULES]
    wrong = [F.count_if(matches(F.col("a"), p) != F.col("a").rlike(p)).alias(f"r{i}") for i, p in enumerate(rules)]
    assert set(df.agg(*wrong).first()) == {0}
