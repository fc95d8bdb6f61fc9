"""DuckDB SQL text for the oracle.  Views `events` and `pages` (and the
other driver tables) are registered by the caller.

Written from the specification, not generated from the Spark plans: the
adapter, cleaning, star schema and reports are re-stated here in SQL.
"""

from __future__ import annotations

from viewstar.sources.fixtures import USER_AGENTS

# Expected values, written by hand: nothing here comes from the code under test.
# Browser and operating system of the adapter's user agents, in their order.
UA_FAMILIES = [("Chrome", "Windows"), ("Firefox", "Ubuntu"), ("Safari", "Mac OS X"), ("Mobile Safari", "iOS"),
               ("Chrome Mobile", "Android"), ("Edge", "Windows"), ("Samsung Internet", "Android"), ("Other", "Other")]
# Countries that the adapter's and the test tables' domains can end in.
EXPECTED_COUNTRIES = {"uk": "United Kingdom", "fr": "France", "de": "Germany", "es": "Spain"}
PATH_SAFE = "/:@&+$,;="
QUERY_SAFE = "=&?/:@+,$;"
PARAM_SCHEMES = ["", "http", "https", "ftp", "hdl", "imap", "mms", "prospero", "rtsp", "rtspu", "sftp", "shttp", "sip", "sips", "tel"]
NETLOC_SCHEMES = ["", "http", "https", "file", "ftp", "git", "git+ssh", "gopher", "imap", "mms", "nfs", "nntp", "prospero", "rsync",
                  "rtsp", "rtspu", "sftp", "shttp", "snews", "svn", "svn+ssh", "telnet", "wais", "ws", "wss"]
# One of / ? # @ : once normalised.
SPLITTING = "⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _ua_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} % 9 = {i} THEN {_q(u)}" for i, u in enumerate(USER_AGENTS))
    return f"CASE {whens} END"


def family_case(col: str, which: int) -> str:
    """The expected browser (0) or operating system (1) of the adapter's user agents."""
    whens = " ".join(f"WHEN {col} = {_q(u)} THEN {_q(f[which])}" for u, f in zip(USER_AGENTS, UA_FAMILIES))
    return f"CASE WHEN {col} IS NULL THEN NULL {whens} ELSE 'no such user agent' END"


def quote_sql(x: str, safe: str) -> str:
    e = f"url_encode(url_decode({x}))"
    for ch in safe:
        e = f"replace({e}, '%{ord(ch):02X}', {_q(ch)})"
    return e


SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def clean_url_sql(u: str) -> str:
    """clean_url as one scalar SQL expression (regexp_extract parts,
    url_decode/url_encode, safe characters restored)."""
    s = f"NULLIF(trim(regexp_replace({u}, '[\\t\\r\\n]', '', 'g')), '')"
    scheme_raw = f"lower(regexp_extract({s}, '{SCHEME_RE}', 1))"
    rest = f"regexp_replace({s}, '{SCHEME_RE}', '')"
    netloc = f"lower(regexp_extract({rest}, '^//([^/?#]*)', 1))"
    path0 = f"regexp_extract({rest}, '^(//[^/?#]*)?([^?#]*)', 2)"
    query = f"regexp_extract({rest}, '^(//[^/?#]*)?[^?#]*\\?([^#]*)', 2)"
    path = (f"CASE WHEN {scheme_raw} IN {_in_list(PARAM_SCHEMES)} "
            f"THEN regexp_replace({path0}, '^((?:.*/)?[^/;]*);[^/]*$', '\\1') ELSE {path0} END")
    scheme = f"CASE WHEN {scheme_raw} = '' THEN 'http' ELSE {scheme_raw} END"
    epath = quote_sql(path, PATH_SAFE)
    equery = quote_sql(query, QUERY_SAFE)
    body = (f"CASE WHEN {netloc} <> '' OR ({scheme} IN {_in_list(NETLOC_SCHEMES)} AND NOT starts_with({epath}, '//')) "
            f"THEN '//' || {netloc} || CASE WHEN {epath} <> '' AND NOT starts_with({epath}, '/') THEN '/' || {epath} ELSE {epath} END "
            f"ELSE {epath} END")
    url = f"{scheme} || ':' || {body} || CASE WHEN {equery} <> '' THEN '?' || {equery} ELSE '' END"
    bad = f"((strpos({netloc}, '[') > 0) <> (strpos({netloc}, ']') > 0) OR regexp_matches({netloc}, '[{SPLITTING}]'))"
    return f"CASE WHEN {s} IS NULL OR {bad} THEN NULL ELSE regexp_replace({url}, '/$', '') END"


def domain_sql(u: str) -> str:
    rest = f"regexp_replace({u}, '{SCHEME_RE}', '')"
    netloc = f"lower(regexp_extract({rest}, '^//([^/?#]*)', 1))"
    return f"NULLIF({netloc}, '')"


def country_code_sql(d: str) -> str:
    last = f"regexp_extract(lower(trim({d})), '([^.]+)[.]*$', 1)"
    return f"CASE WHEN regexp_matches({last}, '^\\p{{L}}{{2}}$') THEN upper({last}) END"


COUNTRY_VALUES = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in EXPECTED_COUNTRIES.items())

# ---------------------------------------------------------------- adapter
CLICKS_CTE = f"""
pg AS (SELECT page_id, url FROM pages),
pn AS (SELECT count(*) AS n FROM pg),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type,
         TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         e.event_id % (SELECT n FROM pn) AS cur_page,
         (e.event_id * 7 + 3) % (SELECT n FROM pn) AS ref_page
  FROM events e),
ej AS (
  SELECT ev.*, p.url AS cur_url, r.url AS ref_url,
         regexp_extract(p.url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*/([^/?#]*)', 1) AS lang
  FROM ev JOIN pg p ON p.page_id = ev.cur_page JOIN pg r ON r.page_id = ev.ref_page),
clicks1 AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN '  ' ELSE 'ev-' || CAST(event_id AS VARCHAR) END AS id,
    CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE epoch_us(ts) // 1000 END AS time_stamp,
    CASE WHEN user_id % 7 <> 0 THEN '10.0.' || CAST(user_id % 4 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) END AS ip,
    {_ua_case('user_id')} AS user_agent,
    '1920x1080' AS resolution,
    'dev-' || CAST(user_id AS VARCHAR) AS device_id,
    '1.0' AS api_version,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(user_id % 9 AS VARCHAR) END AS store_id,
    CASE WHEN event_id % 89 = 0 THEN 'bad-time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS local_time,
    event_id % 2 = 0 AS show_recommendation,
    regexp_replace(cur_url, '\\.example\\.(com|net|org)/',
      '.example.' || CASE WHEN lang IN ('fr', 'de', 'es') THEN lang
                          WHEN cur_page % 3 = 0 THEN 'uk' WHEN cur_page % 3 = 1 THEN 'com' ELSE 'eu' END || '/') AS current_url,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '' ELSE ref_url || '/' END AS referrer_url,
    CASE WHEN user_id % 4 = 0 THEN NULL
         WHEN user_id % 4 = 1 THEN ' User' || CAST(user_id AS VARCHAR) || '@Example.com '
         ELSE 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS email,
    CASE WHEN event_type = 'view' THEN ' View_Product_Detail ' ELSE event_type END AS collection,
    CASE WHEN event_id % 11 = 0 THEN ' ' ELSE CAST(k % 25 AS VARCHAR) END AS product_id,
    CASE k % 4 WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END
               WHEN 1 THEN NULL WHEN 2 THEN 1 ELSE 2 END AS n_options,
    CASE k % 4 WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE '' END
               WHEN 1 THEN NULL WHEN 2 THEN CAST(k % 3 AS VARCHAR) ELSE '' END AS opt_id,
    CASE k % 4 WHEN 0 THEN CASE WHEN event_id % 2 = 0 THEN NULL ELSE '' END
               WHEN 1 THEN NULL WHEN 2 THEN 'diamond' ELSE 'x' END AS opt_label
  FROM ej),
clicks AS (
  SELECT * FROM clicks1 UNION ALL SELECT * FROM clicks1 WHERE event_id % 10 = 0)
"""

# --------------------------------------------------------------- cleaning
CLEAN_CTE = f"""
norm AS (
  SELECT NULLIF(trim(id), '') AS id, time_stamp, NULLIF(trim(ip), '') AS ip,
         NULLIF(trim(user_agent), '') AS user_agent, resolution,
         NULLIF(trim(device_id), '') AS device_id, NULLIF(trim(api_version), '') AS api_version,
         NULLIF(trim(store_id), '') AS store_id, NULLIF(trim(local_time), '') AS local_time,
         show_recommendation,
         NULLIF(trim(current_url), '') AS current_url0, NULLIF(trim(referrer_url), '') AS referrer_url0,
         NULLIF(trim(email), '') AS email, lower(NULLIF(trim(collection), '')) AS collection,
         NULLIF(trim(product_id), '') AS product_id, n_options, opt_id, opt_label
  FROM clicks),
timed AS (
  SELECT *,
    try_strptime(local_time, '%Y-%m-%d %H:%M:%S') AS local_ts,
    CASE WHEN time_stamp > 1000000000000 THEN make_timestamp(time_stamp * 1000)
         ELSE make_timestamp(time_stamp * 1000000) END AS event_ts
  FROM norm),
urls AS (
  SELECT *, {clean_url_sql('current_url0')} AS current_url, {clean_url_sql('referrer_url0')} AS referrer_url
  FROM timed),
cleaned AS (
  SELECT *,
    {domain_sql('current_url')} AS current_domain,
    {domain_sql('referrer_url')} AS referrer_domain,
    {family_case('user_agent', 0)} AS browser,
    CAST(event_ts AS DATE) AS event_date,
    CAST(hour(event_ts) AS INTEGER) AS event_hour
  FROM urls
  WHERE id IS NOT NULL AND current_url IS NOT NULL AND local_ts IS NOT NULL AND event_ts IS NOT NULL),
countries(tld, name) AS (VALUES {COUNTRY_VALUES}),
base0 AS (
  SELECT c.*, strftime(event_date, '%Y%m%d') AS date_key,
         {country_code_sql('current_domain')} AS country_code
  FROM cleaned c),
base AS (
  SELECT b.*,
    CASE WHEN product_id IS NOT NULL THEN
      sha256(product_id || '||' || COALESCE(opt_id, '') || '||' || COALESCE(opt_label, '')) END AS product_key,
    CASE WHEN email IS NOT NULL THEN sha256(lower(email)) END AS customer_key,
    COALESCE(ct.name, b.country_code) AS country,
    CASE WHEN ip IS NOT NULL OR b.country_code IS NOT NULL THEN
      sha256(COALESCE(ip, '') || '||' || COALESCE(b.country_code, '')) END AS location_key,
    id AS event_key
  FROM base0 b LEFT JOIN countries ct ON ct.tld = lower(b.country_code)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_ts, local_ts) = 1)
"""

# ------------------------------------------------------------ star schema
STAR_CTE = """
dim_date AS (
  SELECT DISTINCT date_key, event_date AS date,
    CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
    CAST(month(event_date) AS INTEGER) AS month, monthname(event_date) AS month_name,
    CAST(weekofyear(event_date) AS INTEGER) AS week_of_year, CAST(day(event_date) AS INTEGER) AS day,
    CAST(dayofweek(event_date) + 1 AS INTEGER) AS day_of_week, dayname(event_date) AS day_name,
    dayofweek(event_date) IN (0, 6) AS is_weekend
  FROM base WHERE date_key IS NOT NULL AND event_date IS NOT NULL),
dim_product AS (
  SELECT product_key, product_id, max(NULLIF(opt_id, '')) AS option_id,
         max(NULLIF(opt_label, '')) AS option_label, min(event_date) AS valid_from,
         CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
  FROM base WHERE product_key IS NOT NULL GROUP BY product_key, product_id),
dim_location AS (
  SELECT DISTINCT location_key, ip, country, country_code,
    CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS postal_code,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    CAST(NULL AS VARCHAR) AS timezone, CAST(NULL AS VARCHAR) AS isp
  FROM base WHERE location_key IS NOT NULL),
dim_customer AS (
  SELECT DISTINCT customer_key, lower(email) AS email FROM base WHERE customer_key IS NOT NULL),
fact AS (
  SELECT date_key, product_key, event_key, id AS event_id, event_ts AS event_timestamp, ip, device_id,
         user_agent, browser, resolution, api_version, location_key, store_id, local_time, collection,
         current_url, referrer_url, show_recommendation, 1 AS event_count, customer_key
  FROM base WHERE event_key IS NOT NULL)
"""

REPORT_CTE = """
views AS (SELECT * FROM fact WHERE collection = 'view_product_detail'),
newest AS (SELECT max(d.date) AS date FROM views v JOIN dim_date d ON d.date_key = v.date_key),
day AS (
  SELECT v.* FROM views v JOIN dim_date d ON d.date_key = v.date_key
  WHERE d.date = (SELECT date FROM newest)),
rep AS (
  SELECT day.*, dp.product_id AS dp_product_id, dl.country AS dl_country
  FROM day LEFT JOIN dim_product dp ON dp.product_key = day.product_key
           LEFT JOIN dim_location dl ON dl.location_key = day.location_key)
"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + body


def on_clicks(body: str) -> str:
    return with_ctes(CLICKS_CTE, body=body)


def on_clean(body: str) -> str:
    return with_ctes(CLICKS_CTE, CLEAN_CTE, body=body)


def on_star(body: str) -> str:
    return with_ctes(CLICKS_CTE, CLEAN_CTE, STAR_CTE, body=body)


def on_reports(body: str) -> str:
    return with_ctes(CLICKS_CTE, CLEAN_CTE, STAR_CTE, REPORT_CTE, body=body)
