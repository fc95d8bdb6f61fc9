"""DuckDB twins of the registered queries (see viewstar.catalog)."""

from __future__ import annotations

from viewstar.oracle.duck import (
    clean_url_sql, domain_sql, on_clean, on_clicks, on_reports, on_star, family_case, with_ctes,
    CLICKS_CTE, CLEAN_CTE, STAR_CTE,
)

A_LAST = "DATE '2024-01-20'"
B_FIRST = "DATE '2024-01-15'"

# Spans of dates that the streaming proofs deliver one after the other.
PART = "CASE WHEN event_date <= DATE '2024-01-10' THEN 1 WHEN event_date <= DATE '2024-01-20' THEN 2 ELSE 3 END"

RAW_FLAT = ("id, time_stamp, ip, user_agent, resolution, device_id, api_version, store_id, local_time, "
            "show_recommendation, current_url, referrer_url, email, collection, product_id, "
            "n_options, opt_id, opt_label")

PAGE_URLS = """
pu AS (
  SELECT page_id, url, url || '/' AS u_slash,
         upper(substr(url, 1, 8)) || substr(url, 9) || ';p=1' AS u_params,
         url || '/x y%zz+*~é%26/' AS u_escape
  FROM pages)
"""


def _report_ua(col: str, which: int) -> str:
    return f"COALESCE({family_case(f'NULLIF({col}, {chr(39) * 2})', which)}, 'Unknown')"


def _dim_product(src: str) -> str:
    return f"""
  SELECT product_key, product_id, max(NULLIF(opt_id, '')) AS option_id,
         max(NULLIF(opt_label, '')) AS option_label, min(event_date) AS valid_from,
         CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
  FROM {src} WHERE product_key IS NOT NULL GROUP BY product_key, product_id"""


def _dim_customer(src: str) -> str:
    return f"SELECT DISTINCT customer_key, lower(email) AS email FROM {src} WHERE customer_key IS NOT NULL"


BATCHES = f"""
ba AS (SELECT * FROM base WHERE event_date <= {A_LAST}),
bb AS (SELECT * FROM base WHERE event_date >= {B_FIRST})
"""


# Keys and NOT NULL columns, written by hand from the specification.
KEYS = {"dim_date": "date_key", "dim_product": "product_key", "dim_location": "location_key",
        "dim_customer": "customer_key", "fact_log_event": "event_key"}
NOT_NULL = {"dim_date": ["date", "year", "quarter", "month", "month_name", "week_of_year", "day", "day_of_week", "day_name", "is_weekend"],
            "dim_product": ["product_id", "is_current"], "fact_log_event": ["event_count", "ingestion_timestamp"]}
VIEWS = {**{name: name for name in KEYS}, "fact_log_event": "timed_fact"}
#: The proofs' facts carry one load time.
TIMED_FACT = "timed_fact AS (SELECT *, TIMESTAMP '2024-02-01' AS ingestion_timestamp FROM fact)"


def _audit_sql(views: dict[str, str] = VIEWS) -> str:
    rows = []
    for name, key in KEYS.items():
        for c in [key] + NOT_NULL.get(name, []):
            rows.append(f"SELECT '{name}' AS table_name, 'not_null:{c}' AS rule, "
                        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {views[name]}")
        rows.append(f"SELECT '{name}', 'primary_key:{key}', CAST(count(*) AS BIGINT) FROM "
                    f"(SELECT {key} FROM {views[name]} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    rows.append("SELECT 'fact_log_event', 'check:event_count>=0', "
                f"CAST(count(*) FILTER (WHERE event_count < 0) AS BIGINT) FROM {views['fact_log_event']}")
    rows.append("SELECT 'dim_date', 'unique:date', CAST(count(*) AS BIGINT) FROM "
                f"(SELECT date FROM {views['dim_date']} WHERE date IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    for dim in ("dim_date", "dim_product", "dim_location", "dim_customer"):
        fk = KEYS[dim]
        rows.append(f"SELECT 'fact_log_event', 'foreign_key:{fk}', CAST(count(*) AS BIGINT) FROM {views['fact_log_event']} f "
                    f"WHERE f.{fk} IS NOT NULL AND f.{fk} NOT IN (SELECT {fk} FROM {views[dim]} WHERE {fk} IS NOT NULL)")
    return "\nUNION ALL\n".join(rows)


def _planted(view: str, table: str, column: str, twice: str, nulls: str, more: str = "") -> str:
    return (f"{view} AS (SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE regexp_matches({column}, '{twice}')"
            f" UNION ALL SELECT n.* FROM (SELECT COLUMNS(*) FROM {table} WHERE FALSE) n RIGHT JOIN {table} t ON FALSE WHERE regexp_matches(t.{column}, '{nulls}'){more})")


PLANTED = ", ".join([
    TIMED_FACT,
    _planted("p_date", "dim_date", "date_key", "3$", "4$"), _planted("p_product", "dim_product", "product_id", "3$", "4$"),
    _planted("p_location", "dim_location", "ip", "3$", "4$"), _planted("p_customer", "dim_customer", "email", "3@", "4@"),
    _planted("p_fact", "timed_fact", "store_id", "3$", "4$", """
      UNION ALL SELECT * REPLACE ('neg-' || event_key AS event_key, -1 AS event_count) FROM timed_fact WHERE store_id = '5'
      UNION ALL SELECT * REPLACE ('fk-' || event_key AS event_key, 'nowhere' AS date_key, 'nowhere' AS product_key,
                                  'nowhere' AS location_key, 'nowhere' AS customer_key) FROM timed_fact WHERE store_id = '6'""")])
PLANTED_VIEWS = {"dim_date": "p_date", "dim_product": "p_product", "dim_location": "p_location", "dim_customer": "p_customer", "fact_log_event": "p_fact"}


_HOURS = "(SELECT CAST(h AS INTEGER) AS event_hour FROM range(24) t(h))"

_BROWSER_OS = f"""
SELECT CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
       {_report_ua("COALESCE(user_agent, '')", 0)} AS browser,
       {_report_ua("COALESCE(user_agent, '')", 1)} AS os,
       CAST(sum(event_count) AS BIGINT) AS views
FROM rep GROUP BY 1, 2, 3"""


def _zero_fill(cat: str) -> str:
    return f"""
SELECT h.event_hour, c.{cat}, CAST(COALESCE(r.views, 0) AS BIGINT) AS views
FROM {_HOURS} h CROSS JOIN (SELECT DISTINCT {cat} FROM bo) c
LEFT JOIN (SELECT event_hour, {cat}, sum(views) AS views FROM bo GROUP BY 1, 2) r
  ON r.event_hour = h.event_hour AND r.{cat} = c.{cat}"""


ORACLE: dict[str, str] = {
    "decode_messages": on_clicks(f"""
SELECT {RAW_FLAT} FROM clicks
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM clicks WHERE event_id % 101 = 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""),
    "normalize_text": on_clicks("""
SELECT NULLIF(trim(id), '') AS id, NULLIF(trim(email), '') AS email,
       NULLIF(trim(product_id), '') AS product_id, NULLIF(trim(store_id), '') AS store_id,
       NULLIF(trim(ip), '') AS ip, lower(NULLIF(trim(collection), '')) AS collection
FROM clicks"""),
    "clean_url": with_ctes(PAGE_URLS, body=f"""
SELECT page_id, {clean_url_sql('url')} AS clean_url, {clean_url_sql('u_slash')} AS clean_u_slash,
       {clean_url_sql('u_params')} AS clean_u_params, {clean_url_sql('u_escape')} AS clean_u_escape
FROM pu"""),
    "extract_domain": with_ctes(PAGE_URLS, body=f"""
SELECT page_id, {domain_sql('url')} AS raw_domain, {domain_sql(clean_url_sql('u_params'))} AS clean_domain
FROM pu"""),
    "parse_local_time": on_clicks("""
SELECT local_time, try_strptime(NULLIF(trim(local_time), ''), '%Y-%m-%d %H:%M:%S') AS local_ts FROM clicks"""),
    "epoch_to_ts": on_clicks("""
SELECT time_stamp,
       CASE WHEN time_stamp > 1000000000000 THEN make_timestamp(time_stamp * 1000)
            ELSE make_timestamp(time_stamp * 1000000) END AS event_ts
FROM clicks"""),
    "event_parts": on_clean("SELECT id, event_ts, event_date, event_hour FROM cleaned"),
    "clean_events": on_clean(f"""
SELECT {RAW_FLAT}, local_ts, event_ts, current_domain, referrer_domain, browser, event_date, event_hour
FROM cleaned"""),
    "country_code": on_clean("SELECT DISTINCT current_domain, country_code FROM base0"),
    "country_name": on_clean("SELECT DISTINCT country_code, country FROM base"),
    "classify_ua": on_clean(f"""
SELECT DISTINCT user_agent, browser,
       {_report_ua('user_agent', 0)} AS report_browser,
       {_report_ua('user_agent', 1)} AS report_os
FROM cleaned"""),
    "first_option": on_clicks("SELECT n_options, opt_id, opt_label FROM clicks"),
    "surrogate_keys": on_clean("""
SELECT event_key, date_key, product_key, customer_key, location_key, country_code, country FROM base"""),
    "dim_date": on_star("SELECT * FROM dim_date"),
    "dim_product": on_star("SELECT * FROM dim_product"),
    "dim_location": on_star("SELECT * FROM dim_location"),
    "dim_customer": on_star("SELECT * FROM dim_customer"),
    "fact_log_event": on_star("SELECT * FROM fact"),
    "star_join": on_star("""
SELECT f.event_key, d.date, p.product_id, p.option_id, l.country
FROM fact f JOIN dim_date d ON d.date_key = f.date_key
LEFT JOIN dim_product p ON p.product_key = f.product_key
LEFT JOIN dim_location l ON l.location_key = f.location_key"""),
    "top_products": on_reports("""
SELECT dp_product_id AS product_id, CAST(sum(event_count) AS BIGINT) AS views
FROM rep WHERE dp_product_id IS NOT NULL GROUP BY dp_product_id
ORDER BY views DESC, product_id LIMIT 10"""),
    "top_countries": on_reports("""
SELECT COALESCE(NULLIF(dl_country, ''), 'Unknown') AS country, CAST(sum(event_count) AS BIGINT) AS views
FROM rep GROUP BY COALESCE(NULLIF(dl_country, ''), 'Unknown')
ORDER BY views DESC, country LIMIT 10"""),
    "top_referrers": on_reports("""
SELECT referrer_url, CAST(sum(event_count) AS BIGINT) AS views
FROM rep WHERE NULLIF(referrer_url, '') IS NOT NULL GROUP BY referrer_url
ORDER BY views DESC, referrer_url LIMIT 5"""),
    "store_views_by_country": on_reports("""
SELECT COALESCE(NULLIF(store_id, ''), 'Unknown') AS store_id, CAST(sum(event_count) AS BIGINT) AS views
FROM rep WHERE COALESCE(NULLIF(dl_country, ''), 'Unknown') = 'United Kingdom'
GROUP BY COALESCE(NULLIF(store_id, ''), 'Unknown')
ORDER BY views DESC, store_id"""),
    "product_hourly": on_reports(f"""
SELECT h.event_hour, CAST(COALESCE(r.views, 0) AS BIGINT) AS views
FROM {_HOURS} h LEFT JOIN (
  SELECT CAST(hour(event_timestamp) AS INTEGER) AS event_hour, sum(event_count) AS views
  FROM rep WHERE dp_product_id = '7' GROUP BY 1) r ON r.event_hour = h.event_hour
ORDER BY h.event_hour"""),
    "browser_os_hourly": on_reports(_BROWSER_OS),
    "browser_hourly": on_reports("").rstrip() + f",\nbo AS ({_BROWSER_OS})\n{_zero_fill('browser')}",
    "os_hourly": on_reports("").rstrip() + f",\nbo AS ({_BROWSER_OS})\n{_zero_fill('os')}",
    "summary_metrics": on_reports("""
SELECT CAST(COALESCE(sum(event_count), 0) AS BIGINT) AS total_views,
       count(DISTINCT dp_product_id) AS unique_products,
       count(DISTINCT dl_country) AS unique_countries,
       count(DISTINCT NULLIF(referrer_url, '')) AS unique_referrers
FROM rep"""),
    "available_dates": on_reports("""
SELECT d.date FROM views v JOIN dim_date d ON d.date_key = v.date_key GROUP BY d.date ORDER BY d.date DESC"""),
    "country_options": on_reports("""
SELECT COALESCE(NULLIF(dl_country, ''), 'Unknown') AS country, CAST(sum(event_count) AS BIGINT) AS views
FROM rep GROUP BY COALESCE(NULLIF(dl_country, ''), 'Unknown') ORDER BY views DESC, country"""),
    "product_options": on_reports("""
SELECT dp_product_id AS product_id, CAST(sum(event_count) AS BIGINT) AS views
FROM rep WHERE dp_product_id IS NOT NULL GROUP BY dp_product_id ORDER BY views DESC, product_id"""),
    "merge_insert_absent": with_ctes(CLICKS_CTE, CLEAN_CTE, BATCHES,
                                     f"dpa AS ({_dim_product('ba')})", f"dpb AS ({_dim_product('bb')})", body="""
SELECT * FROM dpa
UNION ALL
SELECT * FROM dpb WHERE product_key NOT IN (SELECT product_key FROM dpa)"""),
    "merge_coalesce_update": with_ctes(CLICKS_CTE, CLEAN_CTE, BATCHES,
                                       f"ca AS (SELECT customer_key, CAST(NULL AS VARCHAR) AS email FROM ({_dim_customer('ba')}))",
                                       f"cb AS ({_dim_customer('bb')})", body="""
SELECT COALESCE(o.customer_key, n.customer_key) AS customer_key,
       CASE WHEN o.customer_key IS NOT NULL THEN COALESCE(n.email, o.email) ELSE n.email END AS email
FROM ca o FULL OUTER JOIN cb n ON o.customer_key = n.customer_key"""),
    "evolve_schema": on_star(f"""
SELECT event_key, CAST(NULL AS VARCHAR) AS browser FROM base WHERE event_date <= {A_LAST}
UNION ALL
SELECT event_key, browser FROM base WHERE event_date >= {B_FIRST} AND event_date > {A_LAST}"""),
    "new_browsers": on_star("""
SELECT DISTINCT browser FROM fact WHERE browser IS NOT NULL
EXCEPT
SELECT browser FROM fact WHERE store_id IN ('0', '1')"""),
    "constraint_audit": with_ctes(CLICKS_CTE, CLEAN_CTE, STAR_CTE, TIMED_FACT, body=_audit_sql()),
    "constraint_audit_planted": with_ctes(CLICKS_CTE, CLEAN_CTE, STAR_CTE, PLANTED, body=_audit_sql(PLANTED_VIEWS)),
    "new_browsers_by_batch": on_star("""
SELECT browser, CAST(CASE WHEN max(CASE WHEN store_id IN ('0', '1') THEN 1 ELSE 0 END) = 1 THEN 0 ELSE 1 END AS INTEGER) AS batch
FROM fact WHERE browser IS NOT NULL GROUP BY browser"""),
    "duplicate_events": on_clean("""
SELECT event_key, CAST(2 AS BIGINT) AS copies, date_key AS first_day, strftime(event_date + INTERVAL 20 DAY, '%Y%m%d') AS last_day
FROM base WHERE event_date <= DATE '2024-01-05' AND id LIKE '%7'"""),
    "evolve_warehouse": on_clean(f"""
SELECT event_key, CASE WHEN event_date > {A_LAST} THEN browser END AS browser, CAST(1 AS INTEGER) AS event_count FROM base"""),
    "evolve_customers": on_clean(f"""
SELECT customer_key, max(CASE WHEN event_date >= {B_FIRST} THEN lower(email) END) AS email FROM base WHERE customer_key IS NOT NULL GROUP BY 1"""),
    "stream_dedup": on_clean(f"""
SELECT {RAW_FLAT}, local_ts, event_ts, current_domain, referrer_domain, browser, event_date, event_hour
FROM cleaned QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_ts) = 1"""),
    "batch_monitor": on_clean(f"""
SELECT CAST(part AS INTEGER) AS part, CAST(count(*) AS BIGINT) AS rows, string_agg(id, ',' ORDER BY id) FILTER (WHERE r <= 5) AS sample_ids
FROM (SELECT id, part, row_number() OVER (PARTITION BY part ORDER BY md5(id)) AS r
      FROM (SELECT DISTINCT id, {PART} AS part FROM cleaned)) GROUP BY part"""),
    # new ids of 3 January are late, ids of 2 January have expired, rows of 20 January are still known
    "stream_late_rows": on_clean(f"""
SELECT CAST(part AS INTEGER) AS trigger, CAST(count(DISTINCT id) AS BIGINT) AS rows_out, CAST(0 AS BIGINT) AS late_dropped
FROM (SELECT id, {PART} AS part FROM cleaned) WHERE part < 3 GROUP BY part
UNION ALL
SELECT 3, CAST(count(DISTINCT id) FILTER (WHERE event_date = DATE '2024-01-02') AS BIGINT),
       CAST(count(*) FILTER (WHERE event_date = DATE '2024-01-03') AS BIGINT) FROM cleaned"""),
    "stream_timed_trigger": on_clean(f"""
SELECT CAST({PART} AS INTEGER) AS part, CAST(count(DISTINCT id) AS BIGINT) AS events, TRUE AS several_batches FROM cleaned GROUP BY 1"""),
    "loader_final_state": on_star("SELECT * FROM fact"),
    "loader_dim_location": on_star("SELECT * FROM dim_location"),
    "loader_dim_customer": on_star("SELECT * FROM dim_customer"),
    "ledger_replay": on_star("SELECT date_key, count(*) AS events FROM fact GROUP BY date_key"),
    "ledger_two_queries": on_star(f"""
SELECT q.query_name, q.status, CAST(count(*) FILTER (WHERE q.later OR CAST(strptime(date_key, '%Y%m%d') AS DATE) <= {A_LAST}) AS BIGINT) AS events_after
FROM fact, (VALUES ('daily', 'committed', FALSE), ('backfill', 'committed', TRUE), ('daily', 'already-loaded', TRUE),
                   ('backfill', 'already-loaded', TRUE)) AS q(query_name, status, later) GROUP BY 1, 2"""),
    "ledger_statuses": """
SELECT CAST(step AS INTEGER) AS step, CAST(batch_id AS INTEGER) AS batch_id, status, CAST(0 AS BIGINT) AS extra_visible_after_failure
FROM (VALUES (0, 0, 'committed'), (1, 1, 'failed'), (2, 1, 'committed'), (3, 1, 'already-loaded')) AS q(step, batch_id, status)""",
}
ORACLE["stream_file_roundtrip"] = ORACLE["stream_dedup"]
ORACLE["stream_dedup_salted"] = ORACLE["stream_dedup"]
# The loaded warehouse satisfies every constraint, and its ledger key is unique.
ORACLE["loader_constraint_audit"] = with_ctes(CLICKS_CTE, CLEAN_CTE, STAR_CTE, TIMED_FACT, body=_audit_sql() + """
UNION ALL
SELECT 'stream_batch_log', 'primary_key:query_name,run_id,batch_id', CAST(0 AS BIGINT)""")
ORACLE["warehouse_top_products"] = ORACLE["top_products"]
ORACLE["warehouse_summary_metrics"] = ORACLE["summary_metrics"]
ORACLE["warehouse_day_top_countries"] = ORACLE["top_countries"]
ORACLE["warehouse_day_browser_hourly"] = ORACLE["browser_hourly"]
