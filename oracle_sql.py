"""DuckDB oracle SQL for the driver's correctness check.

Written independently of the Spark code: the hit frame is derived in SQL,
URLs are parsed with RE2 patterns, and last touch is an ``ASOF JOIN`` (file
order) or ``last_value(... IGNORE NULLS)`` (time order) instead of the
forward-fill window used on the Spark side.
"""

from __future__ import annotations

TIMEOUT = 21600

_RAW = r"""
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS v
  FROM events
),
raw AS (
  SELECT event_id AS seq,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS hit_time_gmt,
    '10.0.0.' || CAST(user_id % 50 AS VARCHAR) AS ip,
    CASE WHEN event_id % 5 = 0 THEN ' UA ' || CAST(user_id % 7 AS VARCHAR) || ' '
         ELSE 'UA ' || CAST(user_id % 7 AS VARCHAR) END AS user_agent,
    CASE event_type
      WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '1,200' ELSE ' 2 , 1 ' END
      WHEN 'click' THEN '2' WHEN 'view' THEN '12,11' WHEN 'error' THEN '10' ELSE '' END AS event_list,
    CASE
      WHEN event_type = 'purchase' THEN
        CASE k % 10 WHEN 0 THEN 'C;P;1;;' WHEN 1 THEN 'C;P;1;abc;'
          WHEN 2 THEN 'C;P;1;' || v || ';200|201,O;F;4;4.00;205'
          WHEN 3 THEN 'C;P;1;-' || v || ';'
          ELSE 'C;P;1;' || v || ';' END
      WHEN event_type = 'view' THEN 'C;P;1;' || v || ';'
      ELSE '' END AS product_list,
    CASE
      WHEN event_type IN ('signup', 'click') THEN
        CASE k % 12
          WHEN 0 THEN 'http://www.google.com/search?hl=en&q=Shoes'
          WHEN 1 THEN 'http://google.com/search?q=shoes'
          WHEN 2 THEN 'http://www.bing.com/search?q=red+shoes'
          WHEN 3 THEN 'http://search.yahoo.com/search?p=cd%20player'
          WHEN 4 THEN 'http://yahoo.com/?p=Hat'
          WHEN 5 THEN 'http://www.msn.com/search?q=phone'
          WHEN 6 THEN 'http://www.google.com/search?hl=en'
          WHEN 7 THEN 'http://partner.example.org/x'
          WHEN 8 THEN 'http://[bad/'
          WHEN 9 THEN ''
          WHEN 10 THEN 'http://www.google.com/search?q=&q=Second'
          ELSE 'http://www.esshopzilla.com/' END
      WHEN event_type = 'purchase' THEN
        CASE WHEN k % 15 = 14 THEN 'http://www.bing.com/search?q=Same+Hit'
             ELSE 'https://www.esshopzilla.com/checkout/' END
      ELSE 'http://www.esshopzilla.com/cart/' END AS referrer
  FROM ev
)"""

# URL pieces, RE2 patterns.
_AUTH = r"'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)'"
_HAS_AUTH = r"'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//'"
_QUERY = r"'^[^?#]*\?([^#]*)'"
_BRACKET_IP = r"'^(?:.*@)?\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\](?::[^\[\]]*)?$'"


def url_parts(src: str, col: str) -> str:
    """CTE body adding auth / hostname / engine host / query for ``col`` of ``src``."""
    return f"""
  SELECT *,
    CASE WHEN regexp_matches({col}, {_HAS_AUTH}) THEN regexp_extract({col}, {_AUTH}, 1) END AS auth,
    regexp_extract({col}, {_QUERY}, 1) AS query,
    CASE WHEN (strpos(regexp_extract({col}, {_AUTH}, 1), '[') > 0)
              = (strpos(regexp_extract({col}, {_AUTH}, 1), ']') > 0) THEN
      nullif(lower(regexp_extract(regexp_extract(
        CASE WHEN regexp_matches({col}, {_HAS_AUTH}) THEN regexp_extract({col}, {_AUTH}, 1) END,
        '([^@]*)$', 1), '^([^:]*)', 1)), '') END AS hostname
  FROM {src}"""


_NORM = r"""
norm AS (
  SELECT seq, trim(ip) AS ip, trim(user_agent) AS user_agent, trim(referrer) AS referrer,
         trim(event_list) AS event_list, trim(product_list) AS product_list,
         COALESCE(TRY_CAST(trim(hit_time_gmt) AS BIGINT), 0) AS hit_time,
         trim(hit_time_gmt) = '' AS time_blank,
         trim(hit_time_gmt) <> '' AND TRY_CAST(trim(hit_time_gmt) AS BIGINT) IS NULL AS time_bad
  FROM raw
),
urls AS (""" + url_parts("norm", "referrer") + r"""
),
eng AS (
  SELECT *,
    CASE
      WHEN h = 'google.com' OR h LIKE '%.google.com' THEN 'google.com'
      WHEN h = 'bing.com' OR h LIKE '%.bing.com' THEN 'bing.com'
      WHEN h = 'search.yahoo.com' OR h LIKE '%.search.yahoo.com' THEN 'yahoo.com'
      WHEN h = 'yahoo.com' OR h LIKE '%.yahoo.com' THEN 'yahoo.com'
      WHEN h = 'msn.com' OR h LIKE '%.msn.com' THEN 'msn.com' END AS engine,
    CASE
      WHEN h = 'google.com' OR h LIKE '%.google.com' THEN 'q'
      WHEN h = 'bing.com' OR h LIKE '%.bing.com' THEN 'q'
      WHEN h = 'search.yahoo.com' OR h LIKE '%.search.yahoo.com' THEN 'p'
      WHEN h = 'yahoo.com' OR h LIKE '%.yahoo.com' THEN 'p'
      WHEN h = 'msn.com' OR h LIKE '%.msn.com' THEN 'q' END AS param
  FROM (SELECT *, regexp_replace(hostname, '^www[.]', '') AS h FROM urls)
),
kw AS (
  SELECT *,
    trim(url_decode(replace(
      substr(pick, strpos(pick, '=') + 1), '+', ' '))) AS kw_text
  FROM (
    SELECT *,
      list_filter(string_split(query, '&'),
        lambda p: strpos(p, '=') > 0
          AND url_decode(replace(split_part(p, '=', 1), '+', ' ')) = param
          AND strpos(p, '=') < length(p))[1] AS pick
    FROM eng)
),
parsed AS (
  SELECT seq, ip, user_agent, referrer, event_list, product_list, hit_time, time_blank, time_bad,
    hostname, auth,
    CASE WHEN engine IS NOT NULL AND kw_text <> '' THEN engine END AS domain,
    CASE WHEN engine IS NOT NULL AND kw_text <> '' THEN kw_text END AS keyword,
    list_contains(list_transform(string_split(event_list, ','), lambda e: trim(e)), '1') AS is_purchase,
    CASE WHEN list_contains(list_transform(string_split(event_list, ','), lambda e: trim(e)), '1')
      THEN CAST(list_sum(list_transform(string_split(product_list, ','),
             lambda p: COALESCE(TRY_CAST(trim(string_split(p, ';')[4]) AS DECIMAL(28,10)), 0)))
           AS DECIMAL(38,10))
      ELSE CAST(0 AS DECIMAL(38,10)) END AS revenue
  FROM kw
),
classed AS (
  SELECT *,
    CASE
      WHEN keyword IS NOT NULL THEN 'search'
      WHEN referrer = '' THEN 'none'
      WHEN (strpos(auth, '[') > 0) <> (strpos(auth, ']') > 0)
        OR (strpos(regexp_extract(auth, '([^@]*)$', 1), '[') > 0
            AND NOT regexp_matches(auth, """ + _BRACKET_IP + r""")) THEN 'malformed'
      WHEN hostname IS NULL THEN 'hostless'
      WHEN hostname LIKE '%esshopzilla.com' THEN 'internal'
      ELSE 'unknown_external' END AS referrer_class
  FROM parsed
)"""

# Referrers of every odd kind in turn; the class names the characters whose
# compatibility form holds a URL delimiter.
_REFERRER_RULES = r"""
WITH odd AS (
  SELECT event_id AS seq, CASE event_id % 12
      WHEN 0 THEN 'http://user:pw@www.google.com:8080/search?q=' || event_id
      WHEN 1 THEN 'HTTPS://WWW.Bing.COM:443/search?q=' || event_id || '&q=Second'
      WHEN 2 THEN 'mailto:buyer' || event_id || '@example.org'
      WHEN 3 THEN 'http://shop℀.example.org/' || event_id
      WHEN 4 THEN 'http://example.org：80/' || event_id
      WHEN 5 THEN 'http://www.esshopzilla.com/' || event_id
      WHEN 6 THEN 'http://[::1]:80/' || event_id
      WHEN 7 THEN 'http://[fe80::1/' || event_id
      WHEN 8 THEN '//partner.example.org/' || event_id
      WHEN 9 THEN '/search?q=' || event_id
      WHEN 10 THEN 'http://café' || event_id || '.example.org/'
      ELSE 'http://msn.com@example.org/?q=' || event_id END AS referrer
  FROM events
),
split AS (
  SELECT seq, regexp_extract(referrer, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS auth,
    string_split(regexp_extract(referrer, '^[^?#]*\?([^#]*)', 1), '&') AS pairs
  FROM odd
),
hosts AS (
  SELECT seq, pairs,
    (strpos(auth, '[') > 0) <> (strpos(auth, ']') > 0)
      OR regexp_matches(auth, '[℀℁℅℆⁇⁈⁉⩴：／＃？＠﹕﹖﹟﹫︓︖]') AS malformed,
    nullif(lower(CASE WHEN auth LIKE '%[%' THEN regexp_extract(auth, '\[([^\]]*)\]', 1)
      ELSE regexp_extract(regexp_extract(auth, '([^@]*)$', 1), '^([^:]*)', 1) END), '') AS host
  FROM split
),
touched AS (
  SELECT seq, malformed, CASE WHEN NOT malformed THEN host END AS ref_host,
    CASE regexp_replace(host, '^www[.]', '') WHEN 'google.com' THEN 'google.com' WHEN 'bing.com' THEN 'bing.com' END AS domain,
    substr(list_filter(pairs, lambda x: starts_with(x, 'q='))[1], 3) AS keyword
  FROM hosts
)
SELECT seq, ref_host, domain, CASE WHEN domain IS NOT NULL THEN keyword END AS keyword,
  CASE WHEN domain IS NOT NULL THEN 'search' WHEN malformed THEN 'malformed' WHEN ref_host IS NULL THEN 'hostless'
    WHEN ref_host LIKE '%esshopzilla.com' THEN 'internal' ELSE 'unknown_external' END AS referrer_class
FROM touched"""

BASE = "WITH " + _RAW + "," + _NORM


def _sessions(order: str, timeout) -> str:
    """CTE ``sess``: parsed hits with gap / new_session / sid in the given order."""
    ob = "seq" if order == "file" else "hit_time, seq"
    if timeout is None:
        brk = "FALSE"
    else:
        brk = f"COALESCE(hit_time - prev_time > {timeout}, FALSE)"
    return f""",
gaps AS (
  SELECT *, LAG(hit_time) OVER (PARTITION BY ip, user_agent ORDER BY {ob}) AS prev_time
  FROM classed
),
brks AS (SELECT *, {brk} AS new_session FROM gaps),
sess AS (
  SELECT *, SUM(CASE WHEN new_session THEN 1 ELSE 0 END) OVER (
      PARTITION BY ip, user_agent ORDER BY {ob}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM brks
)"""


def _live(order: str, timeout) -> str:
    """CTE ``live``: every hit with the session-scoped last touch (ldomain, lkeyword)."""
    s = _sessions(order, timeout)
    if order == "file":
        return s + """,
touches AS (SELECT ip, user_agent, sid, seq, domain, keyword FROM sess WHERE keyword IS NOT NULL),
live AS (
  SELECT h.*, t.domain AS ldomain, t.keyword AS lkeyword
  FROM sess h ASOF LEFT JOIN touches t
    ON h.ip = t.ip AND h.user_agent = t.user_agent AND h.sid = t.sid AND h.seq >= t.seq
)"""
    return s + """,
live AS (
  SELECT *,
    last_value(domain IGNORE NULLS) OVER w AS ldomain,
    last_value(keyword IGNORE NULLS) OVER w AS lkeyword
  FROM sess
  WINDOW w AS (PARTITION BY ip, user_agent, sid ORDER BY hit_time, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def _order_num(order: str) -> str:
    return "seq" if order == "file" else "hit_time * 1000000 + seq"


def _results(order: str, timeout) -> str:
    """CTEs up to ``res`` (the keyword report) after ``live``."""
    return BASE + _live(order, timeout) + f""",
display AS (
  SELECT domain, lower(keyword) AS kl, arg_min(keyword, {_order_num(order)}) AS shown
  FROM classed WHERE keyword IS NOT NULL GROUP BY domain, lower(keyword)
),
credit AS (
  SELECT ldomain AS domain, lower(lkeyword) AS kl, SUM(revenue) AS total
  FROM live WHERE is_purchase AND revenue > 0 AND ldomain IS NOT NULL
  GROUP BY ldomain, lower(lkeyword)
),
res AS (
  SELECT c.domain AS search_engine_domain, d.shown AS search_keyword,
         CAST(round_even(c.total, 2) AS DECIMAL(38,2)) AS revenue
  FROM credit c JOIN display d ON c.domain = d.domain AND c.kl = d.kl
)"""


def keyword_revenue(order: str = "file", timeout=None, ranked: bool = False) -> str:
    rank = (
        ", CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, search_engine_domain, lower(search_keyword)) AS BIGINT) AS rank"
        if ranked else ""
    )
    return _results(order, timeout) + f"\nSELECT *{rank} FROM res"


_ATTR = "is_purchase AND revenue > 0 AND ldomain IS NOT NULL"
_UNATTR = "is_purchase AND revenue > 0 AND ldomain IS NULL"


def quality_metrics(timeout=None) -> str:
    blank = "time_blank" if timeout is not None else "FALSE"
    return BASE + _live("file", timeout) + f"""
SELECT
  CAST(count(*) FILTER (WHERE referrer_class = 'malformed') AS BIGINT) AS malformed_referrers,
  CAST(count(*) FILTER (WHERE is_purchase AND revenue = 0) AS BIGINT) AS purchases_without_revenue,
  CAST(count(*) FILTER (WHERE {_UNATTR}) AS BIGINT) AS unattributed_purchases,
  CAST(count(*) FILTER (WHERE {blank}) AS BIGINT) AS blank_timestamps,
  CAST(count(*) FILTER (WHERE time_bad) AS BIGINT) AS bad_timestamps,
  CAST(count(*) FILTER (WHERE referrer_class = 'unknown_external') AS BIGINT) AS unknown_referrer_domains,
  CAST(count(*) FILTER (WHERE is_purchase) AS BIGINT) AS total_purchase_events,
  CAST(count(*) FILTER (WHERE {_ATTR}) AS BIGINT) AS attributed_purchase_events,
  CAST(COALESCE(sum(revenue) FILTER (WHERE {_ATTR}), 0) AS DECIMAL(38,2)) AS total_revenue_attributed,
  CAST(COALESCE(sum(revenue) FILTER (WHERE {_UNATTR}), 0) AS DECIMAL(38,2)) AS total_revenue_unattributed,
  CAST(count(*) FILTER (WHERE keyword IS NOT NULL) AS BIGINT) AS rows_with_search_referrer
FROM live"""


def run_counts(timeout=None) -> str:
    return _results("file", timeout) + """,
lastrow AS (
  SELECT ip, user_agent, arg_max(ldomain IS NOT NULL, seq) AS lv FROM live GROUP BY ip, user_agent
)
SELECT
  CAST((SELECT count(*) FROM classed) AS BIGINT) AS rows_processed,
  CAST((SELECT count(*) FROM lastrow WHERE lv) AS BIGINT) AS visitors_with_live_touch,
  CAST((SELECT count(*) FROM res) AS BIGINT) AS keyword_groups,
  CAST((SELECT COALESCE(sum(revenue), 0) FROM res) AS DECIMAL(38,2)) AS total_attributed_revenue"""


def run_manifest(timeout=None) -> str:
    return _results("file", timeout) + """,
lastrow AS (
  SELECT ip, user_agent, arg_max(ldomain IS NOT NULL, seq) AS lv FROM live GROUP BY ip, user_agent
)
SELECT 'v1' AS schema_version,
  CAST((SELECT count(*) FROM classed) AS BIGINT) AS rows_processed,
  CAST((SELECT count(*) FROM lastrow WHERE lv) AS BIGINT) AS unique_visitors,
  CAST((SELECT count(*) FROM res) AS BIGINT) AS keyword_groups,
  CAST(CAST((SELECT COALESCE(sum(revenue), 0) FROM res) AS DECIMAL(38,2)) AS VARCHAR) AS total_attributed_revenue,
  CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, search_engine_domain, lower(search_keyword)) AS BIGINT) AS rank,
  search_engine_domain AS domain, search_keyword AS keyword, CAST(revenue AS VARCHAR) AS revenue
FROM res"""


def business_summary(timeout=None) -> str:
    blank = "time_blank" if timeout is not None else "FALSE"
    return _results("file", timeout) + f"""
SELECT
  CAST((SELECT COALESCE(sum(revenue), 0) FROM res) AS DECIMAL(38,2)) AS attributed_revenue,
  CAST((SELECT count(*) FROM res) AS BIGINT) AS keyword_groups,
  CAST(count(*) FILTER (WHERE {_ATTR}) AS BIGINT) AS attributed_purchases,
  CAST(count(*) FILTER (WHERE {_UNATTR}) AS BIGINT) AS unattributed_purchases,
  count(*) FILTER (WHERE referrer_class = 'malformed') > 0 AS warn_malformed_referrers,
  count(*) FILTER (WHERE {blank}) > 0 AS warn_blank_timestamps,
  count(*) FILTER (WHERE is_purchase AND revenue = 0) > 0 AS warn_zero_revenue_purchases,
  CAST(round(100.0 * count(*) FILTER (WHERE keyword IS NOT NULL) / count(*), 4) AS DECIMAL(10,4)) AS search_share_pct
FROM live"""


def purchase_outcomes(timeout=None) -> str:
    return BASE + _live("file", timeout) + """
SELECT CASE WHEN revenue > 0 AND ldomain IS NOT NULL THEN 'attributed'
            WHEN revenue > 0 THEN 'unattributed'
            WHEN revenue = 0 THEN 'no_revenue' ELSE 'negative' END AS outcome,
       CAST(count(*) AS BIGINT) AS purchases,
       CAST(round_even(sum(revenue), 2) AS DECIMAL(38,2)) AS revenue
FROM live WHERE is_purchase GROUP BY 1"""


def _param(query: str, name: str) -> str:
    pick = (f"list_filter(string_split({query}, '&'), lambda p: strpos(p, '=') > 0 "
            f"AND url_decode(replace(split_part(p, '=', 1), '+', ' ')) = '{name}' "
            f"AND strpos(p, '=') < length(p))[1]")
    return f"url_decode(replace(substr({pick}, strpos({pick}, '=') + 1), '+', ' '))"


_PAGES = "WITH pg AS (SELECT page_id, url FROM pages), pu AS (" + url_parts("pg", "url") + ")"
_ENGINE_OF = """CASE
      WHEN h = 'google.com' OR h LIKE '%.google.com' THEN 'google.com'
      WHEN h = 'bing.com' OR h LIKE '%.bing.com' THEN 'bing.com'
      WHEN h = 'search.yahoo.com' OR h LIKE '%.search.yahoo.com' THEN 'yahoo.com'
      WHEN h = 'yahoo.com' OR h LIKE '%.yahoo.com' THEN 'yahoo.com'
      WHEN h = 'msn.com' OR h LIKE '%.msn.com' THEN 'msn.com' END"""

_REVENUE_ALL = ("CAST(list_sum(list_transform(string_split(product_list, ','), "
                "lambda p: COALESCE(TRY_CAST(trim(string_split(p, ';')[4]) AS DECIMAL(28,10)), 0))) "
                "AS DECIMAL(38,2))")


def oracle_queries() -> dict[str, str]:
    t = TIMEOUT
    return {
        "keyword_revenue": keyword_revenue("file", None),
        "keyword_revenue_ranked": keyword_revenue("file", None, ranked=True),
        "keyword_revenue_timeout": keyword_revenue("file", t),
        "keyword_revenue_skew_split": keyword_revenue("file", None),
        "keyword_revenue_skew_split_timeout": keyword_revenue("file", t),
        "last_touch_time_order": keyword_revenue("time", t),
        "last_touch_time_order_no_timeout": keyword_revenue("time", None),
        "keyword_display": BASE + """
SELECT domain AS search_engine_domain, lower(keyword) AS keyword_lower, arg_min(keyword, seq) AS search_keyword
FROM classed WHERE keyword IS NOT NULL GROUP BY 1, 2""",
        "quality_metrics": quality_metrics(None),
        "quality_metrics_timeout": quality_metrics(t),
        "run_counts": run_counts(None),
        "run_counts_timeout": run_counts(t),
        "search_share": BASE + """
SELECT CAST(count(*) AS BIGINT) AS rows_processed,
       CAST(count(*) FILTER (WHERE keyword IS NOT NULL) AS BIGINT) AS search_rows,
       CAST(COALESCE(round(100.0 * count(*) FILTER (WHERE keyword IS NOT NULL) / nullif(count(*), 0), 4), 0)
            AS DECIMAL(10,4)) AS search_share_pct
FROM classed""",
        "referrer_rules": _REFERRER_RULES,
        "stream_keyword_revenue": keyword_revenue("file", None),
        "stream_session_timeout": keyword_revenue("file", t),
        "stream_idle_limit": keyword_revenue("file", t),
        "stream_live_visitors": f"SELECT visitors_with_live_touch FROM ({run_counts(t)})",
        "stream_order_policy": keyword_revenue("time", t),
        "stream_last_touch": BASE + _live("file", None) + """
SELECT seq, ldomain AS search_engine_domain, lkeyword AS search_keyword FROM live WHERE is_purchase""",
        "hit_file_scan": keyword_revenue("file", None),
        "hit_file_scan_gzip_timeout": keyword_revenue("file", t),
        "hit_file_scan_mixed_headers": keyword_revenue("file", None),
        "schema_contract": "WITH " + _RAW + """,
cols AS (SELECT unnest(['hit_time_gmt', 'ip', 'user_agent', 'event_list', 'product_list', 'referrer']) AS column_name)
SELECT column_name, CAST(count(*) AS BIGINT) AS hits
FROM cols, raw WHERE column_name <> 'product_list' OR event_list <> '2' GROUP BY 1""",
        "last_touch_time_order_skew_split": keyword_revenue("time", t),
        "stream_running_totals": keyword_revenue("file", None),
        "stream_running_totals_time_order": keyword_revenue("time", t),
        "stream_chained_totals": keyword_revenue("file", None),
        "stream_hit_files": keyword_revenue("file", None),
        "stream_hit_files_timeout": keyword_revenue("file", t),
        "report_file": _results("file", None) + """
SELECT search_engine_domain, search_keyword, CAST(revenue AS VARCHAR) AS revenue_text,
       CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, search_engine_domain, lower(search_keyword)) AS BIGINT) AS rank
FROM res""",
        "intake_anti_join": """
SELECT CASE event_id % 3 WHEN 1 THEN 'day+0' ELSE 'day%25200' END AS input_name, CAST(count(*) AS BIGINT) AS hits
FROM events WHERE event_id % 3 <> 0 GROUP BY 1""",
        "run_manifest": run_manifest(None),
        "run_manifest_timeout": run_manifest(t),
        "business_summary": business_summary(None),
        "business_summary_timeout": business_summary(t),
        "purchase_outcomes": purchase_outcomes(None),
        "purchase_outcomes_timeout": purchase_outcomes(t),
        "referrer_class": BASE + """
SELECT referrer_class, CAST(count(*) AS BIGINT) AS hits FROM classed GROUP BY 1""",
        "hit_normalize": BASE + """
SELECT seq, ip, user_agent, referrer, event_list, product_list FROM norm""",
        "hit_time_coerce": BASE + """
SELECT seq, hit_time, time_blank, time_bad FROM norm""",
        "visitor_key": BASE + """
SELECT ip, user_agent, CAST(count(*) AS BIGINT) AS hits FROM norm GROUP BY 1, 2""",
        "sql_functions": BASE + """
SELECT seq, domain AS search_engine_domain, keyword AS search_keyword, hostname AS referrer_host, is_purchase,
       CAST(revenue AS DECIMAL(38,2)) AS revenue
FROM classed""",
        "search_hits": BASE + """
SELECT seq, domain AS search_engine_domain, keyword AS search_keyword FROM classed WHERE keyword IS NOT NULL""",
        "purchase_hits": BASE + """
SELECT seq, CAST(revenue AS DECIMAL(38,2)) AS revenue FROM classed WHERE is_purchase""",
        "attributed_purchases": BASE + _live("file", None) + f"""
SELECT seq, ip, user_agent, ldomain AS search_engine_domain, lkeyword AS search_keyword,
       CAST(revenue AS DECIMAL(38,2)) AS revenue
FROM live WHERE {_ATTR}""",
        "last_touch_asof": BASE + _live("file", None) + """
SELECT seq, ldomain AS search_engine_domain, lkeyword AS search_keyword FROM live WHERE is_purchase""",
        "last_touch_ffill": BASE + _live("file", None) + """
SELECT seq, ldomain AS search_engine_domain, lkeyword AS search_keyword FROM live""",
        "hit_gaps": BASE + _live("file", None) + """
SELECT seq, CAST(hit_time - prev_time AS BIGINT) AS gap FROM live""",
        "session_starts": BASE + _live("file", t) + """
SELECT seq, new_session FROM live""",
        "session_ids": BASE + _live("file", t) + """
SELECT seq, CAST(sid AS BIGINT) AS session_id FROM live""",
        "session_last_touch": BASE + _live("file", t) + """
SELECT seq, ldomain AS search_engine_domain, lkeyword AS search_keyword FROM live""",
        "referrer_host": _PAGES + """
SELECT page_id, regexp_replace(hostname, '^www[.]', '') AS host FROM pu""",
        "query_param": _PAGES + f"""
SELECT page_id, {_param('query', 'page')} AS page, {_param('query', 'ref')} AS ref,
       {_param('query', 'utm_source')} AS utm_source
FROM pu""",
        "engine_lookup": BASE + """,
allurls AS (SELECT referrer AS url FROM norm UNION ALL SELECT url FROM pages),
au AS (""" + url_parts("allurls", "url") + f"""),
hosts AS (SELECT regexp_replace(hostname, '^www[.]', '') AS h FROM au)
SELECT h AS host, any_value({_ENGINE_OF}) AS engine_domain, CAST(count(*) AS BIGINT) AS urls
FROM hosts GROUP BY h""",
        "url_decode": BASE + """
SELECT seq, url_decode(replace(query, '+', ' ')) AS decoded_query FROM urls""",
        "search_referrer": BASE + """
SELECT referrer, any_value(domain) AS search_engine_domain, any_value(keyword) AS search_keyword,
       CAST(count(*) AS BIGINT) AS hits
FROM classed GROUP BY referrer""",
        "product_revenue": BASE + f"""
SELECT seq, {_REVENUE_ALL} AS revenue FROM norm""",
        "strip_text": "WITH " + _RAW + """
SELECT user_agent AS raw_agent, any_value(trim(user_agent)) AS stripped_agent, CAST(count(*) AS BIGINT) AS hits
FROM raw GROUP BY 1""",
    }
