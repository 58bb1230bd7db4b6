"""DuckDB SQL that each registered query must agree with, over the same parquet tables.

Written independently of the Spark plans: OR joins, ntile, medians and window functions stand here
in their plain form.
"""

from __future__ import annotations

from vitrine.checks import fixtures as fx
from vitrine.functions.user_agents import PRECISE, REFERENCE, UNKNOWN
from vitrine.sources.currency_list import currency_values


def _tables(sql: str) -> str:
    for name in fx.TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql


CLICKS = _tables(fx.clicks_sql(True))
PAGES = _tables(fx.PRODUCT_PAGES)
VERSIONS = _tables(fx.versions_sql(True))

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _option(label: str) -> str:
    return f"[o.option_id FOR o IN option IF o.option_label = '{label}' AND o.option_id IS NOT NULL][1]"


def _key(*parts: str) -> str:
    return "md5(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


COUNTRY = f"nullif(regexp_extract(lower(regexp_extract(current_url, '{HOST}', 1)), '\\.([a-z]+)$', 1), '')"

FACTS = f"""
SELECT _id AS event_id, time_stamp, CAST(time_stamp AS DATE) AS event_date,
 CAST(strftime(time_stamp, '%Y%m%d') AS INTEGER) AS date_id,
 collection, product_id, device_id, user_agent, store_id, current_url,
 {COUNTRY} AS country_code,
 nullif(regexp_extract(current_url, '[?&]utm_campaign=([^&#]*)', 1), '') AS campaign,
 nullif(referrer_url, '') AS referrer_url,
 nullif(lower(regexp_extract(referrer_url, '{HOST}', 1)), '') AS referrer_host,
 coalesce(len(option), 0) > 0 AS has_option,
 {_option('diamond')} AS diamond_option_id, {_option('alloy')} AS alloy_option_id,
 nullif(currency, '') AS raw_currency,
 {_key('product_id', 'collection')} AS product_key, {_key('device_id', 'user_agent')} AS device_key,
 {_key('store_id', COUNTRY)} AS store_key, CASE WHEN trim(user_id_db) <> '' OR trim(email_address) <> ''
  THEN {_key('trim(user_id_db)', 'trim(email_address)')} END AS customer_key,
 coalesce(nullif(trim(user_id_db), ''), nullif(trim(email_address), '')) AS customer
FROM clicks"""


def clicks(body: str, **ctes: str) -> str:
    more = "".join(f", {name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH clicks AS ({CLICKS}){more} {body}"


def facts(body: str, **ctes: str) -> str:
    return clicks(body, fact=FACTS, **ctes)


def _match(column: str, pairs: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN coalesce(regexp_matches({column}, '{p}'), false) THEN '{v}'" for p, v in pairs)
    return f"CASE {whens} ELSE '{UNKNOWN}' END"


def _device(rules: dict) -> str:
    # DuckDB's regex engine has no possessive forms, and these patterns use none.
    return (f"device_id, {_match('user_agent', rules['device_type'])} AS device_type, "
            f"regexp_extract(user_agent, '{rules['model']}', 1) AS model, "
            f"{_match('user_agent', rules['system'])} AS system, "
            f"{_match('user_agent', rules['browser'])} AS browser")


DIM_DATE_COLUMNS = """
 CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, CAST(day(d) AS INTEGER) AS day,
 CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(year(d) AS INTEGER) AS year,
 CAST(dayofweek(d) + 1 AS INTEGER) AS weekday, dayname(d) AS weekday_name,
 dayofweek(d) IN (0, 6) AS is_weekend"""
DIM_DATE = f"SELECT {DIM_DATE_COLUMNS} FROM (SELECT DISTINCT CAST(time_stamp AS DATE) AS d FROM clicks)"

OPTIONS = """
SELECT _id, time_stamp, pos, o.option_label AS optionLabel, o.option_id AS optionId,
 o.value_label AS valueLabel, o.value_id AS valueId
FROM (SELECT _id, time_stamp, unnest(option) AS o, generate_subscripts(option, 1) AS pos FROM clicks)"""


def _option_dim(label: str) -> str:
    return f"""
SELECT optionLabel, optionId, valueLabel, valueId FROM options WHERE optionLabel = '{label}'
QUALIFY row_number() OVER (PARTITION BY optionLabel, optionId ORDER BY time_stamp, _id, pos) = 1"""


def _product(optionless: bool = False) -> str:
    def first(label: str) -> str:
        return (f"coalesce(nullif(arg_min(optionId, {{'t': time_stamp, 'i': _id, 'p': pos}}) "
                f"FILTER (optionLabel = '{label}' AND optionId IS NOT NULL), ''), 'xna')")

    source = """(SELECT c.product_id, c.collection, c.time_stamp, c._id, x.pos, x.optionLabel, x.optionId
 FROM clicks c {join} JOIN options x ON x._id = c._id)""".format(join="LEFT" if optionless else "")
    return (f"SELECT product_id, collection, {first('diamond')} AS diamond_option_id, "
            f"{first('alloy')} AS alloy_option_id FROM {source} GROUP BY product_id, collection")


DIM_PRODUCT = _product()

CURRENCY = currency_values()

DIM_CURRENCY = f"""
SELECT r.raw_currency, x.* FROM (SELECT currency AS raw_currency FROM clicks WHERE currency <> '') r
LEFT JOIN {CURRENCY.replace('AS currency_reference', 'AS x')}
 ON r.raw_currency = x.symbol OR r.raw_currency = x.currency_code"""

BEST = f"""
SELECT k, currency_code, currency_name, symbol, country_code, usd_exchange_rate FROM (
 SELECT currency_code AS k, 0 AS o, * FROM {CURRENCY}
 UNION ALL SELECT symbol, 1, * FROM {CURRENCY})
QUALIFY row_number() OVER (PARTITION BY k ORDER BY o, currency_code, currency_name) = 1"""


# --- pages ---

def _clean(text: str) -> str:
    """Whitespace collapse and the fixture shop's suffixes in order."""
    out = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    for suffix in (r" \| SHOP\.de", r" - SHOP\.de", r" \| SHOP", r" - SHOP"):
        out = f"trim(regexp_replace({out}, '{suffix}$', ''))"
    return out


def _text(html: str) -> str:
    out = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"),
                         ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return out


def _inside(pattern: str) -> str:
    return f"nullif(regexp_extract(html, '(?s){pattern}', 1), '')"


def _info(source: str, suffixes: bool) -> str:
    clean = _clean if suffixes else (lambda t: f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))")
    return f"""
SELECT
 coalesce({clean("json_extract_string(ld, '$.name')")}, {clean(_text("og"))}, {clean(_text("h1"))},
  {clean(_text("title"))}, 'N/A') AS product_name,
 coalesce(json_extract_string(ld, '$.offers.priceCurrency') || ' ' || json_extract_string(ld, '$.offers.price'),
  {clean(_text("price"))}, {clean(_text("data_price"))}, 'N/A') AS price,
 coalesce({clean("json_extract_string(ld, '$.description')")}, {clean(_text("pd"))}, {clean("meta")}, 'N/A') AS description,
 url AS current_url, CAST(NULL AS VARCHAR) AS error
FROM (SELECT url,
  CASE WHEN json_valid(script) AND json_extract_string(script, '$."@type"') = 'Product' THEN script END AS ld,
  {_inside('<meta property="og:title" content="([^"]*)"')} AS og,
  {_inside('<h1>(.*?)</h1>')} AS h1, {_inside('<title>(.*?)</title>')} AS title,
  {_inside('<span class="big price">(.*?)</span>')} AS price,
  {_inside('<div data-price="1">(.*?)</div>')} AS data_price,
  {_inside('<div class="product-description">(.*?)</div>')} AS pd,
  {_inside('<meta content="([^"]*)" name="description">')} AS meta
 FROM (SELECT url, html, {_inside('<script type="application/ld.json">(.*?)</script>')} AS script FROM {source}))"""


INFO = _info("product_pages", True)


def with_info(body: str, **ctes: str) -> str:
    return clicks(body, product_pages=PAGES, options=OPTIONS, info=INFO, **ctes)


def rounds(body: str) -> str:
    return f"WITH product_pages AS ({PAGES}), rounds AS ({fx.CRAWL_ROUNDS}) {body}"


# Pauses double from one hour on; after four attempts a page is given up.
CRAWL_STATES = """
SELECT url AS current_url, count(*)::INTEGER AS attempts, CASE WHEN max(fetched) FILTER (WHERE failed) IS NOT NULL THEN 'Failed to fetch' END AS last_error,
 min(fetched) FILTER (WHERE NOT failed) AS succeeded_at, max(fetched) FILTER (WHERE failed) AS last_failed_at,
 CASE WHEN count(*) FILTER (WHERE NOT failed) = 0 AND count(*) < 4
  THEN max(fetched) FILTER (WHERE failed) + 3600000 * (1 << (count(*) - 1)) END AS due_at
FROM rounds GROUP BY url"""

# A single mark is the decimal mark, but for a group of three in a currency of whole units.
NUMBER = "regexp_extract(price, '-?[0-9]+(?:[.,][0-9]+)?')"
AMOUNT = (f"CAST(CASE WHEN regexp_matches(price, '^VND [1-9][0-9]{{0,2}}[.][0-9]{{3}}$') THEN replace({NUMBER}, '.', '') "
          f"ELSE replace({NUMBER}, ',', '.') END AS DECIMAL(18,3))")

# --- durations ---

VIEWS = """
SELECT *, CASE WHEN device_id IS NOT NULL AND time_stamp IS NOT NULL THEN gap END AS view_ms FROM (
 SELECT *, epoch_ms(lead(time_stamp) OVER (PARTITION BY device_id ORDER BY time_stamp, event_id))
  - epoch_ms(time_stamp) AS gap FROM fact)
WHERE collection = 'view_product_detail'"""


def _stats(by: str, source: str = "views") -> str:
    return (f"SELECT {by}, count(*) AS views, count(view_ms) AS timed_views, count(*) - count(view_ms) AS open_views, "
            "CAST(sum(view_ms) AS BIGINT) AS total_ms, CAST(sum(view_ms) AS DOUBLE) / count(view_ms) AS mean_ms, "
            f"CAST(median(view_ms) AS DOUBLE) AS median_ms FROM {source} GROUP BY {by}")


# --- windows of streams: all of them, with a flag for those that late events should no longer reach ---

def _windows(size: str, slide: str, copies: int) -> str:
    return f"""
SELECT epoch_ms(s) AS window_start, epoch_ms(s + INTERVAL '{size}') AS window_end, store_id, count(*) AS views,
 s + INTERVAL '{size}' <= (SELECT max(time_stamp) FROM clicks WHERE collection = 'view_product_detail') - INTERVAL '10 minutes' AS closed
FROM (SELECT store_id, collection, time_stamp, time_bucket(INTERVAL '{slide}', time_stamp) - k * INTERVAL '{slide}' AS s
 FROM clicks, (SELECT unnest(range({copies})) AS k))
WHERE collection = 'view_product_detail'
GROUP BY s, store_id"""


def _row_text(table: str, source: str, columns: list[str]) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{table}' AS table_name, concat_ws('|', {cells}) AS row_text FROM ({source})"


def _option_text(label: str) -> str:
    return _row_text(f"dim_{label}_option", _option_dim(label),
                     ["optionLabel", "optionId", "valueLabel", "valueId"])


DIM_CUSTOMER = """
SELECT user_id, email_address, show_recommendation FROM (
 SELECT trim(user_id_db) AS user_id, trim(email_address) AS email_address, show_recommendation, time_stamp, _id FROM clicks)
WHERE user_id <> '' OR email_address <> ''
QUALIFY row_number() OVER (PARTITION BY user_id, email_address ORDER BY time_stamp DESC, _id DESC) = 1"""

BROKEN = """
SELECT CAST(id AS BIGINT) AS source_id, _id, collection, CAST(id AS BIGINT) % 11 AS kind FROM clicks"""

ORACLES: dict[str, str] = {
    "parsed_events": clicks("""
SELECT _id, ip, user_agent, resolution, user_id_db, device_id, api_version, store_id, local_time,
 show_recommendation, current_url, referrer_url, email_address, collection, product_id, id, currency,
 epoch_ms(time_stamp) AS event_ms, CAST(to_json(option) AS VARCHAR) AS option_json FROM clicks"""),
    "dim_prd": clicks("SELECT DISTINCT product_id, current_url FROM clicks"),
    "dim_prd_events": clicks("SELECT product_id, current_url FROM clicks"),
    "dim_date": clicks(DIM_DATE),
    "dim_device": clicks(f"SELECT DISTINCT {_device(REFERENCE)} FROM clicks"),
    "dim_device_events": clicks(f"SELECT {_device(REFERENCE)} FROM clicks"),
    "dim_device_precise": clicks(f"SELECT DISTINCT {_device(PRECISE)} FROM clicks"),
    "dim_customer": clicks(DIM_CUSTOMER),
    "dim_diamond_option": clicks(_option_dim("diamond"), options=OPTIONS),
    "dim_alloy_option": clicks(_option_dim("alloy"), options=OPTIONS),
    "dim_alloy_option_values": clicks(
        "SELECT DISTINCT optionLabel, optionId, valueLabel, valueId FROM options WHERE optionLabel = 'alloy'",
        options=OPTIONS),
    "dim_product": clicks(DIM_PRODUCT, options=OPTIONS),
    "dim_product_optionless": clicks(_product(True), options=OPTIONS),
    "dim_currency": clicks(DIM_CURRENCY),
    "dim_currency_best": clicks(
        "SELECT r.raw_currency, b.* EXCLUDE (k) FROM "
        "(SELECT DISTINCT currency AS raw_currency FROM clicks WHERE currency <> '') r "
        "LEFT JOIN best b ON r.raw_currency = b.k", best=BEST),
    "fact_event": facts("""
SELECT event_id, date_id, collection, product_id, device_id, store_id, country_code, campaign,
 referrer_host, has_option, diamond_option_id, alloy_option_id, raw_currency, customer,
 product_key, device_key, customer_key, store_key FROM fact"""),
    "star_join": facts(f"""
SELECT monthname(f.event_date) AS month_name, {_match('f.user_agent', REFERENCE['browser'])} AS browser,
 p.diamond_option_id, p.alloy_option_id, count(*) AS events
FROM fact f LEFT JOIN product p ON f.product_id = p.product_id AND f.collection = p.collection GROUP BY ALL""",
                       options=OPTIONS, product=DIM_PRODUCT),
    "dim_store": facts("SELECT DISTINCT store_id, country_code FROM fact WHERE store_id <> ''"),
    "dim_product_scd2": f"""WITH versions AS ({VERSIONS}), marked AS (
 SELECT *, lag(raw_price) OVER w AS before, row_number() OVER w AS rn FROM versions
 WINDOW w AS (PARTITION BY product_id ORDER BY seen_at, product_name, raw_price)),
changes AS (SELECT * FROM marked WHERE rn = 1 OR before IS DISTINCT FROM raw_price),
spans AS (SELECT *, lead(seen_at) OVER (PARTITION BY product_id ORDER BY seen_at, product_name, raw_price) AS until FROM changes)
SELECT product_id, product_name, CAST(NULL AS VARCHAR) AS category, raw_price,
 CAST(replace(substr(raw_price, 5), ',', '.') AS DECIMAL(10,2)) AS price,
 CAST(NULL AS VARCHAR) AS quality, CAST(NULL AS VARCHAR) AS quality_label,
 epoch_ms(seen_at) AS record_created_date, epoch_ms(until) AS record_expired_date,
 until IS NULL AS is_current_record FROM spans""",
    "product_info": with_info("SELECT * FROM info"),
    "country_overlap": facts("""
SELECT a.country_code AS country, b.country_code AS other_country, count(*) AS devices FROM seen a JOIN seen b
 ON a.device_id = b.device_id AND a.country_code < b.country_code GROUP BY 1, 2""",
                             seen="SELECT DISTINCT country_code, device_id FROM fact WHERE country_code IS NOT NULL AND device_id IS NOT NULL"),
    "store_devices_period": facts("""
SELECT country_code, store_id, count(DISTINCT device_id) AS devices FROM fact
WHERE date_id BETWEEN 20240105 AND 20240114 AND store_id IS NOT NULL AND device_id IS NOT NULL GROUP BY 1, 2"""),
    "product_info_given_pages": _info("pages", False),
    "crawl_outcome": rounds("SELECT CASE WHEN failed THEN 'error' ELSE 'success' END AS outcome, count(*) AS pages FROM rounds GROUP BY 1"),
    "crawl_states": rounds(f"SELECT * FROM ({CRAWL_STATES})"),
    "crawl_outcomes": rounds(f"""
SELECT CASE WHEN succeeded_at IS NOT NULL THEN 'success' WHEN due_at IS NOT NULL THEN 'retry' ELSE 'gave_up' END AS outcome,
 count(*) AS pages, sum(attempts)::BIGINT AS attempts FROM ({CRAWL_STATES}) GROUP BY 1"""),
    "crawl_due": clicks(f"""
SELECT DISTINCT product_id, current_url FROM clicks WHERE current_url <> '' AND current_url NOT IN (
 SELECT current_url FROM ({CRAWL_STATES}) WHERE due_at IS NULL OR due_at > 1704067200000 + 4 * 21600000)""",
                        product_pages=PAGES, rounds=fx.CRAWL_ROUNDS),
    "product_page_urls": clicks("SELECT DISTINCT product_id, current_url FROM clicks WHERE current_url <> ''"),
    "crawl_worklist": with_info("""
SELECT DISTINCT product_id, current_url FROM clicks c WHERE current_url <> ''
 AND NOT EXISTS (SELECT 1 FROM product_pages p WHERE p.url = c.current_url)"""),
    "product_final": with_info("""
SELECT p.product_id, p.diamond_option_id, p.alloy_option_id, i.product_name, p.collection, i.price, i.description
FROM product p JOIN (SELECT DISTINCT product_id, current_url FROM clicks) d ON p.product_id = d.product_id
JOIN info i ON d.current_url = i.current_url""", product=DIM_PRODUCT),
    "product_final_latest": with_info("""
SELECT p.product_id, p.diamond_option_id, p.alloy_option_id, i.product_name, p.collection, i.price, i.description
FROM (SELECT * FROM product QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY collection) = 1) p
JOIN (SELECT d.product_id, x.* FROM (SELECT product_id, current_url, max(time_stamp) AS seen FROM clicks GROUP BY 1, 2) d
 JOIN info x ON d.current_url = x.current_url
 QUALIFY row_number() OVER (PARTITION BY d.product_id ORDER BY x.product_name <> 'N/A' DESC, d.seen DESC, d.current_url DESC) = 1) i
 ON p.product_id = i.product_id
WHERE p.product_id NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 0)""", product=DIM_PRODUCT),
    "price_decimal": with_info(f"""
SELECT current_url, price, CASE WHEN price <> 'N/A' THEN {AMOUNT} END AS amount FROM info"""),
    "amount_usd": with_info(f"""
SELECT current_url, price, amount, currency_code,
 CAST(amount * usd_exchange_rate AS DECIMAL(28,6)) AS amount_usd
FROM (SELECT current_url, price, CASE WHEN price <> 'N/A' THEN {AMOUNT} END AS amount,
 CASE WHEN price <> 'N/A' THEN trim(regexp_replace(price, '-?[0-9][0-9.,]*', '')) END AS raw FROM info) i
LEFT JOIN best b ON i.raw = b.k""", best=BEST),
    "top_products": facts("""
SELECT product_id, count(*) AS views FROM fact WHERE collection = 'view_product_detail'
GROUP BY 1 ORDER BY views DESC, product_id LIMIT 10"""),
    "daily_views": facts("""
SELECT product_id, event_date, views, avg(views) OVER (PARTITION BY product_id ORDER BY event_date
 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_mean
FROM (SELECT c.product_id, c.event_date, coalesce(d.views, 0) AS views
 FROM (SELECT product_id, CAST(unnest(generate_series(CAST(min(event_date) AS TIMESTAMP), max(event_date), INTERVAL 1 DAY)) AS DATE) AS event_date
  FROM daily GROUP BY product_id) c LEFT JOIN daily d USING (product_id, event_date))""",
                         top="SELECT product_id FROM fact WHERE collection = 'view_product_detail' "
                             "GROUP BY 1 ORDER BY count(*) DESC, product_id LIMIT 10",
                         daily="SELECT product_id, event_date, count(*) AS views FROM fact "
                               "WHERE collection = 'view_product_detail' AND product_id IN (SELECT product_id FROM top) GROUP BY 1, 2"),
    "product_funnel": facts("""
SELECT product_id, CAST(sum(n) AS BIGINT) AS views, count(*) AS viewers,
 count(*) FILTER (bought) AS buyers, CAST(count(*) FILTER (bought) AS DOUBLE) / count(*) AS conversion
FROM (SELECT v.product_id, v.device_id, v.n, EXISTS (SELECT 1 FROM fact p WHERE p.collection = 'purchase'
  AND p.product_id = v.product_id AND p.device_id = v.device_id AND p.time_stamp >= v.first) AS bought
 FROM (SELECT product_id, device_id, count(*) AS n, min(time_stamp) AS first FROM fact
  WHERE collection = 'view_product_detail' GROUP BY 1, 2) v) GROUP BY product_id"""),
    "option_pairs": facts("""
SELECT diamond_option_id, alloy_option_id, count(*) AS events FROM fact
WHERE diamond_option_id IS NOT NULL AND alloy_option_id IS NOT NULL GROUP BY 1, 2"""),
    "top_countries": facts("""
SELECT country_code, count(*) AS events, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
FROM fact WHERE country_code IS NOT NULL GROUP BY 1 ORDER BY events DESC, country_code LIMIT 10"""),
    "cross_border": facts("""
SELECT h.country_code AS home_country, s.country_code AS visited_country, count(*) AS devices,
 CAST(sum(s.n) AS BIGINT) AS events_abroad
FROM seen s JOIN (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY n DESC, country_code) = 1) h
 ON h.device_id = s.device_id AND h.country_code <> s.country_code GROUP BY 1, 2""",
                          seen="SELECT device_id, country_code, count(*) AS n FROM fact WHERE country_code IS NOT NULL GROUP BY 1, 2"),
    "penetration": facts("""
SELECT country_code, count(DISTINCT device_id) AS devices, CAST(count(DISTINCT device_id) AS DOUBLE) /
 (SELECT count(DISTINCT device_id) FROM fact WHERE country_code IS NOT NULL) AS penetration
FROM fact WHERE country_code IS NOT NULL GROUP BY 1"""),
    "penetration_approx": facts("""
SELECT country_code, count(DISTINCT device_id) AS devices, true AS within
FROM fact WHERE country_code IS NOT NULL GROUP BY 1"""),
    "store_compare": facts("""
SELECT country_code, store_id, count(*) FILTER (collection = 'view_product_detail') AS views,
 count(DISTINCT device_id) AS devices, count(*) FILTER (collection = 'purchase') AS purchases
FROM fact GROUP BY 1, 2"""),
    "store_rank": facts("""
SELECT country_code, store_id, count(*) AS views,
 CAST(rank() OVER (PARTITION BY country_code ORDER BY count(*) DESC) AS INTEGER) AS place
FROM fact WHERE collection = 'view_product_detail' GROUP BY 1, 2"""),
    "regional_cube": facts("""
SELECT country_code, store_id, collection, CAST(grouping(country_code, store_id, collection) AS INTEGER) AS level,
 count(*) AS events FROM fact GROUP BY CUBE (country_code, store_id, collection)"""),
    "top_referrers": facts("""
SELECT referrer_url AS referrer, count(*) AS events FROM fact WHERE referrer_url IS NOT NULL
GROUP BY 1 ORDER BY events DESC, referrer LIMIT 5"""),
    "top_referrer_hosts": facts("""
SELECT referrer_host AS referrer, count(*) AS events FROM fact WHERE referrer_host IS NOT NULL
GROUP BY 1 ORDER BY events DESC, referrer LIMIT 5"""),
    "attribution": facts("""
SELECT model, referrer, count(*) AS conversions FROM (
 SELECT 'first' AS model, coalesce((SELECT referrer_url FROM touch t WHERE t.device_id = b.device_id ORDER BY time_stamp, event_id LIMIT 1), 'direct') AS referrer FROM buyers b
 UNION ALL
 SELECT 'last', coalesce((SELECT referrer_url FROM touch t WHERE t.device_id = b.device_id ORDER BY time_stamp DESC, event_id DESC LIMIT 1), 'direct') FROM buyers b)
GROUP BY 1, 2""",
                         buyers="SELECT device_id, min(time_stamp) AS bought FROM fact WHERE collection = 'purchase' GROUP BY 1",
                         touch="SELECT f.device_id, f.time_stamp, f.event_id, f.referrer_url FROM fact f "
                               "JOIN buyers b ON f.device_id = b.device_id AND f.time_stamp <= b.bought "
                               "WHERE f.referrer_url IS NOT NULL"),
    "campaign": facts("""
SELECT campaign, CAST(sum(n) AS BIGINT) AS visits, count(*) AS devices, count(*) FILTER (bought) AS buyers,
 CAST(count(*) FILTER (bought) AS DOUBLE) / count(*) AS conversion
FROM (SELECT v.*, EXISTS (SELECT 1 FROM fact p WHERE p.collection = 'purchase' AND p.device_id = v.device_id
 AND p.time_stamp >= v.first) AS bought
 FROM (SELECT campaign, device_id, count(*) AS n, min(time_stamp) AS first FROM fact WHERE campaign IS NOT NULL GROUP BY 1, 2) v)
GROUP BY campaign"""),
    "view_duration": facts(_stats("product_id, country_code"), views=VIEWS),
    "view_duration_customising": facts(_stats("has_option"), views=VIEWS),
    "view_duration_option": facts(
        _stats("option_label, option_id", "chosen"), views=VIEWS,
        chosen="SELECT 'diamond' AS option_label, diamond_option_id AS option_id, view_ms FROM views WHERE diamond_option_id IS NOT NULL "
               "UNION ALL SELECT 'alloy', alloy_option_id, view_ms FROM views WHERE alloy_option_id IS NOT NULL"),
    "country_preference": facts("""
SELECT country_code, product_id, count(*) AS views,
 CAST(row_number() OVER (PARTITION BY country_code ORDER BY count(*) DESC, product_id) AS INTEGER) AS place
FROM fact WHERE collection = 'view_product_detail' GROUP BY 1, 2 QUALIFY place <= 3"""),
    "tech_stats": facts(f"""
SELECT {_match('user_agent', REFERENCE['browser'])} AS browser, {_match('user_agent', REFERENCE['system'])} AS system,
 {_match('user_agent', REFERENCE['device_type'])} AS device_type, count(*) AS events,
 CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share FROM fact GROUP BY 1, 2, 3"""),
    "segments": facts("""
SELECT customer, count(*) AS events, CAST(ntile(4) OVER (ORDER BY count(*), md5(customer), customer) AS INTEGER) AS band
FROM fact WHERE customer IS NOT NULL GROUP BY customer"""),
    "dq_quarantine": clicks("""
SELECT source_id, CASE WHEN kind IN (1, 2) THEN 'empty' WHEN kind = 4 THEN 'bad_field' WHEN kind = 5 THEN 'bad_time'
 WHEN kind IN (6, 7) THEN 'no_fields' ELSE 'malformed' END AS reason
FROM broken WHERE kind <= 7""", broken=BROKEN),
    "dq_good": clicks("SELECT _id, collection FROM broken WHERE kind > 7", broken=BROKEN),
    "dq_profile": clicks("""
SELECT '_id' AS column_name, count(*) AS rows, count(*) FILTER (_id IS NULL) AS nulls, count(*) FILTER (_id = '') AS empties, 0::BIGINT AS violations FROM clicks
UNION ALL SELECT 'user_id_db', count(*), count(*) FILTER (user_id_db IS NULL), count(*) FILTER (user_id_db = ''), 0 FROM clicks
UNION ALL SELECT 'referrer_url', count(*), count(*) FILTER (referrer_url IS NULL), count(*) FILTER (referrer_url = ''), 0 FROM clicks
UNION ALL SELECT 'email_address', count(*), count(*) FILTER (email_address IS NULL), count(*) FILTER (email_address = ''), count(*) FILTER (email_address NOT LIKE '%@%') FROM clicks
UNION ALL SELECT 'collection', count(*), count(*) FILTER (collection IS NULL), count(*) FILTER (collection = ''), 0 FROM clicks
UNION ALL SELECT 'currency', count(*), count(*) FILTER (currency IS NULL), count(*) FILTER (currency = ''), count(*) FILTER (NOT regexp_matches(currency, '^[A-Z]{3}$')) FROM clicks"""),
    "dq_refcheck": clicks("""
SELECT 'page' AS dimension, count(DISTINCT current_url) AS missing_keys, count(*) AS orphan_rows FROM clicks
WHERE current_url NOT IN (SELECT url FROM product_pages)
UNION ALL SELECT 'date', 0, 0 UNION ALL SELECT 'device', 0, 0 UNION ALL SELECT 'customer', 0, 0
UNION ALL SELECT 'product', count(DISTINCT product_key), count(*) FROM fact f
 WHERE NOT EXISTS (SELECT 1 FROM product p WHERE p.product_id = f.product_id AND p.collection = f.collection)
UNION ALL SELECT 'store', count(DISTINCT store_key), count(*) FROM fact WHERE store_id IS NULL OR store_id = ''""",
                         options=OPTIONS, fact=FACTS, product=DIM_PRODUCT, product_pages=PAGES),
    "dq_key_audit": facts(" UNION ALL ".join(
        f"SELECT '{t}' AS dimension, count(*) AS natural_keys, count(*) AS keys, 0 AS collisions FROM (SELECT DISTINCT {k} FROM {f})"
        for t, k, f in (("dim_product", "product_id, collection", "clicks"), ("dim_device", "device_id, user_agent", "clicks"),
                        ("dim_customer", "trim(user_id_db), trim(email_address)", "clicks"),
                        ("dim_store", "store_id, country_code", "fact")))),
    "dq_audit": clicks("""
SELECT 'events' AS table_name, 0::BIGINT AS batch_id, count(*) AS rows, epoch_ms(max(time_stamp)) AS max_event_time FROM clicks"""),
    "stream_dim_product": clicks(DIM_PRODUCT, options=OPTIONS),
    "stream_dims": clicks(" UNION ALL ".join([
        _row_text("dim_product", DIM_PRODUCT, ["product_id", "collection", "diamond_option_id", "alloy_option_id"]),
        _row_text("dim_prd", "SELECT product_id, current_url, epoch_ms(max(time_stamp)) AS t FROM clicks GROUP BY 1, 2",
                  ["product_id", "current_url", "t"]),
        _row_text("dim_date", DIM_DATE, ["date_id", "date", "day", "month", "month_name", "year", "weekday",
                                         "weekday_name", "is_weekend"]),
        _row_text("dim_currency", f"SELECT DISTINCT * FROM ({DIM_CURRENCY.replace('SELECT currency AS', 'SELECT DISTINCT currency AS')})",
                  ["raw_currency", "currency_code", "currency_name", "symbol", "country_code"]).replace("SELECT DISTINCT * FROM", "SELECT * FROM"),
        _row_text("dim_device", f"SELECT DISTINCT {_device(REFERENCE)} FROM clicks",
                  ["device_id", "device_type", "model", "system", "browser"]),
        _row_text("dim_customer", DIM_CUSTOMER, ["user_id", "email_address", "show_recommendation"]),
        _option_text("diamond"), _option_text("alloy")]), options=OPTIONS),
    "stream_device_dedup": clicks(f"SELECT DISTINCT {_device(REFERENCE)} FROM clicks"),
    "stream_first_events": clicks("""
SELECT device_id, epoch_ms(date_trunc('hour', time_stamp)) AS hour, epoch_ms(time_stamp) AS time_stamp, _id FROM clicks
QUALIFY row_number() OVER (PARTITION BY device_id, date_trunc('hour', time_stamp) ORDER BY time_stamp, _id) = 1"""),
    "stream_currency": clicks(DIM_CURRENCY),
    "stream_views_tumbling": clicks(_windows("1 hour", "1 hour", 1)),
    "stream_views_sliding": clicks(_windows("2 hours", "1 hour", 2)),
    "stream_views_session": clicks("""
SELECT device_id, epoch_ms(min(time_stamp)) AS session_start,
 epoch_ms(max(time_stamp) + INTERVAL '30 minutes') AS session_end, count(*) AS events,
 max(time_stamp) + INTERVAL '30 minutes' <= (SELECT max(time_stamp) FROM clicks) - INTERVAL '10 minutes' AS closed
FROM (SELECT device_id, time_stamp, sum(fresh) OVER (PARTITION BY device_id ORDER BY time_stamp, _id) AS n
 FROM (SELECT *, CASE WHEN time_stamp < lag(time_stamp) OVER (PARTITION BY device_id ORDER BY time_stamp, _id)
   + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM clicks))
GROUP BY device_id, n"""),
}
# Forms that must give what others give.
ORACLES |= {name: ORACLES[like] for name, like in (
    ("dim_product_scd2_batches", "dim_product_scd2"), ("penetration_sketch", "penetration"),
    ("regional_cube_stored", "regional_cube"), ("product_final_rounds", "product_final"))}
