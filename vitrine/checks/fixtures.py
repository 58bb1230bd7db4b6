"""Click events and product pages derived from the given tables, in Spark SQL and in DuckDB SQL.

User agents, currencies, referrers and options cycle through the edge cases the operators must
handle (NULL, empty text, empty array, ambiguous symbol, unmatched code).  Every row of the given
tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.session import work_dir
from vitrine.sources.files import to_json_lines

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# User agents, by user_id % 8 (7 is NULL).
AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 13_5 like Mac OS X) Version/13.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 10; SM-G975F) Chrome/83.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/18 Safari/537.36 Edge/18.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Windows NT 10.0; WOW64; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0",
    "curl/7.68",
]


def _cycle(selector: str, values: list[str | None]) -> str:
    cases = " ".join(
        f"WHEN {i} THEN {'CAST(NULL AS STRING)' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE CAST({selector} AS INT) {cases} END"


def clicks_sql(duck: bool) -> str:
    """The 19 event columns from `events` and `customer`."""
    k = "e.k"
    if duck:
        k_of = "json_extract_string(props, '$.k')"
        time = "date_trunc('millisecond', e.ts)"
        local = "strftime(e.ts, '%Y-%m-%d %H:%M:%S')"
    else:
        k_of = "get_json_object(props, '$.k')"
        time = "CAST(date_trunc('MILLISECOND', e.ts) AS TIMESTAMP)"
        local = "date_format(e.ts, 'yyyy-MM-dd HH:mm:ss')"
    number = f"CAST({k} AS INT)"
    diamond = f"concat('d', CAST({number} % 7 AS STRING))"
    alloy = f"CASE WHEN {number} % 4 = 0 THEN '' ELSE concat('a', CAST({number} % 4 AS STRING)) END"

    def entry(label: str, value: str, more: str = "''") -> str:
        parts = {"option_label": f"'{label}'", "option_id": value,
                 "value_label": f"concat('{label} ', {value}, {more})", "value_id": f"concat('v', {value})"}
        if duck:
            return "{" + ", ".join(f"'{n}': {v}" for n, v in parts.items()) + "}"
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in parts.items()) + ")"

    # One alloy id goes by several values.
    shade = f"CASE WHEN {number} % 3 = 0 THEN ' dark' ELSE '' END"
    both = f"{entry('diamond', diamond)}, {entry('alloy', alloy, shade)}"
    if duck:
        none, full = "[]", f"[{both}]"
    else:
        none = ("CAST(array() AS ARRAY<STRUCT<option_label:STRING,option_id:STRING,"
                "value_label:STRING,value_id:STRING>>)")
        full = f"array({both})"
    country = _cycle("(c.c_nationkey + CASE WHEN e.event_id % 10 = 0 THEN 1 ELSE 0 END) % 5",
                     ["de", "fr", "ae", "uk", "com"])
    campaign = ("CASE CAST(e.event_id % 7 AS INT) WHEN 0 THEN '?utm_campaign=c1' "
                "WHEN 1 THEN '?utm_campaign=c2' ELSE '' END")
    referrer = _cycle("e.event_id % 6", [None, "", "https://search.example/q",
                                         "https://ads.example/c?id=1", "https://social.example/p",
                                         "https://mail.example/"])
    currency = _cycle("e.event_id % 8", ["USD", "$", "EUR", "€", "BDT", "", None, "zz"])
    user = ("CASE WHEN e.user_id % 3 = 0 THEN '' "
            "WHEN e.user_id % 3 = 1 THEN concat(' ', CAST(e.user_id AS STRING), ' ') "
            "ELSE CAST(NULL AS STRING) END")
    return f"""
SELECT concat('e', CAST(e.event_id AS STRING)) AS _id,
 {time} AS time_stamp,
 concat('10.0.', CAST(e.user_id AS STRING), '.1') AS ip,
 {_cycle("e.user_id % 8", [*AGENTS, None])} AS user_agent,
 '1366x768' AS resolution,
 {user} AS user_id_db,
 CAST(e.user_id AS STRING) AS device_id,
 '1.0' AS api_version,
 concat('s', CAST(c.c_nationkey AS STRING)) AS store_id,
 {local} AS local_time,
 CASE WHEN e.event_id % 2 = 0 THEN 'true' ELSE 'false' END AS show_recommendation,
 concat('https://www.shop.', {country}, '/item-', {k}, '.html', {campaign}) AS current_url,
 {referrer} AS referrer_url,
 CASE WHEN e.user_id % 4 = 0 THEN '' ELSE concat('u', CAST(e.user_id AS STRING), '@example.com') END AS email_address,
 CASE WHEN e.event_type = 'view' THEN 'view_product_detail' ELSE e.event_type END AS collection,
 {k} AS product_id,
 CASE WHEN e.event_type = 'error' THEN NULL WHEN e.event_id % 5 = 0 THEN {none} WHEN e.event_id % 5 = 1 THEN NULL
  ELSE {full} END AS option,
 CAST(e.event_id AS STRING) AS id,
 {currency} AS currency
FROM (SELECT *, {k_of} AS k FROM {{events}}) e LEFT JOIN {{customer}} c ON c.c_custkey = e.user_id"""


# Snippets put into each page's own head and body, by page_id % 4; the same text in both dialects.
PRODUCT_PAGES = """
SELECT p.page_id,
 concat('https://www.shop.', CASE CAST(p.page_id % 5 AS INT) WHEN 0 THEN 'de' WHEN 1 THEN 'fr'
  WHEN 2 THEN 'ae' WHEN 3 THEN 'uk' ELSE 'com' END, '/item-', CAST(p.page_id AS STRING), '.html') AS url,
 replace(replace(p.html, '<head>', concat('<head>', CASE CAST(p.page_id % 4 AS INT)
  WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"Product","name":"Ring ', CAST(p.page_id AS STRING),
   ' - SHOP","description":"Fine  ring","offers":{"price":"', CAST(p.page_id + 1 AS STRING),
   CASE WHEN p.page_id % 8 = 4 THEN '.500' ELSE '.50' END, '","priceCurrency":"EUR"}}</script>')
  WHEN 1 THEN '<script type="application/ld+json">{bad json</script><meta property="og:title" content="OG Ring | SHOP.de"><meta content="Meta  text" name="description">'
  WHEN 3 THEN concat('<title> Ring  ', CAST(p.page_id AS STRING), ' | SHOP.de</title>')
  ELSE '' END)), '<body>', concat('<body>', CASE CAST(p.page_id % 4 AS INT)
  WHEN 2 THEN concat('<h1>Head  ', CAST(p.page_id AS STRING), '</h1><span class="big price">',
   CASE CAST(p.page_id % 16 AS INT) WHEN 6 THEN '-' WHEN 10 THEN 'KWD ' WHEN 14 THEN 'VND ' ELSE 'EUR ' END, '<b>',
   CAST(p.page_id AS STRING), '</b>', CASE CAST(p.page_id % 16 AS INT) WHEN 6 THEN ',25 €' WHEN 10 THEN '.500' WHEN 14 THEN '.500' ELSE '' END,
   '</span>')
  WHEN 3 THEN concat('<div class="product-description">Fine <b>ring</b> box</div><div data-price="1">',
   CASE WHEN p.page_id % 16 = 7 THEN '0,999 €' ELSE concat(CAST(p.page_id AS STRING), ',50 $') END, '</div>')
  ELSE '' END)) AS html
FROM {pages} p"""


# Product versions over time: the price text follows the event value in coarse steps.
def versions_sql(duck: bool) -> str:
    k = "json_extract_string(e.props, '$.k')" if duck else "get_json_object(e.props, '$.k')"
    time = ("date_trunc('millisecond', e.ts)" if duck
            else "CAST(date_trunc('MILLISECOND', e.ts) AS TIMESTAMP)")
    return f"""
SELECT {k} AS product_id, concat('Ring ', {k}) AS product_name,
 concat('EUR ', CAST(CAST(floor(e.value / 50) AS BIGINT) AS STRING), ',50') AS raw_price,
 {time} AS seen_at
FROM {{events}} e"""


# Event texts of which some are broken: cut off, empty, NULL, a list, with a wrongly typed field, with an
# unreadable time, or without any known field.
DIRTY = """
SELECT source_id, CASE CAST(source_id % 11 AS INT) WHEN 0 THEN substr(json_str, 1, length(json_str) - 1) WHEN 1 THEN ''
 WHEN 2 THEN CAST(NULL AS STRING) WHEN 3 THEN '[1, 2]'
 WHEN 4 THEN '{"_id":"x","option":{"option_label":1}}' WHEN 5 THEN '{"_id":"x","time_stamp":"garbage"}'
 WHEN 6 THEN '{}' WHEN 7 THEN '{"unknown":1}' ELSE json_str END AS json_str
FROM {lines}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The test tables are single small files, which Spark reads in one task: deal their rows out."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def run(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text in which `{name}` stands for a DataFrame and other braces for themselves."""
    text = sql.replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace("{{" + name + "}}", "{" + name + "}")
    return spark.sql(text, **tables)


def clicks(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    if events is None:
        events = spread(table(spark, sf_dir, "events"))
    return run(spark, clicks_sql(False), events=events,
               customer=table(spark, sf_dir, "customer"))


def as_sent(rows: DataFrame) -> DataFrame:
    """Clicks as JSON text, with times in the forms that producers send: ISO text, and milliseconds or
    microseconds since 1970."""
    form, at = F.col("id").cast("bigint") % 4, F.col("time_stamp")
    text = (F.when(form == 1, F.unix_millis(at).cast("string")).when(form == 2, F.unix_micros(at).cast("string"))
            .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")))
    return to_json_lines(rows.withColumn("time_stamp", text))


def click_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clicks as JSON text, which is what producers send."""
    return as_sent(clicks(spark, sf_dir))


def click_stream(spark: SparkSession, sf_dir: str, batches: int | None = None) -> DataFrame:
    """The same texts as a stream.  The bracket makes the path a pattern, which the streaming file
    source needs when a table is a single file; a folder of files matches as well.  With `batches` the
    events are dealt to so many batches, each of all times.  A batch takes as many files as there are
    cores: a file of one group of rows is read by one task."""
    events, reader = table(spark, sf_dir, "events"), spark.readStream
    path = f"{sf_dir}/event[s].parquet"
    if batches:
        each = spark.sparkContext.defaultParallelism
        path, reader = work_dir(spark, "events"), reader.option("maxFilesPerTrigger", each)
        events.repartition(batches * each, F.hash("event_id")).write.parquet(path)
    return as_sent(clicks(spark, sf_dir, reader.schema(events.schema).parquet(path)))


def crawl_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rounds of fetches of the product pages.  A page fails in its first page_id % 6 rounds, is fetched
    until it succeeds, and some take part in the first two or three rounds only."""
    tried = (F.col("round") <= F.col("page_id") % 6) & (F.col("round") < 2 + F.col("page_id") % 3)
    return (product_pages(spark, sf_dir).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(3)))).where(tried)
            .withColumn("html", F.when(F.col("round") == F.col("page_id") % 6, F.col("html"))))


# The same rounds over the product pages in DuckDB SQL, without their html.
CRAWL_ROUNDS = """
SELECT page_id, url, r AS round, r < page_id % 6 AS failed, 1704067200000 + 21600000 * r AS fetched
FROM product_pages, (SELECT unnest(range(4)) AS r) WHERE r <= page_id % 6 AND r < 2 + page_id % 3"""


def round_time(number: Column) -> Column:
    """Rounds are six hours apart."""
    return F.timestamp_seconds(F.lit(1_704_067_200) + number * 21_600)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, PRODUCT_PAGES, pages=spread(table(spark, sf_dir, "pages")))


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, versions_sql(False), events=spread(table(spark, sf_dir, "events")))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clicks(spark, sf_dir)
    lines = rows.selectExpr("CAST(id AS BIGINT) AS source_id", "to_json(struct(*)) AS json_str")
    return run(spark, DIRTY, lines=lines)
