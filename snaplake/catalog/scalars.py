"""Text, URL and date functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import query, table
from snaplake.functions import dates, text, urls, values
from snaplake.operators.filters import category_path, date_range
from snaplake.session import shared_dir
from snaplake.sources import tables

# The same character set as text.strip, spelled for the other engine.
_SPACES = "||".join(
    f"chr({c})"
    for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)


@query(
    """
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page,
       nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS utm_source,
       regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS decoded
FROM pages
"""
)
def url_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    address = F.concat(F.lit("https://h.example/q?a=1&t=&t="), F.url_encode(title), F.lit("#x"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.query_param(F.col("url"), "page").alias("page"),
        urls.query_param(F.col("url"), "utm_source").alias("utm_source"),
        urls.query_param(address, "t").alias("decoded"),
    )


@query(
    """
SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=[^&#]')
  THEN 'https://base.example/shop/detail?id=' || regexp_extract(url, '[?&]page=([^&#]+)', 1)
  ELSE url END AS shop_link
FROM pages
"""
)
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = "https://base.example/shop/detail?id="
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.canonical_url(F.col("url"), base, "page").alias("shop_link")
    )


@query(
    """
WITH parts AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host,
         regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '[?&]page=([^&#]+)', 1) AS room
  FROM pages),
named AS (
  SELECT *, CASE WHEN host LIKE 'www.%' THEN 'N/A' ELSE split_part(host, '.', 1) END AS creator
  FROM parts)
SELECT page_id, host, path,
  CASE WHEN host LIKE '%example.com' AND path LIKE '%/en/%' AND room <> '' AND creator <> 'N/A'
       THEN 'https://www.tiktok.com/@' || creator || '/live?room_id=' || room
       ELSE 'N/A' END AS link
FROM named
"""
)
def live_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    host = urls.url_host(url)
    creator = F.when(host.startswith("www."), F.lit("N/A")).otherwise(
        F.split_part(host, F.lit("."), F.lit(1))
    )
    on_page = urls.is_live_page(url, F.when(host.endswith("example.com"), host), "/en/")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        host.alias("host"),
        urls.url_path(url).alias("path"),
        urls.live_link(creator, urls.query_param(url, "page"), on_page).alias("link"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'N' THEN 'N/A'
       ELSE 'https://www.tiktok.com/@' || s_name || '/video/' || l_orderkey END AS link
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""
)
def video_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    video_id = F.when(F.col("l_returnflag") != "N", F.col("l_orderkey").cast("string"))
    suppliers = table(spark, sf_dir, "supplier")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            urls.video_link(F.col("s_name"), video_id).alias("link"),
        )
    )


@query(
    f"""
WITH raw AS (
  SELECT c_custkey, chr(9) || ' @@' || upper(c_name) || chr(160) AS handle,
         chr(12288) || c_mktsegment || chr(10) AS segment FROM customer)
SELECT c_custkey, ltrim(lower(trim(handle, {_SPACES})), '@') AS handle,
       lower(trim(segment, {_SPACES})) AS key_text
FROM raw
"""
)
def normalise_handle(spark: SparkSession, sf_dir: str) -> DataFrame:
    handle = F.concat(F.lit("\t @@"), F.upper("c_name"), F.lit("\xa0"))
    segment = F.concat(F.lit("　"), "c_mktsegment", F.lit("\n"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.normalise_handle(handle).alias("handle"),
        text.normalise_key(segment).alias("key_text"),
    )


@query(
    f"""
SELECT doc_id, md5(trim(replace(text, chr(10), ''), {_SPACES})) AS metric_text,
       md5(replace(text, chr(10), ' ')) AS bio_text,
       md5(trim(replace(text, chr(10), ' '), {_SPACES})) AS name_text
FROM documents
"""
)
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(text.join_lines(body)).alias("metric_text"),
        F.md5(text.flatten_lines(body)).alias("bio_text"),
        F.md5(text.clean_name(body)).alias("name_text"),
    )


@query(
    """
WITH raw AS (
  SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN p_name
    ELSE 'Debut Time : ' || p_type || ': ' || p_name || '  ' END AS t FROM part)
SELECT p_partkey, CASE WHEN instr(t, ': ') > 0 THEN trim(substr(t, instr(t, ': ') + 2)) ELSE t END
  AS debut_time FROM raw
"""
)
def split_after_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(
        F.concat(F.lit("Debut Time : "), "p_type", F.lit(": "), "p_name", F.lit("  "))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.after_marker(shown).alias("debut_time")
    )


@query(
    """
SELECT p_partkey, CASE WHEN p_size > 40 THEN 'unrated' ELSE (p_size // 10) || '.' || (p_size % 10) END
  AS rating FROM part
"""
)
def regex_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    shown = F.when(size > 40, F.lit("unrated")).otherwise(
        F.concat(F.lit(" "), F.expr("p_size div 10"), F.lit("."), size % 10, F.lit(" /5 / x"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.before_slash(shown).alias("rating"))


@query(
    """
SELECT p_partkey,
       CASE WHEN p_type = 'ECONOMY' THEN 'N/A' ELSE p_partkey || '' END AS reviews,
       CASE WHEN p_type = 'SMALL' THEN 'N/A' ELSE p_size || '' END AS skus,
       CASE WHEN p_size > 30 THEN 'N/A' ELSE p_size || '' END AS ad_days
FROM part
"""
)
def regex_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = F.when(F.col("p_type") == "ECONOMY", F.lit("Reviews: none")).otherwise(
        F.concat(F.lit("4.5 /5 Reviews: "), "p_partkey", F.lit(" (3)"))
    )
    skus = F.when(F.col("p_type") == "SMALL", F.lit("SKUs ( 1 )")).otherwise(
        F.concat(F.lit("SKUs ("), "p_size", F.lit(") (0)"))
    )
    days = F.when(F.col("p_size") > 30, F.concat(F.lit("Days "), "p_size")).otherwise(
        F.concat(F.lit("ran 7, "), "p_size", F.lit("  days"))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.review_count(reviews).alias("reviews"),
        text.sku_count(skus).alias("skus"),
        text.ad_days(days).alias("ad_days"),
    )


@query(
    """
SELECT c_custkey, CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN c_custkey || ',5k'
    WHEN 'BUILDING' THEN c_custkey || ''
    WHEN 'FURNITURE' THEN c_custkey || '.2M'
    ELSE 'N/A' END AS followers
FROM customer
"""
)
def regex_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    shown = (
        F.when(segment == "AUTOMOBILE", F.concat(F.lit("Fans 9 Followers\n"), "c_custkey", F.lit(",5k")))
        .when(segment == "BUILDING", F.concat("c_custkey", F.lit(" Followers")))
        .when(segment == "FURNITURE", F.concat(F.lit("followers "), "c_custkey", F.lit(".2M x")))
        .otherwise(F.lit("Followers"))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.followers(shown).alias("followers")
    )


@query(
    """
WITH raw AS (
  SELECT c_custkey, c_custkey || CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN 'k' WHEN 'BUILDING' THEN 'm' WHEN 'FURNITURE' THEN 'K' ELSE '' END AS t
  FROM customer)
SELECT c_custkey, CASE WHEN contains(t, 'k') OR contains(t, 'm') THEN t ELSE 'N/A' END AS followers
FROM raw
"""
)
def followers_suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    suffix = (
        F.when(segment == "AUTOMOBILE", "k")
        .when(segment == "BUILDING", "m")
        .when(segment == "FURNITURE", "K")
        .otherwise("")
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.followers_with_suffix(F.concat("c_custkey", suffix)).alias("followers"),
    )


@query(
    """
SELECT c_custkey, CASE c_mktsegment
    WHEN 'AUTOMOBILE' THEN '1,' || c_custkey
    WHEN 'BUILDING' THEN c_custkey || '.6M'
    ELSE '- (' || c_mktsegment || ')' END AS views
FROM customer
"""
)
def compact_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    shown = (
        F.when(segment == "AUTOMOBILE", F.concat(F.lit("1,"), "c_custkey", F.lit(" views")))
        .when(segment == "BUILDING", F.concat(F.lit("~"), "c_custkey", F.lit(".6M, 3")))
        .otherwise(F.concat(F.lit("- ("), "c_mktsegment", F.lit(")")))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.compact_number(shown).alias("views")
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2025-10-01' END AS day,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
            THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '2025-10-01' END AS first_day,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
            THEN strftime(last_day(o_orderdate), '%Y-%m-%d') ELSE '2025-11-30' END AS last_day
FROM orders
"""
)
def date_parse_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    shown = (
        F.when(status == "O", F.date_format("o_orderdate", "yyyy-M-d"))
        .when(status == "P", F.lit("1999-13-45"))
        .otherwise(F.concat(F.lit("day "), "o_orderkey"))
    )
    until = F.when(
        F.col("o_orderpriority") != "5-LOW", F.last_day("o_orderdate").cast("string")
    ).otherwise(F.lit(""))
    first, last = dates.parse_span(shown, until, ("2025-10-01", "2025-11-30"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.parse_day(shown, "2025-10-01").cast("string").alias("day"),
        first.cast("string").alias("first_day"),
        last.cast("string").alias("last_day"),
    )


@query(
    """
SELECT event_id, strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS local_ts,
       CAST(ts + INTERVAL 7 HOUR AS DATE) <> CAST(ts AS DATE) AS next_day
FROM events
"""
)
def tz_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = dates.to_zone(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("local_ts"),
        (local.cast("date") != F.col("ts").cast("date")).alias("next_day"),
    )


@query(
    """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'AD' ELSE 'Normal' END AS type FROM events
"""
)
def content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", values.content_type(F.col("event_type") == "purchase").alias("type")
    )


@query(
    """
SELECT event_id, CASE event_type WHEN 'error' THEN props ELSE event_type END AS shown FROM events
"""
)
def first_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    visible = F.when(F.col("event_type") == "error", F.lit(" \n\t")).otherwise(
        F.concat(F.lit("\n "), "event_type", F.lit("\n"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", text.first_nonempty(visible, F.col("props")).alias("shown")
    )


@query(
    """
SELECT o_orderkey, o_custkey, '1997-05-01 ~ 1997-05-31' AS date_filter FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1997-05'
"""
)
def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by month; one month read back."""
    path = shared_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", dates.month_snapshot(F.col("o_orderdate")).alias("date_filter")
    )
    tables.overwrite_snapshot(orders, path)
    columns = ["o_orderkey", "o_custkey", "date_filter"]
    return tables.snapshot_scan(spark, path, "1997-05-01", "1997-05-31", columns, orders.schema)


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' ~ ' || strftime(o_orderdate, '%Y-%m-%d')
         AS date_filter,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || ' ~ ' ||
         strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_filter,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS snap_start,
       strftime(last_day(o_orderdate), '%Y-%m-%d') AS snap_end
FROM orders
"""
)
def snapshot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("o_orderdate")
    month = dates.month_snapshot(moment)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.day_snapshot(moment).alias("date_filter"),
        month.alias("month_filter"),
        dates.snapshot_start(month).cast("string").alias("snap_start"),
        dates.snapshot_end(month).cast("string").alias("snap_end"),
    )


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1998-10-31'
"""
)
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return date_range(orders, "o_orderdate", "1996-02-01", "1998-10-31").select(
        "o_orderkey", "o_custkey"
    )


@query(
    """
SELECT c_custkey, r_name, n_name, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'AFRICA' AND n_name = 'NATION_10' AND c_mktsegment = 'AUTOMOBILE'
"""
)
def category_path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name", "n_name", "c_mktsegment")
    )
    return category_path(
        shops, {"r_name": "AFRICA", "n_name": "NATION_10", "c_mktsegment": "AUTOMOBILE"}
    )
