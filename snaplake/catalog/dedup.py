"""Dedup, distinct keys, metrics, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import LINE_SEQ, query, table
from snaplake.operators import dedup, reshape
from snaplake.operators.resume import key_union
from snaplake.sources import tables

_LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


def _first_lines(keys: str) -> str:
    return f"""
SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_LINE_ORDER}) AS rn FROM lineitem)
WHERE rn = 1
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_SEQ)


_LINE_OUT = ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"]


@query(_first_lines("l_suppkey"))
def dedup_first_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_first(_lines(spark, sf_dir), "l_suppkey", LINE_SEQ).select(*_LINE_OUT)


@query(_first_lines("l_suppkey, l_partkey"))
def dedup_first_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return dedup.dedup_first(lines, ["l_suppkey", "l_partkey"], LINE_SEQ).select(*_LINE_OUT)


def _crawl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.concat("event_type", F.lit("|"), F.floor("value")).alias("name"),
        F.when(number < 15, F.lit("N/A")).otherwise(F.col("props")).alias("link"),
        (F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")).alias("is_stored"),
    )


def _dual_key_sql(exempt_na: bool) -> str:
    or_na = "OR link = 'N/A'" if exempt_na else ""
    return f"""
WITH crawl AS (
  SELECT event_id, user_id, event_type || '|' || CAST(floor(value) AS BIGINT) AS name,
         CASE WHEN CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) < 15
              THEN 'N/A' ELSE props END AS link,
         ts < TIMESTAMP '2024-01-05' AS is_stored
  FROM events),
stored AS (SELECT * FROM crawl WHERE is_stored),
s1 AS (SELECT * FROM crawl c WHERE NOT is_stored AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.user_id = c.user_id AND s.name = c.name)),
s2 AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, name ORDER BY event_id) AS rn FROM s1)
  WHERE rn = 1),
s3 AS (SELECT event_id, user_id, name, link FROM s2 c WHERE NOT EXISTS (
  SELECT 1 FROM stored s
  WHERE s.link <> 'N/A' AND s.user_id = c.user_id AND s.link = c.link)),
s4 AS (SELECT *, row_number() OVER (PARTITION BY user_id, link ORDER BY event_id) AS rn FROM s3)
SELECT event_id, user_id, name, link FROM s4 WHERE rn = 1 {or_na}
"""


def _dual_key(spark: SparkSession, sf_dir: str, exempt_na: bool) -> DataFrame:
    crawl = _crawl_rows(spark, sf_dir)
    kept = dedup.dedup_dual_key(
        crawl.where(~F.col("is_stored")),
        crawl.where(F.col("is_stored")),
        parent=["user_id"],
        name="name",
        link="link",
        seq="event_id",
        exempt_na=exempt_na,
    )
    return kept.drop("is_stored")


@query(_dual_key_sql(True))
def resume_dual_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dual_key(spark, sf_dir, exempt_na=True)


@query(_dual_key_sql(False))
def resume_dual_key_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dual_key(spark, sf_dir, exempt_na=False)


@query(
    """
SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2
"""
)
def metric_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return reshape.last_values(events, "user_id", "event_type", "value", "event_id")


@query(
    f"""
SELECT l_suppkey,
       arg_max(l_extendedprice, row({_LINE_ORDER})) FILTER (l_returnflag = 'A') AS shop_a,
       arg_max(l_extendedprice, row({_LINE_ORDER})) FILTER (l_returnflag = 'N') AS shop_n,
       arg_max(l_extendedprice, row({_LINE_ORDER})) FILTER (l_returnflag = 'R') AS shop_r
FROM lineitem GROUP BY 1
"""
)
def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.pivot_metrics(
        table(spark, sf_dir, "lineitem"),
        key="l_suppkey",
        label="l_returnflag",
        value="l_extendedprice",
        pos=LINE_SEQ,
        labels=["A", "N", "R"],
        prefix="Shop_",
    )


@query(
    """
WITH last AS (SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2)
SELECT user_id, max(value) FILTER (event_type = 'click') AS shop_click, max(value) FILTER (event_type = 'purchase') AS shop_purchase,
       string_agg('Shop_' || event_type || '=' || floor(value)::BIGINT, ';' ORDER BY event_type)
         FILTER (event_type NOT IN ('click', 'purchase')) AS others
FROM last GROUP BY 1
"""
)
def metric_open_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two declared labels as columns, all others in a map, here shown as text."""
    found = reshape.open_metrics(
        table(spark, sf_dir, "events"),
        key="user_id",
        label="event_type",
        value="value",
        pos="event_id",
        declared=["click", "purchase"],
        prefix="Shop_",
    )
    shown = F.transform(
        F.map_entries("other_metrics"),
        lambda e: F.concat_ws("=", e["key"], F.floor(e["value"]).cast("string")),
    )
    return found.select("user_id", "shop_click", "shop_purchase", F.array_join(shown, ";").alias("others"))


@query(
    """
SELECT event_type AS table_name, count(*) AS total,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS new_rows,
       count(*) FILTER (value >= 50) AS updated
FROM events GROUP BY 1
"""
)
def sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    is_new = F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")
    return reshape.sync_counts(events, "event_type", is_new, F.col("value") >= 50).withColumnRenamed(
        "event_type", "table_name"
    )


@query(
    """
SELECT 'purchase' AS name, EXISTS (SELECT 1 FROM events WHERE event_type = 'purchase') AS has_data
UNION ALL SELECT 'huge', EXISTS (SELECT 1 FROM events WHERE value > 1000000000)
UNION ALL SELECT 'huge or open', EXISTS (SELECT 1 FROM events WHERE value > 1000000000)
                              OR EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'unknown', EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey IS NULL)
"""
)
def has_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of some row sets have any row; a search stops at the first one it finds."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    huge = events.where(F.col("value") > 1_000_000_000)
    checks = {
        "purchase": [events.where(F.col("event_type") == "purchase")],
        "huge": [huge],
        "huge or open": [huge, orders.where(F.col("o_orderstatus") == "O")],
        "unknown": [table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNull())],
    }
    found = [(name, tables.has_data(*frames)) for name, frames in checks.items()]
    return spark.createDataFrame(found, "name string, has_data boolean")


@query(
    """
SELECT user_id AS parent, event_type AS name FROM events
UNION
SELECT l_suppkey, l_returnflag FROM lineitem
"""
)
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "events").selectExpr("user_id AS parent", "event_type AS name")
    new = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS parent", "l_returnflag AS name")
    return key_union(stored, new, ["parent", "name"])


_DIM_ORDER = ", ".join(LINE_SEQ)


@query(
    f"""
SELECT 'https://s.example/' || l_suppkey AS shop_link, p_name AS product_name,
       arg_min(CASE WHEN l_returnflag = 'R' THEN 'N/A' ELSE '/p/' || l_partkey END,
               row({_DIM_ORDER})) AS product_link
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
"""
)
def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.when(F.col("l_returnflag") == "R", F.lit("N/A")).otherwise(
        F.concat(F.lit("/p/"), "l_partkey")
    )
    parts = table(spark, sf_dir, "part")
    products = (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("https://s.example/"), "l_suppkey").alias("shop_link"),
            F.col("p_name").alias("product_name"),
            link.alias("tiktok_product_link"),
            *LINE_SEQ,
        )
    )
    return reshape.product_dim(products, LINE_SEQ)
