"""Lookups, resume joins, hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import LINE_SEQ, query, table
from snaplake.operators import resume
from snaplake.operators.enrich import (
    children_of,
    enrich_creator_links,
    lookup_first,
    top_shops,
)
from snaplake.operators.hierarchy import flatten_levels


def captured_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creator rows: urgent orders, seen as captures of their customer."""
    orders = table(spark, sf_dir, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    )
    customers = table(spark, sf_dir, "customer")
    link = F.concat(F.lit("https://t.example/@"), "c_name", F.lit("?o="), "o_orderkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("https://s.example/"), "c_nationkey").alias("shop_link"),
        F.col("c_mktsegment").alias("product_name"),
        F.col("c_name").alias("creator_name"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(link).alias("tiktok_link"),
        F.col("o_orderkey").alias("seq"),
    )


def content_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video rows: all orders, with the handle and key texts as a page shows them."""
    customers = table(spark, sf_dir, "customer")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("seq"),
            F.concat(F.lit("HTTPS://s.example/"), "c_nationkey", F.lit(" ")).alias("shop_link"),
            F.lower("c_mktsegment").alias("product_name"),
            F.concat(F.lit(" @@"), F.upper("c_name")).alias("creator_name"),
            F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("old/"), "o_orderkey"))
            .when(F.col("o_orderstatus") == "F", F.lit("N/A"))
            .alias("creator_link"),
        )
    )


_CREATORS_SQL = """
  SELECT 'https://s.example/' || c_nationkey AS shop_link, c_mktsegment AS product_name,
         c_name AS creator_name, o_orderkey AS seq,
         CASE WHEN o_orderstatus = 'P' THEN 'N/A'
              ELSE 'https://t.example/@' || c_name || '?o=' || o_orderkey END AS tiktok_link
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""


@query(
    f"""
WITH creators AS ({_CREATORS_SQL}),
dim AS (
  SELECT lower(shop_link) AS s, lower(product_name) AS p, lower(creator_name) AS c,
         arg_min(tiktok_link, seq) AS found
  FROM creators GROUP BY 1, 2, 3),
facts AS (
  SELECT o_orderkey AS seq, 'https://s.example/' || c_nationkey AS s, lower(c_mktsegment) AS p,
         lower(c_name) AS c, upper(c_name) AS shown,
         CASE o_orderstatus WHEN 'O' THEN 'old/' || o_orderkey WHEN 'F' THEN 'N/A' END AS existing
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT seq, ' @@' || shown AS creator_name,
       coalesce(nullif(found, 'N/A'), existing, 'N/A') AS creator_link
FROM facts LEFT JOIN dim USING (s, p, c)
"""
)
def creator_link_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich_creator_links(content_rows(spark, sf_dir), captured_creators(spark, sf_dir))
    return enriched.select("seq", "creator_name", "creator_link")


@query(
    f"""
WITH creators AS ({_CREATORS_SQL}),
dim AS (
  SELECT shop_link, product_name, creator_name, arg_min(tiktok_link, seq) AS found
  FROM creators GROUP BY 1, 2, 3)
SELECT o_orderkey AS seq, coalesce(found, 'N/A') AS tiktok_link
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN dim ON shop_link = 'https://s.example/' || c_nationkey
  AND product_name = c_mktsegment
  AND creator_name = CASE WHEN o_orderstatus = 'O' THEN c_name ELSE upper(c_name) END
"""
)
def creator_link_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw keys: a handle in other case does not meet its creator."""
    customers = table(spark, sf_dir, "customer")
    facts = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("seq"),
            F.concat(F.lit("https://s.example/"), "c_nationkey").alias("shop_link"),
            F.col("c_mktsegment").alias("product_name"),
            F.when(F.col("o_orderstatus") == "O", F.col("c_name"))
            .otherwise(F.upper("c_name"))
            .alias("creator_name"),
        )
    )
    found = lookup_first(
        facts,
        captured_creators(spark, sf_dir),
        on=["shop_link", "product_name", "creator_name"],
        value="tiktok_link",
        seq="seq",
    )
    return found.select("seq", "tiktok_link")


@query(
    """
WITH dim AS (
  SELECT l_suppkey, l_partkey,
         arg_min('p/' || l_partkey || '?o=' || l_orderkey || '-' || l_linenumber,
                 row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice))
           AS product_link
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey,
       coalesce(d.product_link, 'N/A') AS product_link
FROM lineitem l LEFT JOIN dim d USING (l_suppkey, l_partkey)
"""
)
def product_link_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    products = lines.where(F.col("l_returnflag") != "N").withColumn(
        "product_link",
        F.concat(
            F.lit("p/"), "l_partkey", F.lit("?o="), "l_orderkey", F.lit("-"), "l_linenumber"
        ),
    )
    return lookup_first(
        lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"),
        products,
        on=["l_suppkey", "l_partkey"],
        value="product_link",
        seq=LINE_SEQ,
    )


@query(
    """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders d
                  WHERE d.o_custkey = o.o_custkey AND d.o_orderdate < TIMESTAMP '1996-01-01')
"""
)
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    done = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return resume.resume_anti(orders, done, "o_custkey").select("o_orderkey", "o_custkey")


@query(
    """
WITH numbered AS (
  SELECT event_id, user_id,
         (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 + 1 AS page
  FROM events)
SELECT event_id, user_id, CAST(page AS BIGINT) AS page FROM numbered WHERE page > 2
"""
)
def resume_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    numbered = resume.number_pages(events, ["user_id"], "event_id", page_size=10)
    done = numbered.where(F.col("page") <= 2)
    return resume.resume_pages(numbered, done, ["user_id"])


@query(
    """
SELECT r_name, n_name, s_name, l_orderkey, l_linenumber, p_name, '1995-01-01 ~ 2001-12-31' AS date_filter
FROM region JOIN nation ON n_regionkey = r_regionkey
JOIN supplier ON s_nationkey = n_nationkey
JOIN lineitem ON l_suppkey = s_suppkey
JOIN part ON p_partkey = l_partkey
"""
)
def hierarchy_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_levels(
        table(spark, sf_dir, "region"),
        [
            (table(spark, sf_dir, "nation"), "r_regionkey", "n_regionkey"),
            (table(spark, sf_dir, "supplier"), "n_nationkey", "s_nationkey"),
            (table(spark, sf_dir, "lineitem"), "s_suppkey", "l_suppkey"),
            (table(spark, sf_dir, "part"), "l_partkey", "p_partkey"),
        ],
    )
    return flat.select(
        "r_name",
        "n_name",
        "s_name",
        "l_orderkey",
        "l_linenumber",
        "p_name",
        F.lit("1995-01-01 ~ 2001-12-31").alias("date_filter"),
    )


@query(
    """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5)
"""
)
def limit_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = top_shops(
        table(spark, sf_dir, "supplier"), [F.desc("s_acctbal"), F.asc("s_suppkey")], 5
    ).withColumnRenamed("s_suppkey", "l_suppkey")
    lines = table(spark, sf_dir, "lineitem")
    return children_of(lines, shops, ["l_suppkey"]).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"
    )
