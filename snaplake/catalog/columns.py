"""Projections, predicates, ragged columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.catalog import query, table
from snaplake.functions import values
from snaplake.operators import reshape
from snaplake.schemas import conform

_LINK_SQL = """CASE WHEN value < 5 THEN NULL WHEN event_type = 'error' THEN ''
              WHEN event_type = 'view' THEN 'N/A' WHEN event_type = 'click' THEN 'nan'
              ELSE props END"""


@query(
    f"""
WITH raw AS (SELECT event_id, {_LINK_SQL} AS link FROM events)
SELECT event_id, link FROM raw WHERE link IS NOT NULL AND link NOT IN ('', 'N/A', 'nan')
"""
)
def valid_value_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select("event_id", F.expr(_LINK_SQL).alias("link"))
        .where(values.is_valid(F.col("link")))
    )


_SHOWN_SQL = """CASE event_type WHEN 'error' THEN '-' WHEN 'view' THEN 'N/A'
               WHEN 'click' THEN '' WHEN 'signup' THEN NULL ELSE props END"""


@query(
    f"""
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
       coalesce(bool_or({_SHOWN_SQL} NOT IN ('', '-', 'N/A')), false) AS ready
FROM events GROUP BY 1, 2
"""
)
def page_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(F.bool_or(values.is_ready(F.expr(_SHOWN_SQL))).alias("ready"))
    )


@query(
    """
SELECT p_partkey, contains(p_name, 'red') OR contains(p_name, 'small') AS in_audience,
       contains(p_brand, '#') AS has_sign
FROM part
"""
)
def contains_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        values.contains_any(F.col("p_name"), ("red", "small")).alias("in_audience"),
        values.contains_any(F.col("p_brand"), ("#",)).alias("has_sign"),
    )


@query(
    """
SELECT s_suppkey AS shop_s_suppkey, s_name AS shop_s_name, s_nationkey AS shop_s_nationkey,
       s_acctbal AS shop_s_acctbal FROM supplier
"""
)
def prefix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.prefix_columns(table(spark, sf_dir, "supplier"), "shop_")


@query(
    """
SELECT c_custkey, c_name, '2025-10-01 ~ 2025-10-01' AS date_filter FROM customer
"""
)
def fill_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    filled = reshape.fill_missing_column(frame, "date_filter", "2025-10-01 ~ 2025-10-01")
    return reshape.fill_missing_column(filled, "c_name", "never used")


@query(
    """
SELECT s_suppkey, s_name AS shop_link, 'N/A' AS region_link FROM supplier
"""
)
def column_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    first = reshape.column_fallback(shops, "shop_link", "s_link", "s_name")
    return reshape.column_fallback(first, "region_link", "r_link", "r_name").drop("s_name")


@query(
    """
SELECT c_custkey, coalesce(o_orderpriority, 'N/A') AS priority
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
"""
)
def na_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    # The many-row side stands on the left, where a hot customer can be split.
    on = F.col("o_custkey") == F.col("c_custkey")
    met = partial.join(customers, on).select("c_custkey", "o_orderpriority")
    rest = customers.join(partial.select("o_custkey"), on, "left_anti")
    return met.unionByName(rest, allowMissingColumns=True).select(
        "c_custkey", values.na_default(F.col("o_orderpriority")).alias("priority")
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       nullif(o_orderstatus, 'F') AS o_orderstatus, o_orderpriority,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
FROM orders
"""
)
def cast_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
    )
    return reshape.cast_all_string(orders)


@query(
    """
SELECT s_name AS name, s_nationkey AS nation, s_suppkey AS shop, NULL AS creator, NULL AS segment
FROM supplier
UNION ALL
SELECT c_name, c_nationkey, NULL, c_custkey, c_mktsegment FROM customer
"""
)
def union_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = table(spark, sf_dir, "supplier").selectExpr(
        "s_name AS name", "s_nationkey AS nation", "s_suppkey AS shop"
    )
    creators = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS creator", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    return reshape.union_ragged(shops, creators)


@query(
    """
SELECT p_name, p_partkey, CAST(NULL AS VARCHAR) AS p_rating,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS p_size
FROM part
"""
)
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = T.StructType(
        [
            T.StructField("p_name", T.StringType()),
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_rating", T.StringType()),
            T.StructField("p_size", T.IntegerType()),
        ]
    )
    raw = table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "SMALL", F.lit("n.a."))
        .otherwise(F.col("p_size").cast("string"))
        .alias("p_size"),
        "p_brand",
        F.col("p_partkey").cast("string").alias("p_partkey"),
        "p_name",
    )
    return conform(raw, declared)
