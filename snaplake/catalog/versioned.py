"""Versioned tables: batches as versions, sinks caught up, late links by file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import query, table
from snaplake.operators.enrich import lookup_first
from snaplake.session import shared_dir
from snaplake.sources.versions import Ledger, Warehouse, append_stream, backfill_files

_YEAR_SQL = "year(o_orderdate) || '-01-01 ~ ' || year(o_orderdate) || '-12-31'"


def _year(moment: str) -> Column:
    return F.format_string("%1$d-01-01 ~ %1$d-12-31", F.year(moment))


@query(
    f"""
WITH stored AS (
  SELECT 'orders' AS tab, o_orderkey AS key, o_orderkey % 3 AS version, {_YEAR_SQL} AS date_filter
  FROM orders
  UNION ALL
  SELECT 'customers', c_custkey, c_custkey % 3, 'N/A' FROM customer)
SELECT sink, tab, version, date_filter, count(*) AS row_count, sum(key)::BIGINT AS key_sum
FROM stored, (VALUES ('sheets'), ('database')) s(sink) GROUP BY ALL
"""
)
def commit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into two tables, one of them replayed; a sink fails at the second version and is caught up."""
    house, out = Warehouse(spark, shared_dir(spark, "house")), shared_dir(spark, "sinks")
    frames = {
        "orders": table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("key"), _year("o_orderdate").alias("date_filter")
        ),
        "customers": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("key"), F.lit(None).cast("string").alias("date_filter")
        ),
    }
    schemas = {name: df.schema for name, df in frames.items()}
    for batch in (0, 1, 1, 2):
        shares = {name: df.where(F.col("key") % 3 == batch) for name, df in frames.items()}
        append_stream(house, "landing", batch, shares, dict.fromkeys(frames, ["key"]), "key")
    failing = [1]

    def sink(name: str):
        def write(version: int, rows: dict[str, DataFrame]) -> None:
            for tab, df in rows.items():
                df.write.mode("overwrite").parquet(f"{out}/sink={name}/version={version}/tab={tab}")
                if name == "sheets" and version in failing:
                    failing.remove(version)
                    raise OSError(f"{name} gave way at version {version}")

        return write

    ledger, sinks = Ledger(house), {name: sink(name) for name in ("sheets", "database")}
    try:
        ledger.catch_up_all(sinks, schemas)
    except OSError:
        ledger.catch_up_all(sinks, schemas)
    written = spark.read.parquet(out).withColumn("version", F.col("version").cast("long"))
    return written.groupBy("sink", "tab", "version", "date_filter").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("key").alias("key_sum")
    )


@query(
    """
SELECT o_orderkey, o_custkey, 'late/' || c_custkey AS creator_link
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer) OR c_mktsegment = 'BUILDING'
UNION ALL
SELECT o_orderkey, o_custkey, 'N/A' FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
  WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer) OR c_mktsegment = 'BUILDING')
"""
)
def late_link_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that come late, first one customer's, then those of a segment, each into the files that need it."""
    house = Warehouse(spark, shared_dir(spark, "house"))
    customers = table(spark, sf_dir, "customer")
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.lit("N/A").alias("creator_link"),
        _year("o_orderdate").alias("date_filter"),
    )
    commit = house.commit()
    commit.append("orders", facts)
    commit.publish()
    richest = customers.agg(F.max("c_acctbal").alias("c_acctbal"))
    one = customers.join(richest, "c_acctbal", "left_semi")
    for late in (one, customers.where(F.col("c_mktsegment") == "BUILDING")):
        links = late.select(
            F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("late/"), "c_custkey").alias("link")
        )

        def enrich(stored: DataFrame, links: DataFrame = links) -> DataFrame:
            return lookup_first(stored, links, ["o_custkey"], "link", "o_custkey", into="creator_link")

        def open_rows(stored: DataFrame, links: DataFrame = links) -> DataFrame:
            return stored.where(F.col("creator_link") == "N/A").join(links, "o_custkey", "left_semi").select(stored.columns)

        backfill_files(house, "orders", facts.schema, enrich, "creator_link", open_rows)
    return house.read("orders", facts.schema).drop("date_filter")


@query(
    f"""
SELECT version, {_YEAR_SQL} AS date_filter, count(*) AS row_count
FROM orders, (VALUES (0), (1), (2)) v(version) WHERE o_orderkey % 3 <= version GROUP BY ALL
"""
)
def read_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of each version see, the log having grown since."""
    house = Warehouse(spark, shared_dir(spark, "house"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), _year("o_orderdate").alias("date_filter")
    )
    for batch in range(3):
        append_stream(house, "landing", batch, {"orders": orders.where(F.col("key") % 3 == batch)}, {"orders": ["key"]}, "key")
    seen = [
        house.read("orders", orders.schema, state=house.state(v)).withColumn("version", F.lit(v)) for v in house.versions()
    ]
    return reduce(DataFrame.unionByName, seen).groupBy("version", "date_filter").agg(F.count(F.lit(1)).alias("row_count"))
