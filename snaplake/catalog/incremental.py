"""Streams, cursors, late dimensions and the day spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import query, table
from snaplake.functions.dates import day_snapshot, month_snapshot
from snaplake.operators.dedup import dedup_dual_key
from snaplake.operators.enrich import lookup_first
from snaplake.operators.resume import past_cursor, resume_anti
from snaplake.session import shared_dir
from snaplake.sources import tables
from snaplake.sources.key_index import KeyIndex
from snaplake.sources.seen import SeenKeys
from snaplake.streaming import backfill, ingest


@query(
    """
SELECT event_id, user_id, event_type,
       CASE WHEN event_id % 50 = 0 THEN 'N/A'
            ELSE strftime(ts, '%Y-%m-%d') || ' ~ ' || strftime(ts, '%Y-%m-%d') END AS date_filter FROM events
"""
)
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings, each drained after it arrives, and one drain too many."""
    landing, path, checkpoint = (shared_dir(spark, n) for n in ("landing", "events", "offsets"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_id") % 50 != 0, day_snapshot(F.col("ts"))).alias("date_filter"),
    )
    day = F.substring("date_filter", 1, 10)
    # The second landing repeats the last days of the first one, and all rows without a day.
    undated = F.col("date_filter").isNull()
    landings = [
        undated | (day < "2024-01-11"),
        undated | day.between("2024-01-09", "2024-01-20"),
        day > "2024-01-20",
    ]
    for landed in [*landings, None]:
        if landed is not None:
            events.where(landed).write.mode("append").parquet(landing)
        stream = ingest.read_landing(spark, landing, events.schema, files_per_batch=8)
        ingest.append_stream(stream, path, checkpoint, ["event_id"], "event_id")
    return spark.read.schema(events.schema).parquet(path)


@query(
    """
SELECT event_id, user_id, event_type FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20')
"""
)
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    stored = events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    cursor = tables.saved_cursor(stored, "event_id")
    return past_cursor(events, "event_id", cursor).drop("ts")


@query(
    """
SELECT o_orderkey, o_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN 'late/' || c_custkey END,
       'N/A') AS creator_link
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""
)
def late_dim_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts are saved without links; the links come later and are filled in."""
    path = shared_dir(spark, "facts")
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.lit("N/A").alias("creator_link"),
        month_snapshot(F.col("o_orderdate")).alias("date_filter"),
    )
    tables.overwrite_snapshot(facts, path)
    late = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select(
            F.col("c_custkey").alias("o_custkey"),
            F.concat(F.lit("late/"), "c_custkey").alias("link"),
        )
    )

    def enrich(stored: DataFrame) -> DataFrame:
        return lookup_first(
            stored, late, ["o_custkey"], "link", "o_custkey", into="creator_link"
        )

    backfill.backfill_late(spark, path, late, ["o_custkey"], enrich)
    return spark.read.schema(facts.schema).parquet(path).drop("date_filter")


@query(
    """
WITH days AS (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
  FROM orders)
SELECT strftime(day, '%Y-%m-%d') || ' ~ ' || strftime(day, '%Y-%m-%d') AS date_filter,
       count(o_orderkey) AS row_count
FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1
"""
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the history with the number of rows loaded for it."""
    orders = table(spark, sf_dir, "orders")
    loaded = orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return (
        backfill.data_spine(orders, "o_orderdate")
        .join(loaded, "day", "left")
        .select("date_filter", F.coalesce("row_count", F.lit(0)).alias("row_count"))
    )


@query(
    """
WITH days AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY)) AS DATE)
    AS day)
SELECT strftime(day, '%Y-%m-%d') AS day FROM days
WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
"""
)
def missing_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = table(spark, sf_dir, "orders").select(
        day_snapshot(F.col("o_orderdate")).alias("date_filter")
    )
    missing = backfill.missing_snapshots(loaded, "1995-01-01", "2001-08-01")
    return missing.select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE year(o_orderdate) >= 1998
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997)
"""
)
def resume_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that no order of three earlier years has; these came year by year into a key index."""
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    index = KeyIndex(spark, shared_dir(spark, "keys"), "o_custkey")
    for of in (1995, 1996, 1997):
        index.add(orders.where(year == of))
    return index.unseen(orders.where(year >= 1998)).select("o_orderkey", "o_custkey")


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE year(l_shipdate) >= 1998 AND (l_partkey, l_suppkey) NOT IN (
  SELECT (l_partkey, l_suppkey) FROM lineitem WHERE year(l_shipdate) BETWEEN 1995 AND 1997)
"""
)
def resume_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of parts and suppliers that no line of three earlier years has. Filters by
    year let most of them pass; only the rest is asked of the stored years."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    year, on = F.year("l_shipdate"), ["l_partkey", "l_suppkey"]
    keys = lines.select(*on).schema
    seen = SeenKeys(spark, shared_dir(spark, "seen"), keys, blocks=256)
    for of in (1995, 1996, 1997):
        seen.add(lines.where(year == of), str(of))
    stored = lines.where(year.between(1995, 1997))
    fresh = seen.unseen(lines.where(year >= 1998), lambda rows: resume_anti(rows, stored, on), ["1995", "1996", "1997"])
    return fresh.drop("l_shipdate")


@query(
    """
WITH crawl AS (
  SELECT o_orderkey, o_custkey % 97 AS shop, o_clerk AS name,
         CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE 'u' || o_custkey END AS link, year(o_orderdate) < 1998 AS is_stored
  FROM (SELECT *, o_orderstatus || '|' || CAST(floor(o_totalprice / 100) AS BIGINT) AS o_clerk FROM orders)),
stored AS (SELECT * FROM crawl WHERE is_stored),
s1 AS (SELECT *, row_number() OVER (PARTITION BY shop, name ORDER BY o_orderkey) AS rn FROM crawl c
  WHERE NOT is_stored AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.shop = c.shop AND s.name = c.name)),
s2 AS (SELECT *, row_number() OVER (PARTITION BY shop, link ORDER BY o_orderkey) AS rn2 FROM s1 c
  WHERE rn = 1 AND NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.link <> 'N/A' AND s.shop = c.shop AND s.link = c.link))
SELECT o_orderkey, shop, name, link FROM s2 WHERE rn2 = 1 OR link = 'N/A'
"""
)
def resume_dual_key_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greedy resume by name, then link, with a filter before each of the two exact joins."""
    orders = table(spark, sf_dir, "orders")
    crawl = orders.select(
        "o_orderkey",
        (F.col("o_custkey") % 97).alias("shop"),
        F.concat("o_orderstatus", F.lit("|"), F.floor(F.col("o_totalprice") / 100).cast("string")).alias("name"),
        F.when(F.col("o_orderkey") % 7 == 0, "N/A").otherwise(F.concat(F.lit("u"), "o_custkey")).alias("link"),
        (F.year("o_orderdate") < 1998).alias("_stored"),
    )
    stored = crawl.where(F.col("_stored")).drop("_stored")
    linked = stored.where(F.col("link") != "N/A")
    new = crawl.where(~F.col("_stored")).drop("_stored")
    unseen = []
    for on, of in ((["shop", "name"], stored), (["shop", "link"], linked)):
        seen = SeenKeys(spark, shared_dir(spark, "seen"), of.select(*on).schema, blocks=64)
        seen.add(of, "N/A")
        unseen.append(lambda rows, seen=seen, on=on, of=of: seen.unseen(rows, lambda some: resume_anti(some, of, on)))
    by_name, by_link = unseen
    # A stored link drops all rows that share it, so it may be asked for after the first of them is found.
    kept = dedup_dual_key(by_name(new), None, ["shop"], "name", "link", "o_orderkey", exempt_na=True)
    return by_link(kept)
