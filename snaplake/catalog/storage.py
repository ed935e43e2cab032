"""Sheets, tables and sinks: written, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.catalog import query, table
from snaplake.functions.dates import month_snapshot
from snaplake.session import shared_dir
from snaplake.sources import sheets, tables


def _fields(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


@query(
    """
SELECT 'supplier' AS sheet, s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name, c_acctbal FROM customer
"""
)
def sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = shared_dir(spark, "book")
    schema = _fields(("key", T.LongType()), ("name", T.StringType()), ("balance", T.DoubleType()))
    sheets.write_sheets(
        {
            "supplier": table(spark, sf_dir, "supplier").selectExpr(
                "s_suppkey AS key", "s_name AS name", "s_acctbal AS balance"
            ),
            "customer": table(spark, sf_dir, "customer").selectExpr(
                "c_custkey AS key", "c_name AS name", "c_acctbal AS balance"
            ),
        },
        book,
        "csv",
    )
    frames = [
        sheets.read_sheet(spark, book, sheet, schema, "csv").withColumn("sheet", F.lit(sheet))
        for sheet in ("supplier", "customer")
    ]
    return reduce(DataFrame.unionByName, frames)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _fields(
        ("s_suppkey", T.LongType()),
        ("s_name", T.StringType()),
        ("s_nationkey", T.IntegerType()),
        ("s_acctbal", T.DoubleType()),
    )
    absent = shared_dir(spark, "absent")
    return tables.load_first(spark, [absent, f"{sf_dir}/supplier.parquet"], schema)


def _month_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", month_snapshot(F.col("o_orderdate")).alias("date_filter")
    )


_MONTH_SQL = """strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || ' ~ ' ||
       strftime(last_day(o_orderdate), '%Y-%m-%d')"""


@query(
    f"""
SELECT o_orderkey, {_MONTH_SQL} AS date_filter,
       CASE WHEN year(o_orderdate) = 1997 THEN 'second' ELSE 'first' END AS written
FROM orders
"""
)
def sheet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second save replaces the snapshots it holds, and no others."""
    book = shared_dir(spark, "book")
    orders = _month_orders(spark, sf_dir).select("o_orderkey", "date_filter")
    again = orders.where(F.col("date_filter").startswith("1997-"))
    for name, rows in (("first", orders), ("second", again)):
        saved = rows.withColumn("written", F.lit(name))
        sheets.write_sheet(saved, book, "Orders", partition="date_filter")
    schema = _fields(
        ("o_orderkey", T.LongType()), ("written", T.StringType()), ("date_filter", T.StringType())
    )
    return sheets.read_sheet(spark, book, "Orders", schema)


@query(
    """
SELECT 'creators' AS table_name, c_custkey AS key, c_name AS name FROM customer
UNION ALL SELECT 'products', p_partkey, p_name FROM part
UNION ALL SELECT 'shops', s_suppkey, s_name FROM supplier
"""
)
def table_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = reduce(
        DataFrame.unionByName,
        [
            table(spark, sf_dir, source).selectExpr(
                f"'{tag}' AS tag", f"{key} AS key", f"{name} AS name"
            )
            for tag, source, key, name in (
                ("creators", "customer", "c_custkey", "c_name"),
                ("products", "part", "p_partkey", "p_name"),
                ("shops", "supplier", "s_suppkey", "s_name"),
            )
        ],
    )
    root = shared_dir(spark, "routed")
    schema = _fields(("key", T.LongType()), ("name", T.StringType()))
    tables.route_tables(mixed, "tag", root)
    frames = [
        tables.routed_table(spark, root, "tag", name, schema).withColumn("table_name", F.lit(name))
        for name in ("creators", "products", "shops")
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    """
SELECT sink, p_partkey, p_name, p_retailprice FROM part, (VALUES ('sheet'), ('table')) t(sink)
"""
)
def dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, book = shared_dir(spark, "warehouse"), shared_dir(spark, "book")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    tables.dual_sink(
        parts,
        lambda df: tables.append_rows(df, tables.table_path(root, "part"), None),
        lambda df: sheets.write_sheet(df, book, "part", "csv"),
    )
    stored = tables.load_first(spark, [tables.table_path(root, "part")], parts.schema)
    sheet = sheets.read_sheet(spark, book, "part", parts.schema, "csv")
    return stored.withColumn("sink", F.lit("table")).unionByName(
        sheet.withColumn("sink", F.lit("sheet"))
    )


@query(
    """
SELECT 'all' AS sheet, column_name, column_type, (SELECT count(*) FROM customer) AS row_count
FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_acctbal', 'double'))
  t(column_name, column_type)
UNION ALL
SELECT 'unnamed', column_name, column_type, (SELECT count(*) FROM customer WHERE c_name = '')
FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_acctbal', 'double'))
  t(column_name, column_type)
"""
)
def empty_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet without rows still has its columns; described per column."""
    book = shared_dir(spark, "book")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    unnamed = customers.where(F.col("c_name") == "")
    sheets.write_sheets({"all": customers, "unnamed": unnamed}, book)

    def described(sheet: str) -> DataFrame:
        stored = spark.read.parquet(sheets.sheet_path(book, sheet))
        columns = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("column_type"),
                )
                for f in stored.schema.fields
            ]
        )
        counted = stored.agg(F.count(F.lit(1)).alias("row_count"))
        return counted.select(F.lit(sheet).alias("sheet"), "row_count", F.inline(columns))

    return described("all").unionByName(described("unnamed"))


@query(
    f"""
SELECT {_MONTH_SQL} AS date_filter, count(*) AS row_count, count(DISTINCT o_orderkey) AS key_count
FROM orders GROUP BY 1
"""
)
def snapshot_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading a snapshot again leaves its rows as they were."""
    path = shared_dir(spark, "orders")
    orders = _month_orders(spark, sf_dir)
    tables.overwrite_snapshot(orders, path)
    tables.overwrite_snapshot(orders.where(F.col("date_filter").startswith("1997-")), path)
    return (
        spark.read.schema(orders.schema)
        .parquet(path)
        .groupBy("date_filter")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("o_orderkey").alias("key_count"),
        )
    )


@query(
    """
SELECT 'https://s.example/' || l_suppkey AS shop_link, p_name AS product_name,
       arg_min('/p/' || l_partkey,
               row(CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END, l_orderkey,
                   l_linenumber, l_partkey)) AS product_link
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
"""
)
def product_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into the unique dimension: what is stored first stays."""
    path = shared_dir(spark, "product_dim")
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("https://s.example/"), "l_suppkey").alias("shop_link"),
            F.col("p_name").alias("product_name"),
            F.concat(F.lit("/p/"), "l_partkey").alias("product_link"),
            F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("seq"),
            "l_shipdate",
        )
    )
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    for load in (lines.where(early), lines.where(~early)):
        tables.upsert_dim(load.drop("l_shipdate"), path, ["shop_link", "product_name"])
    return spark.read.parquet(path).drop("seq")
