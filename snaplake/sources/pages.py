"""Landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# A page as the crawl lands it: the row of the list it was opened from, and the
# detail page itself. ``seq`` is the order in which pages were opened.
LANDED = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("shop_url", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("row_html", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("date_filter", T.StringType()),
    ]
)


def land_pages(pages: DataFrame, path: str) -> None:
    """Append pages under folders by snapshot and kind, so that a table reads its own."""
    pages.write.mode("append").partitionBy("date_filter", "kind").parquet(path)


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
