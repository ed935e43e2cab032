"""The same tables in a relational database, through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.fixed import TABLE_HEADERS
from snaplake.schemas import headers, snake

ROWS_PER_INSERT = 500


def read_options(
    url: str,
    table: str,
    parts: tuple[str, int, int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **(properties or {})}
    if parts is not None:
        named = zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), parts, strict=True)
        options |= {name: str(value) for name, value in named}
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    snapshot: str,
    columns: Sequence[str],
    parts: tuple[str, int, int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Columns of one snapshot; filter and column list are pushed to the database.

    ``parts`` (number column, lowest, highest, how many) reads over that many
    connections; without it one task reads all.
    """
    title = headers(table)
    df = spark.read.format("jdbc").options(**read_options(url, table, parts, properties)).load()
    return df.where(F.col("`Date Filter`") == F.lit(snapshot)).select(
        *[F.col(f"`{title[c]}`").alias(c) for c in columns]
    )


def append_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Append under the original headers, in batches of inserts."""
    columns = [F.col(snake(h)).alias(h) for h in TABLE_HEADERS[table] if snake(h) in df.columns]
    (
        df.select(*columns)
        .write.mode("append")
        .option("batchsize", ROWS_PER_INSERT)
        .jdbc(url, table, properties=dict(properties or {}))
    )
