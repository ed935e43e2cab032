"""Declared schemas of the seven tables, and conforming rows to them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.fixed import TABLE_HEADERS

SNAPSHOT = "date_filter"
SEQ = "seq"
LOAD_TIME = "created_at"
#: Metrics under labels that no header declares, by their full label.
OTHER_METRICS = "other_metrics"
OPEN_TABLES = ("shop_metrics", "product_metrics", "lives")


def snake(header: str) -> str:
    """Column name of a header: lower case, one underscore per run of other signs."""
    return re.sub(r"[^0-9a-z]+", "_", header.lower()).strip("_")


def table_schema(table: str) -> T.StructType:
    """Ingest order, the table's text columns, other metrics where pages may show any, load time; the snapshot comes last."""
    columns = [snake(h) for h in TABLE_HEADERS[table]]
    fields = [T.StructField(SEQ, T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in columns if c != SNAPSHOT]
    if table in OPEN_TABLES:
        fields.append(T.StructField(OTHER_METRICS, T.MapType(T.StringType(), T.StringType())))
    fields.append(T.StructField(LOAD_TIME, T.TimestampType()))
    if SNAPSHOT in columns:
        fields.append(T.StructField(SNAPSHOT, T.StringType()))
    return T.StructType(fields)


SCHEMAS = {table: table_schema(table) for table in TABLE_HEADERS}


def headers(table: str) -> dict[str, str]:
    """Column name to original header."""
    return {snake(h): h for h in TABLE_HEADERS[table]}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in order: absent ones NULL, extra ones gone.

    Values that do not fit the declared type become NULL instead of failing.
    """

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select([column(f) for f in schema.fields])
