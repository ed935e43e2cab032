"""The registered queries: each operator bound to the shared test tables.

Every query runs over whole tables. Next to it stands the SQL that states the
same result for another engine, where SQL can state it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Ingest order of line items: the shortest column list that is unique.
LINE_SEQ = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    from snaplake.catalog import (  # noqa: F401
        columns,
        daily,
        dedup,
        extraction,
        incremental,
        lookups,
        scalars,
        storage,
        versioned,
    )
