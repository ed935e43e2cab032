"""Sheets: one directory per sheet under a workbook folder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snaplake.sources.tables import load_first, overwrite_snapshot, overwrite_table

# Text is kept as it is: quotes doubled, newlines inside, outer space untouched.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _options(fmt: str) -> dict[str, object]:
    return CSV_OPTIONS if fmt == "csv" else {}


def sheet_path(book: str, sheet: str) -> str:
    return f"{book.rstrip('/')}/{sheet}"


def write_sheet(
    df: DataFrame,
    book: str,
    sheet: str,
    fmt: str = "parquet",
    partition: str | None = None,
    value: str | None = None,
) -> None:
    """Rewrite a sheet, or with ``partition`` only the partitions in ``df``.

    A frame without rows leaves a Parquet sheet that still has its schema; for a
    partitioned sheet ``value`` says which partition it empties.
    """
    path = sheet_path(book, sheet)
    if partition is None:
        overwrite_table(df, path, fmt, **_options(fmt))
    else:
        overwrite_snapshot(df, path, partition, fmt, value, **_options(fmt))


def write_sheets(frames: Mapping[str, DataFrame], book: str, fmt: str = "parquet") -> None:
    for sheet, df in frames.items():
        write_sheet(df, book, sheet, fmt)


def read_sheet(
    spark: SparkSession, book: str, sheet: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A sheet under its declared schema; empty when there is none.

    In a CSV sheet an empty cell is a missing value, as it is in a workbook.
    """
    return load_first(spark, [(sheet_path(book, sheet), fmt)], schema, **_options(fmt))
