"""Row filters over snapshots, days and category paths."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.functions.dates import label
from snaplake.schemas import SNAPSHOT


def in_days(moment: str, start: str | date, end: str | date) -> Column:
    """Moments from the first to the last day, both whole.

    Written as bounds on the column itself, which reach the Parquet scan.
    """
    first = F.lit(str(start)).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz")
    return (F.col(moment) >= first) & (F.col(moment) < after)


def date_range(df: DataFrame, moment: str, start: str | date, end: str | date) -> DataFrame:
    return df.where(in_days(moment, start, end))


def snapshot_rows(df: DataFrame, moment: str, start: str | date, end: str | date) -> DataFrame:
    """One snapshot of a table that is not partitioned by it, with its label."""
    return date_range(df, moment, start, end).withColumn(SNAPSHOT, F.lit(label(start, end)))


def category_path(df: DataFrame, path: Mapping[str, str]) -> DataFrame:
    """Rows on a category path, given as level column to value from the top."""
    for level, value in path.items():
        df = df.where(F.col(level) == F.lit(value))
    return df
