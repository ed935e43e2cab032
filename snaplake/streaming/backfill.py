"""Day spine, missing snapshots, idempotent reruns and late dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.functions.dates import day_snapshot
from snaplake.operators.keys import spread
from snaplake.operators.resume import resume_anti
from snaplake.schemas import SNAPSHOT
from snaplake.sources.tables import replace_snapshots


def data_spine(df: DataFrame, moment: str) -> DataFrame:
    """One row per day from the first to the last day of ``df``."""
    span = df.agg(
        F.min(moment).cast("date").alias("first"), F.max(moment).cast("date").alias("last")
    )
    return span.select(F.explode(F.sequence("first", "last")).alias("day")).select(
        "day", day_snapshot(F.col("day")).alias(SNAPSHOT)
    )


def date_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day, both ends included, with the day's snapshot label."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return (
        spark.range(1)
        .select(F.explode(days).alias("day"))
        .select("day", day_snapshot(F.col("day")).alias(SNAPSHOT))
    )


def missing_snapshots(loaded: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Days of the spine without a loaded snapshot."""
    spine = date_spine(loaded.sparkSession, start, end)
    return resume_anti(spine, loaded, SNAPSHOT)


def backfill_late(
    spark: SparkSession,
    path: str,
    late: DataFrame,
    on: Sequence[str],
    enrich: Callable[[DataFrame], DataFrame],
    partition: str = SNAPSHOT,
) -> None:
    """Enrich again, and rewrite, the partitions that late dimension rows touch."""
    stored = spark.read.parquet(path)
    touched = stored.join(spread(late, on), list(on), "left_semi")
    # Partition names only, of which the file listing holds all: with them as
    # literals the second read opens no other partition.
    labels = [row[0] for row in touched.select(partition).distinct().collect()]
    if not labels:
        return
    affected = stored.where(F.col(partition).isin(labels))
    replace_snapshots(enrich(affected).select(*stored.columns), path, partition)




def catch_up(
    loaded: DataFrame, start: str | date, end: str | date, load_day: Callable[[date], object]
) -> list[date]:
    """Load each missing day in order, one at a time; returns the days loaded."""
    missing = missing_snapshots(loaded, start, end).select("day").orderBy("day")
    days = [row["day"] for row in missing.collect()]  # no more than the spine has
    for day in days:
        load_day(day)
    return days
