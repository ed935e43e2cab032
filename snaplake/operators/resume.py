"""Resume: leave out what is stored, number pages, read past a cursor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.operators.keys import distinct_keys, join_by, names, spread
from snaplake.session import stage


def resume_anti(new: DataFrame, stored: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not among the stored keys; duplicates stay.

    Missing text keys count as ``N/A``. The stored keys are laid out for
    splitting the rows of a hot key.
    """
    on = names(on)
    keys = [f"_key_{c}" for c in on]
    known = spread(stored, on).withColumnsRenamed(dict(zip(on, keys)))
    return join_by(new, on, known, keys, "left_anti")


def key_union(stored: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Stored keys and keys of this run, each once."""
    return distinct_keys(stored.select(*on).union(new.select(*on)), on)


def number_pages(
    df: DataFrame, parent: Sequence[str], seq: str, page_size: int, parts: int | None = None
) -> DataFrame:
    """Add ``page``: 1-based page of a row within its parent, in ``seq`` order.

    Rows are laid out over ``parts`` (by default the shuffle partitions) by ranges of
    parent and ``seq``, whatever the values, so a part holds a share of a hot
    parent. They are numbered within (parent, part) and moved up by the counts of
    the parent's earlier parts. No task ever holds a whole parent; a window
    over parents sees one row per part.
    """
    parent = names(parent)
    group = ["_parent", "_slice"]
    rest = [c for c in df.columns if c not in parent]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A struct of the parent keys is never NULL itself, so the join below loses
    # no row whose parent is unknown.
    sliced = df.repartitionByRange(parts, *[F.col(c) for c in parent], F.col(seq)).select(
        F.struct(*parent).alias("_parent"), F.spark_partition_id().alias("_slice"), *rest
    )
    sliced = stage(sliced, "pages")  # the layout is the same for all that reads it
    before = Window.partitionBy("_parent").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    local = F.row_number().over(Window.partitionBy(*group).orderBy(seq))
    return (
        sliced.withColumn("_row", local)
        .join(offsets, group)
        .withColumn("page", _whole(F.col("_offset") + F.col("_row") - 1, page_size) + 1)
        .select(*[F.col(f"_parent.{c}") if c in parent else F.col(c) for c in df.columns], "page")
    )


def _whole(value: Column, divisor: int) -> Column:
    """Whole-number division, exact for any size."""
    return F.call_function("div", value, F.lit(divisor))


def resume_pages(
    new: DataFrame, done: DataFrame, parent: Sequence[str], page: str = "page"
) -> DataFrame:
    """Rows on pages that are not done."""
    return resume_anti(new, done, [*names(parent), page])


def past_cursor(df: DataFrame, seq: str, cursor: int) -> DataFrame:
    return df.where(F.col(seq) > F.lit(cursor))
