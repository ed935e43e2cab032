"""Reshaping: metrics from long to wide, columns renamed, filled and united."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.functions.values import na_default
from snaplake.operators.dedup import dedup_first
from snaplake.operators.keys import Seq, names, ordering
from snaplake.schemas import snake


def last_values(
    long: DataFrame, key: str | Sequence[str], label: str, value: str, pos: Seq
) -> DataFrame:
    """The last value of each label per key; rows with an empty label do not count."""
    return (
        long.where(F.col(label) != "")
        .groupBy(*names(key), label)
        .agg(F.max_by(value, ordering(pos)).alias(value))
    )


def pivot_metrics(
    long: DataFrame,
    key: str | Sequence[str],
    label: str,
    value: str,
    pos: Seq,
    labels: Sequence[str],
    prefix: str = "",
) -> DataFrame:
    """One column per declared label with its last value.

    The labels are declared, so no job has to look for them, and all of them are
    filled by a single aggregation.
    """
    order = ordering(pos)

    def last_of(name: str):
        mine = F.col(label) == F.lit(name)
        column = snake(f"{prefix}{name}")
        return F.max_by(F.when(mine, F.col(value)), F.when(mine, order)).alias(column)

    return long.groupBy(*names(key)).agg(*[last_of(name) for name in labels])


def open_metrics(
    long: DataFrame,
    key: str | Sequence[str],
    label: str,
    value: str,
    pos: Seq,
    declared: Sequence[str],
    prefix: str = "",
    other: str = "other_metrics",
) -> DataFrame:
    """One column per declared label, and a map of all other labels, each with its last value.

    No label is lost and none has to be looked for first. A map holds the labels of one
    key; it is NULL where there are none. Empty labels do not count.
    """
    last = last_values(long, key, label, value, pos)

    def value_of(name: str) -> Column:
        return F.max(F.when(F.col(label) == name, F.col(value))).alias(snake(f"{prefix}{name}"))

    entry = F.struct(F.concat(F.lit(prefix), F.col(label)).alias("key"), F.col(value).alias("value"))
    entries = F.array_sort(F.collect_list(F.when(~F.col(label).isin(list(declared)), entry)))
    return last.groupBy(*names(key)).agg(
        *(value_of(name) for name in declared),
        F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias(other),
    )


def label_columns(df: DataFrame, other: str, taken: Sequence[str]) -> dict[str, Column]:
    """A column for every label in the ``other`` map, by a name that is not ``taken`` yet.

    The labels are looked for in ``df``; their number is that of the columns of a sheet.
    """
    found = df.select(F.explode(F.map_keys(other)).alias("label")).distinct().orderBy("label").collect()
    columns: dict[str, Column] = {}
    for row in found:
        base = name = snake(row["label"]) or "metric"
        number = 1
        while name in columns or name in taken:
            number += 1
            name = f"{base}_{number}"
        columns[name] = F.try_element_at(other, F.lit(row["label"]))
    return columns


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def fill_missing_column(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add a constant column where the frame lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))


def column_fallback(df: DataFrame, name: str, *candidates: str) -> DataFrame:
    """Add ``name`` from the first candidate column present, else ``N/A``.

    Only absence falls through: a present column keeps its NULLs.
    """
    present = [c for c in candidates if c in df.columns]
    value = F.col(present[0]) if present else na_default(F.lit(None).cast("string"))
    return df.withColumn(name, value)


def cast_all_string(df: DataFrame) -> DataFrame:
    """Every column as text; NULL stays NULL."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def union_ragged(*frames: DataFrame) -> DataFrame:
    """All rows under the union of all columns; holes are NULL."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united


def product_dim(products: DataFrame, seq: Seq, keep_seq: bool = False) -> DataFrame:
    """First link of each (shop, product), under the dimension's column names."""
    order = names(seq)
    named = products.select(
        *[na_default(F.col(c)).alias(c) for c in ("shop_link", "product_name")],
        na_default(F.col("tiktok_product_link")).alias("product_link"),
        *order,
    )
    first = dedup_first(named, ["shop_link", "product_name"], seq)
    return first if keep_seq else first.drop(*order)


def sync_counts(df: DataFrame, group: str, is_new: Column, is_updated: Column) -> DataFrame:
    """Rows per group, rows of this run, and rows it updated, in one pass."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_new).alias("new_rows"),
        F.count_if(is_updated).alias("updated"),
    )
