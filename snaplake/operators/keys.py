"""Key columns shared by the dedup, resume and lookup operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.functions.values import na_default

Seq = str | Sequence[str]


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def ordering(seq: Seq) -> Column:
    """Ingest order: one column, or several compared left to right."""
    cols = names(seq)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def key_column(df: DataFrame, name: str) -> Column:
    """A key that never is NULL in text columns, so a join can meet it."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return na_default(F.col(name))
    return F.col(name)


def with_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The frame with missing text keys spelled out as ``N/A``."""
    texts = [c for c in on if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: key_column(df, c) for c in texts}) if texts else df


def text_keys(on: Sequence[str], *frames: DataFrame) -> list[str]:
    """The keys that are text in all frames."""
    return [c for c in on if all(isinstance(f.schema[c].dataType, T.StringType) for f in frames)]


def with_digest(df: DataFrame, name: str, on: Sequence[str]) -> DataFrame:
    """Add a digest of text keys, to stand before them in groups and joins.

    Sorting looks at the first eight bytes of a key before the rest. Addresses
    all begin alike, so on text keys that settles nothing; on a digest it
    settles nearly every comparison.
    """
    return df.withColumn(name, F.xxhash64(*on))


def plain_keys(df: DataFrame, on: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that are equal where the keys are, NULL included, and never NULL.

    Groups and joins over them share one partitioning, which null-safe equality
    would not. Text keys stand for themselves, once :func:`with_keys` has named
    the missing ones.
    """
    extra, plain = {}, []
    for c in on:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            plain.append(c)
            continue
        value = F.col(c) if isinstance(kind, T.NumericType) else F.col(c).cast("string")
        none = F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else F.lit("")
        extra[f"_{c}_value"] = F.coalesce(value, none)
        extra[f"_{c}_none"] = F.col(c).isNull()
        plain += [f"_{c}_value", f"_{c}_none"]
    return df.withColumns(extra) if extra else df, plain


def distinct_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The distinct key tuples, combined before the shuffle."""
    return df.select(*[key_column(df, c).alias(c) for c in on]).distinct()


def spread(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df``, ready to meet rows where one key may dominate.

    Grouping by a digest that the join does not use keeps the join from reusing
    the partitioning of the aggregate. Both join inputs then are plain shuffles,
    and only for those can adaptive execution split a partition that one hot key
    fills.
    """
    keys = df.select(*[key_column(df, c).alias(c) for c in on])
    return keys.withColumn("_spread", spreading(on)).distinct().drop("_spread")


def spreading(on: Sequence[str]) -> Column:
    """Digest for :func:`spread`, unlike that of :func:`with_digest`."""
    return F.xxhash64(F.lit("spread"), *on)


def join_by(
    left: DataFrame, on: Sequence[str], right: DataFrame, names: Sequence[str], how: str
) -> DataFrame:
    """Join the ``on`` keys of ``left`` to the named columns of ``right``.

    Key expressions as join keys save a second copy of the key in the shuffle.
    Missing text keys count as ``N/A``; for other types NULL equals NULL.
    """
    same = []
    texts = []
    for column, name in zip(on, names):
        key = key_column(left, column)
        if text_keys([column], left):
            same.append(key == F.col(name))
            if text_keys([name], right):
                texts.append((key, name))
        else:
            same.append(key.eqNullSafe(F.col(name)))
    if texts:
        right = with_digest(right, "_digest", [name for _, name in texts])
        same.insert(0, F.xxhash64(*[key for key, _ in texts]) == F.col("_digest"))
    return left.join(right, reduce(lambda a, b: a & b, same), how)
