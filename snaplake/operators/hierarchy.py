"""Parent keys carried down to leaf rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_levels(
    root: DataFrame, levels: Sequence[tuple[DataFrame, str, str]]
) -> DataFrame:
    """Join each level to the one above by (frame, parent key, child key).

    Join order and strategy are left to the optimizer, which broadcasts the
    levels whose size it knows to be small.
    """

    def add(above: DataFrame, level: tuple[DataFrame, str, str]) -> DataFrame:
        child, parent_key, child_key = level
        return above.join(child, above[parent_key] == child[child_key])

    return reduce(add, levels, root)


def explode_children(df: DataFrame, children: str, into: str) -> DataFrame:
    """One row per element of a nested list, with its position in the list."""
    keep = [c for c in df.columns if c != children]
    return df.select(*keep, F.posexplode(children).alias("pos", into))
