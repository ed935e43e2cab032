"""Order-dependent deduplication.

"First" always means smallest in the explicit ingest order. The first row of a
group is found with ``min_by``, which combines before the shuffle: a group that
holds a third of the table leaves each map task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.fixed import NA
from snaplake.operators.keys import (
    Seq,
    names,
    ordering,
    plain_keys,
    text_keys,
    with_digest,
    with_keys,
)


def _first_rows(df: DataFrame, keys: list[str], texts: list[str], seq: Seq) -> DataFrame:
    """First rows, with the digest of the text keys where there are any."""
    front = ["_digest"] if texts else []
    rest = [c for c in df.columns if c not in keys]
    keyed = with_digest(df, "_digest", texts) if texts else df
    if not rest:
        return keyed.select(*front, *df.columns).distinct()
    first = keyed.groupBy(*front, *keys).agg(
        F.min_by(F.struct(*rest), ordering(seq)).alias("_first")
    )
    columns = [F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns]
    return first.select(*front, *columns)


def dedup_first(df: DataFrame, subset: str | Sequence[str], seq: Seq) -> DataFrame:
    """The first row of each ``subset`` group, with the columns of ``df``."""
    keys = names(subset)
    return _first_rows(df, keys, text_keys(keys, df), seq).select(*df.columns)


def dedup_new(
    new: DataFrame, stored: DataFrame | None, on: str | Sequence[str], seq: Seq
) -> DataFrame:
    """The first row of each key that is not among the stored keys.

    The anti-join meets one row per key, on the partitioning that finding the
    first rows has made: no hot key, and no further shuffle of the rows. Missing
    text keys come out as ``N/A``; for other keys NULL equals NULL.
    """
    on = names(on)
    keyed = with_keys(new, on)
    if stored is None:
        return dedup_first(keyed, on, seq)
    texts = text_keys(on, new, stored)
    keyed, plain = plain_keys(keyed, on)
    first = _first_rows(keyed, plain, texts, seq)
    known = plain_keys(with_keys(stored, on), on)[0].select(*plain)
    if texts:
        known = with_digest(known, "_digest", texts).select("_digest", *plain)
    return first.join(known.distinct(), known.columns, "left_anti").select(*new.columns)


def first_value(
    df: DataFrame,
    on: Sequence[str],
    value: str,
    seq: Seq,
    prefer_real: bool = False,
) -> DataFrame:
    """Keys to first value. ``prefer_real`` ranks any known value before ``N/A``."""
    order = ordering(seq)
    if prefer_real:
        order = F.struct((F.coalesce(F.col(value), F.lit(NA)) == NA).alias("na"), order.alias("o"))
    return df.groupBy(*on).agg(F.min_by(value, order).alias(value))


def dedup_dual_key(
    new: DataFrame,
    stored: DataFrame | None,
    parent: Sequence[str],
    name: str,
    link: str,
    seq: Seq,
    exempt_na: bool,
) -> DataFrame:
    """Rows a greedy pass in ingest order keeps when it tests name, then link.

    A row goes if its (parent, name) is stored or was met before; of those left,
    a row goes if its (parent, link) is stored or belongs to a row kept before.
    A row dropped for its link still uses up its name; a row dropped for its
    name does not use up its link. Hence two plain stages: first row per name,
    then, among these, first row per link. Stored ``N/A`` links never count.
    With ``exempt_na`` rows whose link is ``N/A`` all pass the link stage.
    Missing parents, names and links come out as ``N/A``.

    Each stage is a :func:`dedup_new`, so the rows are shuffled twice in all.
    """
    parent = names(parent)

    def slot(df: DataFrame, exempt: Column) -> DataFrame:
        # An exempt row takes a slot of its own, told apart by its name: such
        # rows neither drop each other nor meet in one group.
        taken = F.when(exempt, F.concat(F.lit("name "), F.col(name))).otherwise(
            F.concat(F.lit("link "), F.col(link))
        )
        return df.withColumn("_slot", taken)

    new = with_keys(new, [*parent, name, link])
    known = None
    if stored is not None:
        stored = with_keys(stored, [*parent, name, link])
        known = slot(stored.where(F.col(link) != NA), F.lit(False))
    kept = dedup_new(new, stored, [*parent, name], seq)
    exempt = (F.col(link) == NA) if exempt_na else F.lit(False)
    return dedup_new(slot(kept, exempt), known, [*parent, "_slot"], seq).select(*new.columns)
