"""Key lookups against first-wins dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.fixed import NA
from snaplake.functions.text import normalise_handle, normalise_key
from snaplake.functions.values import known_or_existing, na_default
from snaplake.operators.dedup import first_value
from snaplake.operators.keys import Seq, join_by, key_column, names, spreading


def _lookup_key(df: DataFrame, name: str, normalise: bool, handle: str | None) -> Column:
    if not normalise:
        return key_column(df, name)
    text = na_default(F.col(name).cast("string"))
    return normalise_handle(text) if name == handle else normalise_key(text)


def lookup_first(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    value: str,
    seq: Seq,
    default: str = NA,
    normalise: bool = False,
    handle: str | None = None,
    prefer_real: bool = False,
    into: str | None = None,
) -> DataFrame:
    """Add to each fact the first value its key has in ``dim``, else ``default``.

    ``normalise`` compares stripped lower-case keys; the ``handle`` key also
    loses leading ``@`` signs. With ``into`` the value updates that column: a
    known value replaces it, otherwise the present one stays.

    Facts may be skewed: the dimension is laid out so that adaptive execution can
    split the facts of a hot key (see :func:`snaplake.operators.keys.spread`).
    """
    keys = [f"_key_{c}" for c in on]
    order = [f"_seq_{c}" for c in names(seq)]
    dim_keyed = dim.select(
        *[_lookup_key(dim, c, normalise, handle).alias(k) for k, c in zip(keys, on)],
        F.col(value).alias("_value"),
        *[F.col(c).alias(o) for o, c in zip(order, names(seq))],
    ).withColumn("_spread", spreading(keys))
    first = first_value(dim_keyed, ["_spread", *keys], "_value", order, prefer_real)
    first = first.drop("_spread")
    if normalise:
        # Normalising is dear, so its result is kept for hashing and sorting.
        mine = [f"_my{k}" for k in keys]
        facts_keyed = facts.withColumns(
            {m: _lookup_key(facts, c, normalise, handle) for m, c in zip(mine, on)}
        )
        joined = join_by(facts_keyed, mine, first, keys, "left")
    else:
        joined = join_by(facts, on, first, keys, "left")
    if into is None:
        return joined.select(*facts.columns, na_default(F.col("_value"), default).alias(value))
    return joined.select(
        *[
            known_or_existing(F.col("_value"), F.col(c)).alias(c) if c == into else F.col(c)
            for c in facts.columns
        ]
    )


def enrich_creator_links(facts: DataFrame, creators: DataFrame, seq: Seq = "seq") -> DataFrame:
    """Fill ``creator_link`` of videos or lives from the product creators."""
    return lookup_first(
        facts,
        creators,
        on=["shop_link", "product_name", "creator_name"],
        value="tiktok_link",
        seq=seq,
        normalise=True,
        handle="creator_name",
        into="creator_link",
    )


def top_shops(shops: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` shops in list order."""
    return shops.orderBy(*order).limit(limit)


def children_of(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows whose parent is among ``parents``."""
    return children.join(parents.select(*on), list(on), "left_semi")
