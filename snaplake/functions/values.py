"""Missing values, defaults and value predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake.fixed import AUDIENCE_TEXTS, MISSING_TEXTS, NA, PLACEHOLDER_TEXTS


def na_default(value: Column, default: str = NA) -> Column:
    """NULL becomes the sentinel; every other value stays as it is."""
    return F.coalesce(value, F.lit(default))


def na_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(NA))


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def is_valid(value: Column) -> Column:
    """True for a real value: not NULL, not empty, not a missing-value text."""
    return value.isNotNull() & ~value.isin(*MISSING_TEXTS)


def any_ready(values: Column) -> Column:
    """True when an array of metric texts holds at least one loaded value."""
    return F.coalesce(
        F.exists(values, lambda v: ~v.isin(*PLACEHOLDER_TEXTS)), F.lit(False)
    )


def is_ready(value: Column) -> Column:
    """Row-wise form of :func:`any_ready`, to be combined with ``bool_or``."""
    return F.coalesce(~value.isin(*PLACEHOLDER_TEXTS), F.lit(False))


def contains_any(value: Column, texts: tuple[str, ...] = AUDIENCE_TEXTS) -> Column:
    found = F.lit(False)
    for text in texts:
        found = found | value.contains(text)
    return found


def content_type(is_ad: Column) -> Column:
    return F.when(is_ad, F.lit("AD")).otherwise(F.lit("Normal"))


def known_or_existing(found: Column, existing: Column) -> Column:
    """The found value unless it is missing, else the present one, else ``N/A``."""
    return F.coalesce(na_to_null(found), existing, F.lit(NA))
