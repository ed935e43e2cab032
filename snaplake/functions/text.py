"""Text cleaning and text extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake import fixed
from snaplake.functions.values import empty_to_null


def strip(text: Column) -> Column:
    """Python ``str.strip()``: Spark's plain ``trim`` only removes U+0020."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def normalise_key(text: Column) -> Column:
    return F.lower(strip(text))


def normalise_handle(text: Column) -> Column:
    """Lookup form of a creator handle: key form without leading ``@`` signs."""
    return strip_at(normalise_key(text))


def strip_at(text: Column) -> Column:
    return F.ltrim(text, F.lit("@"))


def join_lines(text: Column) -> Column:
    """Metric values: newlines vanish, outer space goes."""
    return strip(F.replace(text, F.lit("\n"), F.lit("")))


def flatten_lines(text: Column) -> Column:
    """Biographies: each newline becomes one space."""
    return F.replace(text, F.lit("\n"), F.lit(" "))


def clean_name(text: Column) -> Column:
    """Product names: flattened and stripped."""
    return strip(flatten_lines(text))


def first_nonempty(*texts: Column) -> Column:
    """First text that is non-empty after cleaning; the last one is the default."""
    cleaned = [join_lines(t) for t in texts]
    return F.coalesce(*[empty_to_null(t) for t in cleaned[:-1]], cleaned[-1])


def first_match(text: Column, *patterns: str) -> Column:
    """Group 1 of the first pattern that matches, else ``N/A``."""
    return F.coalesce(
        *[empty_to_null(F.regexp_extract(text, p, 1)) for p in patterns],
        F.lit(fixed.NA),
    )


def after_marker(text: Column, marker: str = fixed.MARKER) -> Column:
    """Stripped text after the first marker, or the text itself without one."""
    at = F.instr(text, marker)
    rest = text.substr(at + F.lit(len(marker)), F.char_length(text))
    return F.when(at > 0, strip(rest)).otherwise(text)


def before_slash(text: Column) -> Column:
    return strip(F.split_part(text, F.lit("/"), F.lit(1)))


def review_count(text: Column) -> Column:
    return first_match(text, fixed.REVIEWS_PATTERN)


def sku_count(text: Column) -> Column:
    return first_match(text, fixed.SKUS_PATTERN)


def ad_days(text: Column) -> Column:
    return first_match(text, fixed.AD_DAYS_PATTERN)


def followers(row_text: Column) -> Column:
    """Number after the word; else any number once the word is taken out."""
    flat = flatten_lines(row_text)
    without_word = F.replace(flat, F.lit(fixed.FOLLOWERS_WORD), F.lit(""))
    return F.coalesce(
        empty_to_null(F.regexp_extract(flat, fixed.FOLLOWERS_PATTERN, 1)),
        empty_to_null(F.regexp_extract(without_word, fixed.NUMBER_PATTERN, 1)),
        F.lit(fixed.NA),
    )


def followers_with_suffix(text: Column) -> Column:
    """The text when it carries a lower-case ``k`` or ``m``, else ``N/A``."""
    return F.when(text.contains("k") | text.contains("m"), text).otherwise(
        F.lit(fixed.NA)
    )


def compact_number(text: Column) -> Column:
    """First number token with its suffix, or the raw text without one."""
    return F.coalesce(empty_to_null(F.regexp_extract(text, fixed.NUMBER_PATTERN, 1)), text)
