"""Text, links and label/value pairs out of page markup, by JVM patterns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.fixed import NA
from snaplake.functions.values import empty_to_null


def first_link(html: Column, part: str) -> Column:
    """First ``href`` that holds ``part``, else ``N/A``."""
    pattern = f'href="([^"]*{re.escape(part)}[^"]*)"'
    return F.coalesce(empty_to_null(F.regexp_extract(html, pattern, 1)), F.lit(NA))


def nth_element(html: Column, element: str, n: int) -> Column:
    """Inner markup of the n-th (1-based) element of a kind; NULL when absent."""
    pattern = rf"(?s)<{element}(?:\s[^>]*)?>(.*?)</{element}>"
    return F.get(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), F.lit(n - 1))


def label_values(pages: DataFrame, key: str, html: str, rules: Mapping[str, str]) -> DataFrame:
    """One row per label whose pattern matches: key, pos, label, value.

    A rule is a pattern with one group, the value. All rules run in one pass
    over the markup, without a shuffle.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(pos).alias("pos"),
                F.lit(label).alias("label"),
                empty_to_null(F.regexp_extract(F.col(html), pattern, 1)).alias("value"),
            )
            for pos, (label, pattern) in enumerate(rules.items())
        ]
    )
    return pages.select(key, F.inline(F.filter(found, lambda f: f["value"].isNotNull())))
