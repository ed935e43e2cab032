"""URL parts, canonical URLs and link building.

Spark's ``parse_url`` rejects addresses that browsers and Python accept (spaces,
bad escapes), so the parts are cut out by anchored patterns instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaplake import fixed
from snaplake.functions.values import empty_to_null

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*[?]([^#]*)"
# An authority with one kind of bracket only; nothing of such an address counts.
_BROKEN_HOST = (
    r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
    r"(?:[^/?#\[]*\][^/?#\[]*|[^/?#\]]*\[[^/?#\]]*)(?:[/?#]|$)"
)
_BROKEN_ESCAPE = r"%(?![0-9A-Fa-f]{2})"


def _clean(url: Column) -> Column:
    """Without what browsers and Python drop: signs before the address, line breaks in it."""
    return F.regexp_replace(F.translate(url, "\t\r\n", ""), r"^[\x00-\x20]+", "")


def url_host(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _AUTHORITY, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_clean(url), _PATH, 1)


def percent_decode(text: Column) -> Column:
    """Decode ``%xx`` and ``+``; a broken escape stays as it is written."""
    return F.try_url_decode(F.regexp_replace(text, _BROKEN_ESCAPE, "%25"))


def query_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; NULL when absent."""
    clean = _clean(url)
    pairs = F.split(F.regexp_extract(clean, _QUERY, 1), "&")
    # The value starts after the first '='; a pair without '=' has none.
    values = F.transform(
        F.filter(
            pairs,
            lambda p: percent_decode(F.split_part(p, F.lit("="), F.lit(1))) == F.lit(name),
        ),
        lambda p: F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1),
    )
    first = F.get(F.filter(values, lambda v: v != ""), F.lit(0))
    return F.when(~clean.rlike(_BROKEN_HOST), percent_decode(first))


def canonical_url(url: Column, base: str, param: str = fixed.ID_PARAM) -> Column:
    """``base`` plus the id; the address itself when it carries no id."""
    return F.coalesce(F.concat(F.lit(base), query_param(url, param)), url)


def _link(*parts: Column) -> Column:
    """The joined parts, or ``N/A`` if one is missing."""
    return F.coalesce(F.concat(*parts), F.lit(fixed.NA))


def video_link(creator: Column, video_id: Column) -> Column:
    return _link(F.lit(fixed.PROFILE_BASE), creator, F.lit(fixed.VIDEO_PART), empty_to_null(video_id))


def is_live_page(url: Column, host: str | Column, path: str = fixed.LIVE_PATH) -> Column:
    return (url_host(url) == F.lit(host)) & url_path(url).contains(path)


def live_link(creator: Column, room_id: Column, on_live_page: Column) -> Column:
    """Room address for a live page with an id and a known creator, else ``N/A``."""
    shown = F.when(on_live_page, F.nullif(creator, F.lit(fixed.NA)))
    return _link(
        F.lit(fixed.PROFILE_BASE), shown, F.lit(fixed.LIVE_PART), empty_to_null(room_id)
    )
