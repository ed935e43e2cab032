"""Landed pages to table records: names first, details only for what is new."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake import fixed
from snaplake.functions import text, urls, values
from snaplake.operators.markup import metric, parse
from snaplake.schemas import OTHER_METRICS, snake


def with_shop(landed: DataFrame, base: str) -> DataFrame:
    """The canonical shop address of each page."""
    return landed.withColumn("shop_link", urls.canonical_url(F.col("shop_url"), base))


def with_row(pages: DataFrame, kind: str) -> DataFrame:
    """The fields of the list row a page was opened from."""
    row = parse(F.col("row_html"), fixed.ROW_RULES[kind])
    return pages.withColumn("row", row).where(F.col("row.name").isNotNull())


def _na(name: str) -> Column:
    return values.na_default(F.col(name))


def _after(earlier: list[str], name: str) -> Column:
    """A detail field, missing where one that is read before it is missing."""
    found = [F.col(f"d.{e}").isNotNull() for e in earlier]
    return F.when(reduce(lambda a, b: a & b, found), F.col(f"d.{name}"))


def _metrics(labels: list[str], prefix: str) -> dict[str, Column]:
    return {
        snake(f"{prefix}{label}"): text.join_lines(metric(F.col("d.metrics"), label))
        for label in labels
    }


def _other_metrics(labels: list[str], prefix: str) -> dict[str, Column]:
    """The last value under each label that is not among ``labels``; NULL where a page has none."""
    tiles = F.filter("d.metrics", lambda m: (m["label"] != "") & ~m["label"].isin(labels))
    found = F.array_distinct(F.transform(tiles, lambda m: m["label"]))

    def last(name: Column) -> Column:
        return text.join_lines(F.try_element_at(F.filter(tiles, lambda m: m["label"] == name), F.lit(-1))["value"])

    named = F.transform(found, lambda name: F.concat(F.lit(prefix), name))
    return {OTHER_METRICS: F.when(F.size(found) > 0, F.map_from_arrays(named, F.transform(found, last)))}


def _detail(pages: DataFrame, rules: list, metrics: bool = False) -> DataFrame:
    return pages.withColumn("d", parse(F.col("html"), rules, metrics))


def _creator_columns() -> dict[str, Column]:
    bio = F.coalesce("d.bio", "d.bio_fallback")
    return {
        "tiktok_link": _na("d.tiktok_link"),
        "mcn": _na("d.mcn"),
        "debut_time": values.na_default(text.after_marker(F.col("d.debut_text"))),
        "creator_bio": values.na_default(text.flatten_lines(bio)),
        "target_sexual": _na("d.target_sexual"),
        "target_age": _na("d.target_age"),
    }


def shops(pages: DataFrame) -> DataFrame:
    return _detail(pages, [], metrics=True).withColumns(
        _metrics(fixed.SHOP_LABELS, "Shop_") | _other_metrics(fixed.SHOP_LABELS, "Shop_")
    )


def shop_creators(pages: DataFrame) -> DataFrame:
    return _detail(pages, fixed.SHOP_CREATOR_RULES).withColumns(
        {
            "account_type": _na("row.account_type"),
            **_creator_columns(),
            "followers": text.followers(F.col("d.followers_text")),
        }
    )


def products(pages: DataFrame) -> DataFrame:
    return _detail(pages, fixed.PRODUCT_RULES, metrics=True).withColumns(
        {
            "tiktok_product_link": _na("d.product_link"),
            "rating": values.na_default(text.before_slash(F.col("d.rating_text"))),
            # Read one after the other: the first that is missing ends it.
            "number_of_reviews": text.review_count(_after(["rating_text"], "reviews_text")),
            "product_skus": text.sku_count(_after(["rating_text", "reviews_text"], "skus_text")),
            **_metrics(fixed.PRODUCT_LABELS, "Product_"),
            **_other_metrics(fixed.PRODUCT_LABELS, "Product_"),
        }
    )


def product_creators(pages: DataFrame) -> DataFrame:
    return _detail(pages, fixed.PRODUCT_CREATOR_RULES).withColumns(
        {**_creator_columns(), "followers": _na("d.followers_text")}
    )


def videos(pages: DataFrame) -> DataFrame:
    creator = _na("d.creator")
    plain = ["item_sold", "new_followers_generated", "ad_view_ratio", "ad_revenue_ratio"]
    plain += ["ads_spending", "ad_roas", "publish_date"]
    return _detail(pages, fixed.VIDEO_RULES).withColumns(
        {
            "creator_name": text.strip_at(creator),
            "creator_link": F.lit(fixed.NA),
            "link": urls.video_link(creator, urls.query_param(F.col("url"), fixed.ID_PARAM)),
            "type": values.content_type(F.col("row.ad_mark").isNotNull()),
            "revenue": _na("row.revenue"),
            "advertising_period_days": text.ad_days(F.col("d.ad_period")),
            "views": values.na_default(text.compact_number(F.col("d.views"))),
            "video_duration": values.na_default(_after(["publish_date"], "video_duration")),
            **{name: _na(f"d.{name}") for name in plain},
        }
    )


def lives(pages: DataFrame, host: str) -> DataFrame:
    creator = _na("d.creator")
    room = urls.query_param(F.col("url"), fixed.ID_PARAM)
    shown = {
        snake(label): values.na_default(column)
        for label, column in zip(
            fixed.LIVE_LABELS, _metrics(fixed.LIVE_LABELS, "").values(), strict=True
        )
    }
    return _detail(pages, fixed.LIVE_RULES, metrics=True).withColumns(
        {
            "creator_name": text.strip_at(creator),
            "creator_link": F.lit(fixed.NA),
            "revenue": _na("row.revenue"),
            "link": urls.live_link(creator, room, urls.is_live_page(F.col("url"), host)),
            "livestream_time": _na("d.livestream_time"),
            "duration": _na("d.duration"),
            **shown,
            **_other_metrics(fixed.LIVE_LABELS, ""),
        }
    )
