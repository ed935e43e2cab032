"""The whole run of a snapshot, over pages made from the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import query, table
from snaplake.functions.dates import label
from snaplake.plans.daily import run
from snaplake.session import shared_dir
from snaplake.sources.pages import LANDED, land_pages
from snaplake.sources.tables import load_table

_DAY = "2025-10-01"
_SHOP = "https://data.example/shop/detail?id="
_PROFILE = "https://www.tiktok.com/@"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _pages(df: DataFrame, kind: str, seq: Column, shop: Column, product: Column, row: Column, url: Column, html: Column) -> DataFrame:
    """Landed pages of a kind; their address of the shop is the long one."""
    values = (seq, F.lit(kind), _text("https://data.example/shop/detail?x=1&id=", shop), product, row, url, html)
    landed = [v.alias(f.name) for v, f in zip((*values, F.lit(label(_DAY, _DAY))), LANDED.fields, strict=True)]
    return df.select(*landed)


def _row(name: Column, tag: str, cls: str) -> Column:
    """A list row that leaves its cells open."""
    return _text(f'<tr><td>1<td><{tag} class="{cls}">', name, f"</{tag}><td>$5<td>")


def _landings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The pages that land first, and those that land late: every third creator."""
    suppliers, parts, people = (table(spark, sf_dir, t) for t in ("supplier", "part", "customer"))
    none, url = F.lit(None).cast("string"), F.lit("u")
    tile = '<div class="item"><div class="label"><div class="line-clamp-2">Revenue</div></div><div class="value">$'
    s, p, c = F.col("s_suppkey"), F.col("p_partkey"), F.col("c_custkey")
    # Two parts show one product, ten products a shop; sixty customers' pages are about one product.
    named, about = F.floor(p / 2), F.floor(c / 60)
    shop = F.floor(about / 10)
    shops = _pages(
        suppliers, "shop", s, s, none, none, url,
        _text('<div class="Layout-CoreMetrics">', tile, F.col("s_nationkey"), "</div></div></div>"),
    )
    products = _pages(
        parts, "product", 1_000_000_000 + p, F.floor(named / 10), none,
        _row(_text("part ", named), "div", "line-clamp-2"), url,
        _text('<a href="https://t.example/p', p, '"><span>View on TikTok</span></a><span>4.5 /5</span>'),
    )
    shop_creators = _pages(
        people, "shop_creator", 2_500_000_000 + c, shop, none,
        _row(_text("s", F.floor(c / 2)), "div", "line-clamp-1"), url, _text(f'<a href="{_PROFILE}s', c, '">x</a>'),
    )
    late = c % 3 == 0
    profile = F.when(c % 9 == 0, "").otherwise(_text(f'<a href="{_PROFILE}u', c % 53, '">x</a>'))
    creators = _pages(
        people, "creator", F.when(late, 4_000_000_000 + c).otherwise(2_000_000_000 + c), shop,
        _text("part ", about), _row(_text("c", c % 41), "div", "line-clamp-1"), url,
        _text(profile, "<div><div>Creator Bio:</div></div><div>no bio</div>"),
    )
    shown = _text('<div class="text-ellipsis1 font-medium mb-1">@C', c % 41, "</div>")
    videos = _pages(
        people, "video", 3_000_000_000 + c, shop, _text("part ", about),
        _row(_text("clip ", c % 47), "span", "line-clamp-2"),
        _text("https://data.example/video/detail?id=", c % 11), shown,
    )
    lives = _pages(
        people, "live", 3_500_000_000 + c, shop, _text("part ", about),
        _row(_text("live ", c % 7), "div", "line-clamp-2"),
        _text("https://data.example/livestream/detail?id=", c), shown,
    )
    is_late = F.col("seq") > 4_000_000_000
    early = reduce(DataFrame.union, [shops, products, shop_creators, creators.where(~is_late), videos, lives])
    return [early, creators.where(is_late)]


@query(
    f"""
WITH about AS (
  SELECT c_custkey AS c, c_custkey // 60 AS k, c_custkey // 600 AS shop, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS late,
         'c' || (c_custkey % 41) AS name, CASE WHEN c_custkey % 9 = 0 THEN 'N/A' ELSE '{_PROFILE}u' || (c_custkey % 53) END AS link,
         'clip ' || (c_custkey % 47) AS title, '{_PROFILE}@C' || (c_custkey % 41) || '/video/' || (c_custkey % 11) AS video,
         '{_PROFILE}@C' || (c_custkey % 41) || '/live?room_id=' || c_custkey AS live FROM customer),
named AS (SELECT *, row_number() OVER (PARTITION BY k, name ORDER BY late, c) AS n FROM about),
creators AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, link ORDER BY late, c) AS m FROM named WHERE n = 1)
  WHERE m = 1),
titled AS (SELECT *, row_number() OVER (PARTITION BY k, title ORDER BY c) AS n FROM about),
videos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, video ORDER BY c) AS m FROM titled WHERE n = 1)
  WHERE m = 1),
products AS (SELECT p_partkey // 2 AS k, min(p_partkey) AS p FROM part GROUP BY 1)
SELECT 'shop_metrics' AS tab, '{_SHOP}' || s_suppkey AS shop, NULL AS product, NULL AS name,
       '$' || s_nationkey AS value, NULL AS link FROM supplier
UNION ALL
SELECT 'shop_creators', '{_SHOP}' || (min(c_custkey) // 600), NULL, 's' || (c_custkey // 2), NULL, '{_PROFILE}s' || min(c_custkey)
FROM customer GROUP BY c_custkey // 2
UNION ALL
SELECT 'product_metrics', '{_SHOP}' || (k // 10), 'part ' || k, NULL, '4.5', 'https://t.example/p' || p FROM products
UNION ALL
SELECT 'product_dim', '{_SHOP}' || (k // 10), 'part ' || k, NULL, NULL, 'https://t.example/p' || p FROM products
UNION ALL
SELECT 'product_creators', '{_SHOP}' || shop, 'part ' || k, name, coalesce('https://t.example/p' || p, 'N/A'), link
FROM creators LEFT JOIN products USING (k)
UNION ALL
SELECT 'videos', '{_SHOP}' || v.shop, 'part ' || v.k, v.title, v.video, coalesce(w.link, 'N/A')
FROM videos v LEFT JOIN creators w ON w.k = v.k AND w.name = v.name
UNION ALL
SELECT 'lives', '{_SHOP}' || v.shop, 'part ' || v.k, 'live ' || (v.c % 7), v.live, coalesce(w.link, 'N/A')
FROM about v LEFT JOIN creators w ON w.k = v.k AND w.name = v.name
"""
)
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed and loaded, late creators landed, all loaded again: the stored tables."""
    landing, warehouse = shared_dir(spark, "landing"), shared_dir(spark, "warehouse")
    landings = _landings(spark, sf_dir)
    for landed in landings:
        land_pages(landed, landing)
        run(spark, landing, warehouse, _DAY, _DAY, _SHOP, "data.example")
    shown = {
        "shop_metrics": ("shop_link", None, None, "shop_revenue", None),
        "shop_creators": ("shop_link", None, "creator_name", None, "tiktok_link"),
        "product_metrics": ("shop_link", "product_name", None, "rating", "tiktok_product_link"),
        "product_dim": ("shop_link", "product_name", None, None, "product_link"),
        "product_creators": ("shop_link", "product_name", "creator_name", "product_link", "tiktok_link"),
        "videos": ("shop_link", "product_name", "item_title", "link", "creator_link"),
        "lives": ("shop_link", "product_name", "item_title", "link", "creator_link"),
    }
    frames = []
    for name, columns in shown.items():
        stored = load_table(spark, warehouse, name)
        named = zip(("shop", "product", "name", "value", "link"), columns, strict=True)
        frames.append(
            stored.select(
                F.lit(name).alias("tab"),
                *((F.col(c) if c else F.lit(None).cast("string")).alias(n) for n, c in named),
            )
        )
    return reduce(DataFrame.unionByName, frames)
