"""Pages: scan, links, elements, labelled values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.catalog import query, table
from snaplake.functions import text
from snaplake.operators import extract
from snaplake.operators.markup import metric, parse
from snaplake.schemas import snake
from snaplake.sources.pages import read_pages


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


@query("SELECT page_id, url, length(html) AS html_length FROM pages")
def page_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "page_id", "url", F.char_length("html").cast("long").alias("html_length")
    )


@query(
    """
SELECT page_id, coalesce(nullif(regexp_extract(html, 'href="([^"]*the[^"]*)"', 1), ''), 'N/A')
  AS link FROM pages
"""
)
def first_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "page_id", extract.first_link(F.col("html"), "the").alias("link")
    )


@query(
    """
SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)[2] AS cell FROM pages
"""
)
def nth_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select(
        "page_id", extract.nth_element(F.col("html"), "li", 2).alias("cell")
    )


@query(
    """
SELECT page_id, 0 AS pos, 'title' AS label, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS value
FROM pages WHERE regexp_extract(html, '(?s)<title>(.*?)</title>', 1) <> ''
UNION ALL
SELECT page_id, 1, 'heading', regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)
FROM pages WHERE regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) <> ''
UNION ALL
SELECT page_id, 2, 'footer', regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)
FROM pages WHERE regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) <> ''
"""
)
def label_value_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "title": r"(?s)<title>(.*?)</title>",
        "heading": r"(?s)<h1[^>]*>(.*?)</h1>",
        "footer": r"(?s)<footer>(.*?)</footer>",
    }
    return extract.label_values(_pages(spark, sf_dir), "page_id", "html", rules)


# A cut-off reference may lack its semicolon. The ampersand is last: what it
# leaves is not read again.
_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "''"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


def _unescaped(pattern: str) -> str:
    shown = f"regexp_extract(html, '{pattern}', 1)"
    for entity, sign in _ENTITIES:
        shown = f"regexp_replace({shown}, '{entity}?', '{sign}', 'g')"
    return f"trim({shown})"


@query(
    f"""
SELECT page_id, {_unescaped('(?s)<title>(.*?)</title>')} AS title,
       {_unescaped('(?s)<h1[^>]*>(.*?)</h1>')} AS heading,
       {_unescaped('(?s)<div class="ad">(.*?)</div>')} AS ad,
       {_unescaped('(?s)<footer>(.*?)</footer>')} AS footer,
       {_unescaped('(?s)<li>.*?</li><li><a[^>]*>(.*?)</a>')} AS second_item,
       nullif(regexp_extract(html, 'href="([^"]*the[^"]*)"', 1), '') AS link
FROM pages
"""
)
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields out of the whole markup, by element instead of by pattern."""
    rules = [
        {"field": "title", "tag": "title"},
        {"field": "heading", "tag": "h1"},
        {"field": "ad", "tag": "div", "cls": ["ad"]},
        {"field": "footer", "tag": "footer"},
        {"field": "second_item", "tag": "a", "inside": ("li", "", 2)},
        {"field": "link", "tag": "a", "attr": "href", "has": "the"},
    ]
    return _pages(spark, sf_dir).select("page_id", parse(F.col("html"), rules).alias("d")).select(
        "page_id", "d.*"
    )


@query(
    """
SELECT p_partkey, p_brand AS product_revenue, CAST(p_size AS VARCHAR) AS product_item_sold,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_name || ' & co' END AS product_product_card,
       p_type <> 'SMALL' AS has_card
FROM part
"""
)
def metric_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles as a product page shows them: the last value of a label counts."""

    def tile(label: str, value: Column) -> Column:
        return F.concat(
            F.lit('<div class="item"><div class="label"><div class="line-clamp-2">'),
            F.lit(f"{label}</div></div><div class='value'>"),
            value,
            F.lit("</div></div>"),
        )

    card = tile("Product Card", F.concat("p_name", F.lit("\n &amp; co")))
    page = F.concat(
        F.lit('<div class="Layout-CoreMetrics">'),
        tile("Revenue", F.col("p_retailprice").cast("string")),
        tile("Item Sold", F.col("p_size").cast("string")),
        tile(" Revenue ", F.concat(F.lit(" "), "p_brand", F.lit("<br>"))),
        F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(card),
        F.lit("</div>"),
    )
    # Parsing is dear and the table is one small file: its rows are spread over all cores.
    parts = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism)
    parsed = parts.select(
        "p_partkey", parse(page, [], metrics=True)["metrics"].alias("m")
    )
    shown = [
        text.join_lines(metric(F.col("m"), label)).alias(snake(f"Product_{label}"))
        for label in ("Revenue", "Item Sold", "Product Card")
    ]
    return parsed.select("p_partkey", *shown, (F.size("m") == 4).alias("has_card"))
