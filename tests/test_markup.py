"""Fields and tiles out of landed markup."""

import subprocess
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from snaplake import fixed
from snaplake.functions import text
from snaplake.operators import extract, markup
from snaplake.operators.markup import metric, parse
from snaplake.plans import records

TILES = """
<div class="x Layout-CoreMetrics y">
  <div class="item"><div class="label"><div class="line-clamp-2"> Revenue </div></div>
    <div class="value">1
.2k</div></div>
  <div class="item"><div class="label"><div class="line-clamp-2">Item Sold</div></div>
    <div class="value">-</div></div>
  <div class="item"><div class="label"><div class="line-clamp-2">Revenue</div></div>
    <div class="value">&#163;3</div></div>
  <div class="item"><div class="label"><div class="line-clamp-2"></div></div><div class="value">9</div></div>
  <div class="item"><div class="label">no inner label</div><div class="value">9</div></div>
</div>
<div class="item"><div class="label"><div class="line-clamp-2">Views</div></div><div class="value">outside</div></div>
"""


def one(spark, html, rules, metrics=False):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(parse(F.col("html"), rules, metrics).alias("d"))


def test_metric_tiles(spark):
    df = one(spark, TILES, [], metrics=True)
    row = df.select(
        text.join_lines(metric(F.col("d.metrics"), "Revenue")).alias("last"),
        metric(F.col("d.metrics"), "Item Sold").alias("sold"),
        metric(F.col("d.metrics"), "Views").alias("views"),
        F.size("d.metrics").alias("n"),
    ).first()
    assert tuple(row) == ("£3", "-", None, 4)


def test_creator_page(spark):
    html = """<p>broken <b>markup<br>
    <a href="/x">no</a><a href="https://www.tiktok.com/@bob?a=1&amp;b=2">yes</a>
    <div class="mcn-box"><div><div class="text-base-666">Agency</div></div></div>
    <div class="text-base-666">Debut Time : 2024: a</div>
    <div>Creator Bio:</div><div>line one
line two</div>
    <span>Female Majority</span>
    <div class="flex gap-[4px]"><span>all</span><span>18-24</span></div>
    <div class="table-row"><div>Followers</div><div>1.2k</div></div>"""
    shop = one(spark, html, fixed.SHOP_CREATOR_RULES).select("d.*").first().asDict()
    assert shop["tiktok_link"] == "https://www.tiktok.com/@bob?a=1&b=2"
    assert shop["mcn"] == "Agency"
    assert shop["debut_text"] == "Debut Time : 2024: a"
    assert shop["bio"] == "line one\nline two"
    assert shop["target_sexual"] == "Female Majority"
    assert shop["target_age"] == "18-24"
    assert "Followers" in shop["followers_text"] and "1.2k" in shop["followers_text"]
    product = one(spark, html, fixed.PRODUCT_CREATOR_RULES).select("d.*").first()
    assert product["followers_text"] == "1.2k"
    empty = one(spark, None, fixed.SHOP_CREATOR_RULES).select("d.*").first()
    assert all(v is None for v in empty)


def test_row_cells(spark):
    row = """<tr data-row-key="1"><td>1</td><td><div class="line-clamp-1">Bob</div></td>
      <td> Seller </td><td>$4</td></tr>"""
    got = one(spark, row, fixed.ROW_RULES["shop_creator"]).select("d.*").first()
    assert tuple(got) == ("Bob", "Seller")
    short = one(spark, "<tr><td>1</td></tr>", fixed.ROW_RULES["shop_creator"]).select("d.*").first()
    assert tuple(short) == (None, None)


def test_jvm_patterns(spark):
    html = '<a href="/a">x</a><a href="/the">y</a><ul><li>1</li><li class="z">2\n3</li></ul>'
    df = spark.createDataFrame([(1, html), (2, "<link>")], "id long, html string")
    rows = df.select(
        extract.first_link(F.col("html"), "the").alias("a"),
        extract.nth_element(F.col("html"), "li", 2).alias("b"),
        extract.nth_element(F.col("html"), "li", 3).alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [("/the", "2\n3", None), ("N/A", None, None)]
    long = extract.label_values(df, "id", "html", {"first": "<li>(.*?)</li>", "no": "<h1>(.*)</h1>"})
    assert [tuple(r) for r in long.collect()] == [(1, 0, "first", "1")]


def test_parser_travels_without_the_package(tmp_path):
    pickled = tmp_path / "page"
    pickled.write_bytes(cloudpickle.dumps(markup._Page))
    code = f"import pickle; P = pickle.load(open({str(pickled)!r}, 'rb')); p = P('<p>a<b>c'); print(p.text(0), len(p.metrics()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={}, capture_output=True, text=True)
    assert done.stdout.split() == ["ac", "0"], done.stderr


def test_row_is_parsed_once(spark):
    pages = spark.createDataFrame([("<td>", "x")], "row_html string, url string")
    named = records.with_row(pages, "video").withColumn("item_title", F.col("row.name"))
    plan = named.select("item_title", "row.revenue")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


BIO = next(r for r in fixed.CREATOR_RULES if r["field"] == "bio")


def field(html, rule):
    return markup._Page(html).find(rule)


def test_the_value_stands_beside_its_label():
    label = "<div>Creator Bio:</div>"
    last = f"<div><div>x</div>{label}</div><div>Recent videos</div>"
    assert field(last, BIO) is None
    icon = f"<div>{label}<span><div>icon</div></span><div>the bio</div></div>"
    assert field(icon, BIO) == "the bio"
    assert field(f'<div><div class="a flex-1">before</div>{label}<div>past</div></div>', BIO) == "before"
    rules = {r["field"]: r for r in fixed.VIDEO_RULES}
    page = '<p><div class="text-base-999">Publish Date</div><b><div>no</div></b><div>2025</div></p>'
    assert field(page, rules["publish_date"]) == "2025"


def test_positions_count_within_one_parent():
    rules = {r["field"]: r for r in fixed.LIVE_RULES}
    short = '<div class="table"><div class="table-row"><span>a</span></div></div>'
    page = short + (
        '<div class="table"><div class="table-row"><span>b</span></div>'
        '<div class="table-row"><b><span>deep</span></b><span>10:00</span>'
        '<i><div class="table-cell">deep</div></i><div class="table-cell">1h</div></div></div>'
    )
    assert field(page, rules["livestream_time"]) == "10:00"
    assert field(page, rules["duration"]) == "1h"


def test_omitted_end_tags():
    row = "<tr><td>1<td><div class='line-clamp-1'>Bob</div><td>Seller<td>$4"
    rules = {r["field"]: r for r in fixed.ROW_RULES["shop_creator"]}
    assert field(row, rules["account_type"]) == "Seller"
    assert field(row, rules["name"]) == "Bob"
    third = {"field": "x", "tag": "li", "inside": ("li", "", 3)}
    assert field("<ul><li>a<ul><li>n<li>m</ul><li>b<p>c<p>d<li>e</ul>", third) == "e"
    second = {"field": "x", "tag": "p", "inside": ("p", "", 2)}
    assert field("<p>one<p>two<div>no</div>", second) == "two"


def test_time_grows_with_the_page():
    import time

    def seconds(depth):
        html = "<span>" * depth + "Majority - k" + "</span>" * depth
        started = time.perf_counter()
        page = markup._Page(html)
        for rule in [*fixed.PRODUCT_CREATOR_RULES, *fixed.PRODUCT_RULES]:
            page.find(rule)
        return time.perf_counter() - started

    short, deep = min(seconds(2_000) for _ in range(3)), min(seconds(16_000) for _ in range(3))
    assert deep < 24 * short


def test_fields_read_one_after_the_other(spark):
    html = '<span>Reviews: 12</span><div class="product-sku">SKU (3)</div>'
    df = spark.createDataFrame([(html, "r")], "html string, row string")
    found = records.products(df).select("rating", "number_of_reviews", "product_skus").first()
    assert tuple(found) == ("N/A", "N/A", "N/A")
