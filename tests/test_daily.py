"""The whole run over landed pages: load, load again, late pages, shop cap."""

import pytest
from pyspark.sql import functions as F

from snaplake.fixed import SHEET_NAMES
from snaplake.plans.daily import run
from snaplake.sources.pages import LANDED
from snaplake.sources.sheets import sheet_path
from snaplake.sources.tables import load_table

BASE = "https://data.example/shop/detail?id="
HOST = "data.example"
DAY = "2025-10-01"
SNAPSHOT = f"{DAY} ~ {DAY}"


def tiles(**values):
    items = "".join(
        f'<div class="item"><div class="label"><div class="line-clamp-2">{k.replace("_", " ")}</div></div>'
        f'<div class="value">{v}</div></div>'
        for k, v in values.items()
    )
    return f'<div class="Layout-CoreMetrics">{items}</div>'


def row(name, third="", fourth="", clamp=1, tag="div", extra=""):
    return (
        f'<tr data-row-key="k"><td>1</td><td><{tag} class="line-clamp-{clamp}">{name}</{tag}>{extra}</td>'
        f"<td>{third}</td><td>{fourth}</td></tr>"
    )


def creator_page(link, followers="1.2k"):
    anchor = f'<a href="{link}">x</a>' if link else ""
    return (
        f'{anchor}<div class="mcn"><div class="text-base-666">Agency</div></div>'
        '<div class="text-base-666">Debut Time : 2024</div>'
        f'<div class="table-row"><div>Followers</div><div>{followers}</div></div>'
    )


def video_page(creator, views="1,234 views"):
    return (
        f'<div class="text-ellipsis1 font-medium">{creator}</div>'
        '<div class="text-base-999">Publish Date</div><div>2025-09-30</div>'
        '<div class="text-base-999">Duration</div><div>00:15</div>'
        '<div class="info">ran 7 Days</div>'
        f'<div class="labelViews">Views</div><div class="value"><div class="block">{views}</div></div>'
        '<div class="labelAd ROAS">r</div><div class="value"><div class="block">2.5</div></div>'
    )


def live_page(creator):
    return (
        f'<div class="text-ellipsis1 font-medium mb-1">{creator}</div>'
        '<div class="table"><div class="table-row"><span>a</span></div>'
        '<div class="table-row"><span>10:00</span><div class="table-cell">1h</div></div></div>'
        + tiles(**{"Views": "9", "Avg._Unit_Price": "$2"})
    )


def landed():
    shop1, shop2 = "https://data.example/shop/detail?x=1&id=1", "https://data.example/shop/detail?id=2&y"
    product_page = tiles(Revenue="$5", Item_Sold="3") + (
        '<a href="https://t.example/p1"><span>View on TikTok</span></a>'
        '<span>4.5 /5</span><span>Reviews: 12</span><div class="product-sku">SKU (3)</div>'
    )
    pages = [
        ("shop", shop1, None, None, shop1, tiles(Revenue="$1", Item_Sold="2")),
        ("shop_creator", shop1, None, row("Bob", "Seller"), "u", creator_page("https://www.tiktok.com/@bob")),
        ("shop_creator", shop1, None, row("Bob", "Other"), "u", creator_page("https://www.tiktok.com/@bob")),
        ("product", shop1, None, row("Red\nhat", clamp=2), "u", product_page),
        ("product", shop1, None, row("Red\nhat", clamp=2), "u", product_page),
        ("creator", shop1, "Red hat", row("@Bob"), "u", creator_page("https://www.tiktok.com/@bob")),
        ("creator", shop1, "Red hat", row("Bobby"), "u", creator_page("https://www.tiktok.com/@bob")),
        ("creator", shop1, "Red hat", row("Ann"), "u", creator_page(None, "500")),
        ("creator", shop1, "Red hat", row("Cid"), "u", creator_page(None)),
        ("video", shop1, "Red hat", row("T1", "$7", clamp=2, tag="span", extra='<svg><g id="AD"></g></svg>'),
         "https://data.example/video/detail?id=77", video_page("@bob")),
        ("video", shop1, "Red hat", row("T2", "$8", clamp=2, tag="span"),
         "https://data.example/video/detail?id=77", video_page("@bob")),
        ("video", shop1, "Red hat", row("T3", "$9", clamp=2, tag="span"), "no id", video_page("ann", "-")),
        ("video", shop1, "Red hat", row("T4", "$9", clamp=2, tag="span"), "no id", video_page("zed")),
        ("live", shop1, "Red hat", row("L1", "", "$3", clamp=2),
         "https://data.example/livestream/detail?id=5", live_page("@BOB")),
        ("live", shop1, "Red hat", row("L1", "", "$3", clamp=2), "https://other.example/x?id=5", live_page("cid")),
        ("shop", shop2, None, None, shop2, tiles(Revenue="$4")),
        ("product", shop2, None, row("Cup", clamp=2), "u", "<p>nothing"),
    ]
    return [(i, *page, SNAPSHOT) for i, page in enumerate(pages)]


def land(spark, path, pages):
    spark.createDataFrame(pages, LANDED).write.mode("append").parquet(path)


@pytest.fixture
def places(tmp_path):
    return {name: f"{tmp_path}/{name}" for name in ("landing", "warehouse", "book")}


def load(spark, places, **options):
    return run(spark, places["landing"], places["warehouse"], DAY, DAY, BASE, HOST, **options)


def rows(spark, places, table, *columns):
    df = load_table(spark, places["warehouse"], table).orderBy("seq")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_run(spark, places):
    land(spark, places["landing"], landed())
    other = [(99, "shop", "u?id=9", None, None, "u?id=9", "", "2025-10-02 ~ 2025-10-02")]
    land(spark, places["landing"], other)
    added = load(spark, places, book=places["book"])
    assert added == {
        "shop_metrics": 2,
        "shop_creators": 1,
        "product_metrics": 2,
        "product_dim": 2,
        "product_creators": 2,
        "videos": 3,
        "lives": 2,
    }
    assert rows(spark, places, "shop_metrics", "shop_link", "shop_revenue", "shop_item_sold") == [
        (BASE + "1", "$1", "2"),
        (BASE + "2", "$4", None),
    ]
    assert rows(
        spark, places, "shop_creators", "creator_name", "account_type", "mcn", "debut_time", "followers", "creator_bio"
    ) == [("Bob", "Seller", "Agency", "2024", "1.2k", "N/A")]
    assert rows(
        spark, places, "product_metrics", "product_name", "tiktok_product_link", "rating",
        "number_of_reviews", "product_skus", "product_revenue",
    ) == [("Red hat", "https://t.example/p1", "4.5", "12", "3", "$5"), ("Cup", *["N/A"] * 4, None)]
    # Bobby shares Bob's link; Cid shares Ann's missing one.
    assert rows(spark, places, "product_creators", "creator_name", "tiktok_link", "product_link", "followers") == [
        ("@Bob", "https://www.tiktok.com/@bob", "https://t.example/p1", "1.2k"),
        ("Ann", "N/A", "https://t.example/p1", "N/A"),
    ]
    assert rows(
        spark, places, "videos", "item_title", "type", "creator_name", "creator_link", "link", "views", "ad_roas",
        "advertising_period_days", "publish_date", "video_duration", "revenue", "ads_spending",
    ) == [
        ("T1", "AD", "bob", "https://www.tiktok.com/@bob", "https://www.tiktok.com/@@bob/video/77",
         "1,234", "2.5", "7", "2025-09-30", "00:15", "$7", "N/A"),
        ("T3", "Normal", "ann", "N/A", "N/A", "-", "2.5", "7", "2025-09-30", "00:15", "$9", "N/A"),
        ("T4", "Normal", "zed", "N/A", "N/A", "1,234", "2.5", "7", "2025-09-30", "00:15", "$9", "N/A"),
    ]
    assert rows(
        spark, places, "lives", "creator_name", "creator_link", "link", "revenue", "livestream_time", "duration",
        "views", "avg_unit_price", "avg_online_viewer",
    ) == [
        ("BOB", "https://www.tiktok.com/@bob", "https://www.tiktok.com/@@BOB/live?room_id=5", "$3", "10:00", "1h",
         "9", "$2", "N/A"),
        ("cid", "N/A", "N/A", "$3", "10:00", "1h", "9", "$2", "N/A"),
    ]
    stamped = load_table(spark, places["warehouse"], "videos").where(F.col("created_at").isNull())
    assert stamped.isEmpty()
    for table, sheet in SHEET_NAMES.items():
        sheet_rows = spark.read.parquet(sheet_path(places["book"], sheet)).count()
        assert sheet_rows == load_table(spark, places["warehouse"], table).count()

    # The same day again changes nothing that is stored. Cid comes in: that
    # row was left out for sharing a missing link, and stored missing links do not count.
    before = rows(spark, places, "videos", "*")
    assert load(spark, places) == {**dict.fromkeys(added, 0), "product_creators": 1}
    assert rows(spark, places, "videos", "*") == before
    assert load_table(spark, places["warehouse"], "product_dim").count() == 2

    # A creator that lands late reaches the content stored before it.
    shop = "https://data.example/shop/detail?id=1"
    late = (200, "creator", shop, "Red hat", row("ZED"), "u", creator_page("https://www.tiktok.com/@zed"), SNAPSHOT)
    land(spark, places["landing"], [late])
    assert load(spark, places)["product_creators"] == 1
    links = dict(rows(spark, places, "videos", "item_title", "creator_link"))
    assert links["T4"] == "https://www.tiktok.com/@zed"


def test_counts_of_a_run(spark, places, monkeypatch):
    """Loaded, added and updated rows come from the writes: no table is read to count it."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    def counted(self):
        raise AssertionError("count() in a run")

    land(spark, places["landing"], landed())
    with monkeypatch.context() as m:
        m.setattr(Frame, "count", counted)
        saved = load(spark, places)
    assert {t: (int(s), s.loaded, s.updated) for t, s in saved.items()} == {
        "shop_metrics": (2, 2, 0),
        "shop_creators": (1, 2, 0),
        "product_metrics": (2, 3, 0),
        "product_dim": (2, 2, 0),
        "product_creators": (2, 4, 0),
        "videos": (3, 4, 0),
        "lives": (2, 2, 0),
    }
    shop = "https://data.example/shop/detail?id=1"
    late = (200, "creator", shop, "Red hat", row("ZED"), "u", creator_page("https://www.tiktok.com/@zed"), SNAPSHOT)
    land(spark, places["landing"], [late])
    saved = load(spark, places)
    assert (int(saved["videos"]), saved["videos"].loaded, saved["videos"].updated) == (0, 4, 1)
    assert (int(saved["lives"]), saved["lives"].updated) == (0, 0)
    assert load(spark, places)["videos"].updated == 0


def test_unknown_tiles_reach_table_and_sheet(spark, places):
    pages = landed()
    shop = "https://data.example/shop/detail?id=3"
    odd = tiles(**{"Revenue": "$3", "New_Tile": "a<br>b", "shop": "x"}) + tiles(**{"New_Tile": "last", "": "none"})
    live = ("live", shop, "Red hat", row("L9", "", "$3", clamp=2), "u", live_page("@BOB") + tiles(Odd="1"))
    land(spark, places["landing"], [*pages, (300, "shop", shop, None, None, shop, odd, SNAPSHOT), (301, *live, SNAPSHOT)])
    load(spark, places, book=places["book"])
    stored = rows(spark, places, "shop_metrics", "shop_revenue", "other_metrics")
    assert stored == [("$1", None), ("$4", None), ("$3", {"Shop_New Tile": "last", "Shop_shop": "x"})]
    assert [r[0] for r in rows(spark, places, "lives", "other_metrics")] == [None, None, {"Odd": "1"}]
    sheet = spark.read.parquet(sheet_path(places["book"], "Shop_Metrics"))
    assert sheet.select("shop_new_tile", "shop_shop").where("shop_revenue = '$3'").collect() == [("last", "x")]
    assert sheet.where("shop_new_tile IS NULL").count() == 2
    assert [r[0] for r in spark.read.parquet(sheet_path(places["book"], "Lives")).select("odd").collect()].count("1") == 1


def test_columns_of_labels_keep_apart(spark):
    from snaplake.operators.reshape import label_columns

    df = spark.createDataFrame([({"A b": "1", "a-B": "2", "?": "3", "Taken": "4"},), (None,)], "m map<string,string>")
    columns = label_columns(df, "m", ["taken"])
    assert sorted(columns) == ["a_b", "a_b_2", "metric", "taken_2"]
    assert df.select(*(c.alias(n) for n, c in columns.items())).where("a_b IS NOT NULL").count() == 1


def test_shop_cap(spark, places):
    land(spark, places["landing"], landed())
    added = load(spark, places, max_shops=1)
    assert added["shop_metrics"] == 1
    assert added["product_metrics"] == 1
    assert added["videos"] == 3


def test_shop_cap_counts_shops(spark, places):
    pages = landed()
    again = (900, *pages[0][1:])
    land(spark, places["landing"], [*pages, again])
    assert load(spark, places, max_shops=2)["shop_metrics"] == 2


def test_stored_addresses_are_cleaned(spark, places):
    """Rows stored from elsewhere, under a longer address, count as done."""
    from snaplake.schemas import SCHEMAS, conform
    from snaplake.sources import tables

    stored = spark.createDataFrame(
        [(1, "https://data.example/shop/detail?z=1&id=1", SNAPSHOT), (2, "N/A", SNAPSHOT), (3, "", SNAPSHOT)],
        "seq long, shop_link string, date_filter string",
    )
    tables.append_rows(conform(stored, SCHEMAS["shop_metrics"]), f"{places['warehouse']}/shop_metrics")
    land(spark, places["landing"], landed())
    assert load(spark, places)["shop_metrics"] == 1


def test_sheets_and_catalog_of_a_run(spark, places):
    from snaplake.schemas import SCHEMAS
    from snaplake.sources import tables

    try:
        tables.create_tables(spark, places["warehouse"])
        shops = [p for p in landed() if p[1] == "shop"]
        land(spark, places["landing"], shops)
        load(spark, places, book=places["book"])
        assert spark.table("shop_metrics").count() == 2
        for sheet in SHEET_NAMES.values():
            assert spark.read.parquet(sheet_path(places["book"], sheet)).columns
    finally:
        for table in SCHEMAS:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_no_markup_is_shuffled(spark, places, conf):
    """Below every exchange only short fields are left, and pages are pruned by kind."""
    from snaplake.plans import daily
    from snaplake.sources import tables
    from snaplake.sources.pages import land_pages

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    land_pages(spark.createDataFrame(landed(), LANDED), places["landing"])
    plans = []
    append, upsert = tables.append_rows, tables.upsert_dim

    def spy(rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        append(rows, *rest)

    tables.append_rows = spy
    try:
        load(spark, places)
    finally:
        tables.append_rows = append
    assert daily and upsert
    parsing = [p for p in plans if "html" in p]
    assert len(parsing) == 6
    for text in parsing:
        lines = text.splitlines()
        for n, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                below = next(x for x in lines[n + 1 :] if "Project" in x or "Aggregate" in x or "Scan" in x)
                assert "html" not in below.replace("html_", ""), below
        scans = [x for x in lines if "kind#" in x and "PartitionFilters" in x]
        assert scans and all("date_filter" in x.split("PartitionFilters")[1] for x in scans)
        assert text.count("ArrowEvalPython") <= 2


def test_a_table_that_fails_does_not_keep_others_from_being_loaded(spark, places, monkeypatch):
    """Tables are loaded beside each other; a run that starts again does the rest."""
    from snaplake.plans import records

    def broken(*_):
        raise OSError("gave way")

    land(spark, places["landing"], landed())
    with monkeypatch.context() as patch:
        patch.setattr(records, "shop_creators", broken)
        with pytest.raises(OSError):
            load(spark, places)
    assert len(rows(spark, places, "product_dim", "product_name")) == 2
    saved = load(spark, places)
    assert {t: int(n) for t, n in saved.items() if n} == {"shop_creators": 1, "product_creators": 2, "videos": 3, "lives": 2}
