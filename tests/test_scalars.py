"""Column functions against hand-made cases and against plain Python."""

from datetime import date, datetime
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from snaplake import fixed
from snaplake.functions import dates, text, urls, values

BASE = "https://base.example/shop/detail?id="


def apply(spark, inputs, function, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    rows = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_canonical_url(spark):
    urls_in = [
        "https://h/shop/detail?id=12&x=1",
        "https://h/d?x=1&id=9&id=10",
        "https://h/d?id=&id=7",
        "https://h/d?sid=5",
        "",
        None,
        "https://[h/d?id=3",
    ]
    got = apply(spark, urls_in, lambda c: urls.canonical_url(c, BASE))
    assert got == [BASE + "12", BASE + "9", BASE + "7", *urls_in[3:]]


def python_param(url, name="id"):
    try:
        return parse_qs(urlparse(url).query)[name][0]
    except (KeyError, ValueError):
        return None


def test_query_param_equals_python(spark):
    cases = [
        "https://h/p?id=a%20b+c",
        "https://h/p?id=3#frag",
        "https://h/p#x?id=3",
        "https://h/p?id=%zz",
        "https://h/p?id=%zz+a%41",
        "https://h/p?id=100%",
        "https://h/p?%69d=5",
        "https://h/p?id",
        "https://h/p?id=&id=8",
        "https://h/p?id==1",
        "https://h/p?a=1;id=2",
        "https://h/p?x?id=4&id=5",
        "?id=6",
        "id=7",
        "https://h/p?ID=1",
        "https://h/p?id=caf%C3%A9",
        "https://h /p q?id=1 2",
        "https://h/p?&&id=9&",
        "https://h/p?id=a\n&x=b",
        "https://u:p@h:80/p?id=1/2?3",
        "https://[h/p?id=1",
        "https://h]/p?id=1",
        "https://h]",
        "https://[::1]/p?id=1",
        "https://h/[p?id=1",
        "https://h/p?id=[1",
        "",
    ]
    got = apply(spark, cases, lambda c: urls.query_param(c, "id"))
    assert got == [python_param(c) for c in cases]


def test_url_parts_equal_python(spark):
    cases = ["https://www.h.example/a/livestream/detail?id=1", "http://u@h:8/p#f", "//h/x", "/p?q", "x"]
    assert apply(spark, cases, urls.url_host) == [urlparse(c).netloc for c in cases]
    assert apply(spark, cases, urls.url_path) == [urlparse(c).path for c in cases]


def test_links(spark):
    df = spark.createDataFrame(
        [("@a", "5", "https://l.example/livestream/detail?id=5"),
         ("a", None, "https://l.example/livestream/detail"),
         ("N/A", "5", "https://l.example/livestream/detail?id=5"),
         ("a", "5", "https://l.example.evil/livestream/detail?id=5"),
         ("a", "5", "https://l.example/live?id=5")],
        "c string, id string, u string",
    )
    on_page = urls.is_live_page(F.col("u"), "l.example")
    rows = df.select(
        urls.video_link(F.col("c"), F.col("id")).alias("v"),
        urls.live_link(F.col("c"), F.col("id"), on_page).alias("l"),
    ).collect()
    assert [r["v"] for r in rows[:2]] == ["https://www.tiktok.com/@@a/video/5", "N/A"]
    assert [r["l"] for r in rows] == ["https://www.tiktok.com/@@a/live?room_id=5", *["N/A"] * 4]


def test_strip_equals_python(spark):
    cases = [f"{c}a{c} b{c}{c}" for c in fixed.WHITESPACE] + ["", "  ", "​a", None]
    want = [None if c is None else c.strip() for c in cases]
    assert apply(spark, cases, text.strip) == want


@pytest.mark.parametrize("raw", [" @Bob ", "@@BOB", "bob", "　@bOb\n"])
def test_handle(spark, raw):
    assert apply(spark, [raw], text.normalise_handle) == ["bob"]


def test_handle_order_of_steps(spark):
    # Signs go after the space: what is behind the sign stays.
    assert apply(spark, ["@ bob"], text.normalise_handle) == [" bob"]
    assert apply(spark, ["@A@"], text.strip_at) == ["A@"]


@pytest.mark.parametrize(
    ("function", "raw", "want"),
    [
        (text.before_slash, "4.5 /5", "4.5"),
        (text.before_slash, "4.5", "4.5"),
        (text.review_count, "Reviews: 12", "12"),
        (text.review_count, "reviews: 12", "N/A"),
        (text.sku_count, "SKUs (34)", "34"),
        (text.ad_days, "7 days", "7"),
        (text.ad_days, "no digits", "N/A"),
        (text.followers, "Followers 1.2k", "1.2k"),
        (text.followers, "500 Followers", "500"),
        (text.followers, "followers:3", "3"),
        (text.followers, "Followers\n7M", "7M"),
        (text.followers, "none", "N/A"),
        (text.followers, None, "N/A"),
        (text.followers_with_suffix, "1.2k", "1.2k"),
        (text.followers_with_suffix, "3m", "3m"),
        (text.followers_with_suffix, "4K", "N/A"),
        (text.followers_with_suffix, "500", "N/A"),
        (text.compact_number, "1,234 views", "1,234"),
        (text.compact_number, "5.6M", "5.6M"),
        (text.compact_number, "-", "-"),
        (text.after_marker, "Debut Time : 2024: a", "2024: a"),
        (text.after_marker, "x", "x"),
        (text.after_marker, " x ", " x "),
        (text.join_lines, "1\n.2k ", "1.2k"),
        (text.flatten_lines, "a\nb\n", "a b "),
        (text.clean_name, "\na\nb ", "a b"),
        (values.na_default, None, "N/A"),
        (values.na_default, "", ""),
    ],
)
def test_text(spark, function, raw, want):
    assert apply(spark, [raw], function) == [want]


def test_first_nonempty(spark):
    df = spark.createDataFrame([("1\n.2k", "h"), (" \n", " hid\nden "), (None, "h"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(text.first_nonempty(F.col("a"), F.col("b"))).collect()]
    assert got == ["1.2k", "hidden", "h", ""]


def test_predicates(spark):
    cases = [None, "", "N/A", "nan", "-", "x"]
    assert apply(spark, cases, values.is_valid) == [False] * 4 + [True, True]
    assert apply(spark, cases, values.is_ready) == [False, False, False, True, False, True]
    arrays = [["-", "N/A", ""], ["-", "3"], [], None, [None, "-"]]
    got = apply(spark, arrays, values.any_ready, "x array<string>")
    assert got == [False, True, False, False, False]
    audience = ["Female Majority", "Gender Balance", "other"]
    assert apply(spark, audience, values.contains_any) == [True, True, False]


def test_update_rule(spark):
    df = spark.createDataFrame(
        [("f", "e"), ("N/A", "e"), (None, "e"), ("N/A", None), (None, "N/A")], "f string, e string"
    )
    got = [r[0] for r in df.select(values.known_or_existing(F.col("f"), F.col("e"))).collect()]
    assert got == ["f", "e", "e", "N/A", "N/A"]


def test_snapshot_label(spark):
    assert dates.label("2025-10-01", date(2025, 10, 2)) == "2025-10-01 ~ 2025-10-02"
    df = spark.createDataFrame([(date(2024, 2, 10),)], "d date")
    row = df.select(
        dates.day_snapshot(F.col("d")).alias("day"),
        dates.month_snapshot(F.col("d")).alias("month"),
        dates.snapshot_start(dates.month_snapshot(F.col("d"))).alias("s"),
        dates.snapshot_end(dates.month_snapshot(F.col("d"))).alias("e"),
    ).first()
    assert tuple(row) == (
        "2024-02-10 ~ 2024-02-10",
        "2024-02-01 ~ 2024-02-29",
        date(2024, 2, 1),
        date(2024, 2, 29),
    )


def test_parse_day(spark):
    cases = ["2025-10-05", "2025-1-5", "2025-13-01", "x", None, "2025-10-05 1"]
    default = date(2025, 10, 1)
    got = apply(spark, cases, lambda c: dates.parse_day(c, "2025-10-01"))
    assert got == [date(2025, 10, 5), date(2025, 1, 5), default, default, default, default]
    assert apply(spark, ["x"], dates.parse_day) == [None]


def test_one_bad_day_resets_both(spark):
    df = spark.createDataFrame([("2025-01-02", "2025-01-03"), ("2025-01-02", "x"), (None, "2025-01-03")], "a string, b string")
    first, last = dates.parse_span(F.col("a"), F.col("b"), ("2025-10-01", "2025-11-30"))
    rows = [tuple(r) for r in df.select(first.alias("first"), last.alias("last")).collect()]
    default = (date(2025, 10, 1), date(2025, 11, 30))
    assert rows == [(date(2025, 1, 2), date(2025, 1, 3)), default, default]


def test_zone_does_not_depend_on_the_session(spark, conf):
    conf("spark.sql.session.timeZone", "America/New_York")
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-10-01 20:00:00' AS t")
    assert df.select(dates.to_zone(F.col("t"))).first()[0] == datetime(2025, 10, 2, 3)
