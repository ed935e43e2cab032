"""Resume joins, page numbers, cursors, lookups, caps."""

import random

from pyspark.sql import functions as F

from snaplake.operators.enrich import children_of, enrich_creator_links, lookup_first, top_shops
from snaplake.operators.hierarchy import explode_children, flatten_levels
from snaplake.operators.resume import key_union, number_pages, past_cursor, resume_anti, resume_pages


def test_resume_anti_keeps_duplicates_and_meets_missing_keys(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "seq long, k string")
    stored = spark.createDataFrame([("a",), ("a",)], "k string")
    kept = resume_anti(new, stored, "k")
    assert kept.columns == ["seq", "k"]
    assert sorted(r["seq"] for r in kept.collect()) == [2, 3, 4]
    stored = spark.createDataFrame([("N/A",)], "k string")
    assert sorted(r["seq"] for r in resume_anti(new, stored, ["k"]).collect()) == [1, 2, 3]


def test_missing_number_keys_meet(spark):
    new = spark.createDataFrame([(1, None), (2, 5)], "seq long, k long")
    stored = spark.createDataFrame([(None,), (7,)], "k long")
    assert [r["seq"] for r in resume_anti(new, stored, "k").collect()] == [2]
    dim = spark.createDataFrame([(1, None, "x")], "seq long, k long, v string")
    found = {r["seq"]: r["v"] for r in lookup_first(new, dim, ["k"], "v", "seq").collect()}
    assert found == {1: "x", 2: "N/A"}


def test_key_case_matters(spark):
    new = spark.createDataFrame([("Bob",), ("bob",)], "k string")
    stored = spark.createDataFrame([("bob",)], "k string")
    assert [r["k"] for r in resume_anti(new, stored, "k").collect()] == ["Bob"]


def test_key_union(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    assert sorted(map(tuple, key_union(a, b, ["k", "v"]).collect())) == [("N/A", 2), ("x", 1)]


def test_page_numbers_across_slices(spark):
    rng = random.Random(5)
    rows = [(i * 3, "hot" if rng.random() < 0.5 else f"p{rng.randrange(5)}") for i in range(700)]
    want, seen = {}, {}
    for seq, parent in rows:
        seen[parent] = seen.get(parent, 0) + 1
        want[seq] = (seen[parent] - 1) // 10 + 1
    df = spark.createDataFrame(rows, "seq long, p string").repartition(5)
    for parts in (1, 4, 90):
        got = number_pages(df, ["p"], "seq", 10, parts=parts)
        assert {r["seq"]: r["page"] for r in got.collect()} == want
    nobody = spark.createDataFrame([(2**60 + 1, None), (2**60 + 3, None), (2, None)], "seq long, p string")
    got = number_pages(nobody, ["p"], "seq", 2)
    assert sorted((r["seq"], r["page"]) for r in got.collect()) == [(2, 1), (2**60 + 1, 1), (2**60 + 3, 2)]
    numbered = number_pages(df, ["p"], "seq", 10, parts=8)
    done = numbered.where("page <= 2").select("p", "page")
    left = {r["seq"] for r in resume_pages(numbered, done, ["p"]).collect()}
    assert left == {s for s, page in want.items() if page > 2}


def test_sparse_ids_of_a_hot_parent_stay_in_few_parts(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr(
        "id * 1000000000 AS seq", "if(id % 2 = 0, 'hot', concat('p', id % 50)) AS p"
    )
    got = number_pages(df, ["p"], "seq", 10, parts=10)
    text = got._jdf.queryExecution().analyzed().toString()
    assert "_slice" in text
    pages = {r["page"]: r["n"] for r in got.where("p = 'hot'").groupBy("page").count().toDF("page", "n").collect()}
    assert pages == {n + 1: 10 for n in range(1000)}
    # A part holds a bounded share, so the window over parents sees a row per part.
    staged = df.repartitionByRange(10, "p", "seq").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in staged.collect()) < 4_000


def test_past_cursor(spark):
    assert past_cursor(spark.range(5).toDF("seq"), "seq", 2).count() == 2


CREATORS = "seq long, shop_link string, product_name string, creator_name string, tiktok_link string"
VIDEOS = "shop_link string, product_name string, creator_name string, creator_link string"


def test_creator_links(spark):
    creators = spark.createDataFrame(
        [
            (2, "S", "P", "@Bob", "late"),
            (1, "s ", "p", "bob", "first"),
            (3, "s", "p", "ann", "N/A"),
            (4, "s", "p", "ann", "real"),
        ],
        CREATORS,
    )
    videos = spark.createDataFrame(
        [("s", "P", " @@BOB", "N/A"), ("s", "p", "ann", "kept"), ("s", "q", "bob", None)], VIDEOS
    )
    got = enrich_creator_links(videos, creators)
    assert got.columns == videos.columns
    assert sorted(r["creator_link"] for r in got.collect()) == ["N/A", "first", "kept"]


def test_lookup_defaults(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, None, "none"), (3, "n", "N/A"), (4, "n", "r")],
                                "seq long, k string, v string")
    facts = spark.createDataFrame([("a",), (None,), ("z",), ("A",), ("n",)], "k string")
    got = lookup_first(facts, dim, ["k"], "v", "seq").collect()
    assert {r["k"]: r["v"] for r in got} == {"a": "x", None: "none", "z": "N/A", "A": "N/A", "n": "N/A"}
    real = lookup_first(facts, dim, ["k"], "v", "seq", prefer_real=True).collect()
    assert {r["k"]: r["v"] for r in real}["n"] == "r"
    own = lookup_first(facts, dim, ["k"], "v", "seq", default="?").collect()
    assert {r["k"]: r["v"] for r in own}["z"] == "?"


def test_shop_cap(spark):
    shops = spark.createDataFrame([("c", 1), ("a", 2), ("b", 3)], "shop string, rank int")
    children = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "shop string, v int")
    top = top_shops(shops, [F.asc("rank")], 2)
    assert sorted(r["v"] for r in children_of(children, top, ["shop"]).collect()) == [1, 2, 4]


def test_hierarchy(spark):
    shops = spark.createDataFrame([("s1",), ("s2",)], "shop string")
    products = spark.createDataFrame([("s1", "p1"), ("s1", "p2"), ("s9", "p9")], "of string, product string")
    videos = spark.createDataFrame([("p1", "v1"), ("p1", "v2")], "vp string, video string")
    flat = flatten_levels(shops, [(products, "shop", "of"), (videos, "product", "vp")])
    assert sorted((r["shop"], r["product"], r["video"]) for r in flat.collect()) == [
        ("s1", "p1", "v1"),
        ("s1", "p1", "v2"),
    ]
    nested = spark.createDataFrame([("s1", ["a", "b"])], "shop string, names array<string>")
    rows = explode_children(nested, "names", "name").collect()
    assert [tuple(r) for r in rows] == [("s1", 0, "a"), ("s1", 1, "b")]
