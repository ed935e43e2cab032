"""Order-dependent dedup against a sequential loop, whatever the layout."""

import random

import pytest

from snaplake.operators.dedup import dedup_dual_key, dedup_first, first_value
from snaplake.operators.reshape import last_values, pivot_metrics, product_dim
from snaplake.operators.resume import resume_anti

ROWS = "seq long, p string, n string, l string"


def greedy(rows, stored, exempt_na):
    """The rule as a loop over rows in order."""
    used_names = {(p, n) for _, p, n, _ in stored}
    used_links = {(p, link) for _, p, _, link in stored if link != "N/A"}
    kept = []
    for seq, p, n, link in sorted(rows):
        if (p, n) in used_names:
            continue
        used_names.add((p, n))
        if (p, link) in used_links and not (exempt_na and link == "N/A"):
            continue
        used_links.add((p, link))
        kept.append(seq)
    return kept


def dual(spark, rows, stored, exempt_na, partitions=4):
    new = spark.createDataFrame(rows, ROWS).repartition(partitions)
    seen = spark.createDataFrame(stored, ROWS) if stored is not None else None
    kept = dedup_dual_key(new, seen, ["p"], "n", "l", "seq", exempt_na)
    assert kept.columns == new.columns
    return sorted(r["seq"] for r in kept.collect())


@pytest.mark.parametrize(
    ("rows", "stored", "exempt_na", "want"),
    [
        ([(1, "p", "a", "x"), (2, "p", "a", "y"), (3, "p", "b", "y")], [], False, [1, 3]),
        ([(1, "p", "a", "x"), (2, "p", "b", "x"), (3, "p", "b", "z")], [], False, [1]),
        ([(1, "p", "a", "N/A"), (2, "p", "b", "N/A")], [], False, [1]),
        ([(1, "p", "a", "N/A"), (2, "p", "b", "N/A")], [], True, [1, 2]),
        ([(1, "p", "a", "q"), (2, "p", "c", "x"), (3, "p", "d", "r")], [(0, "p", "a", "x")], False, [3]),
        ([(1, "p", "a", "N/A")], [(0, "p", "z", "N/A")], False, [1]),
        ([(1, "p", "a", "x"), (2, "q", "a", "x")], [], False, [1, 2]),
        ([(1, "p", "a", "b"), (2, "p", "b", "N/A"), (3, "p", "c", "a")], [], True, [1, 2, 3]),
    ],
)
def test_dual_key_cases(spark, rows, stored, exempt_na, want):
    assert dual(spark, rows, stored, exempt_na) == want


@pytest.mark.parametrize("exempt_na", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_dual_key_equals_loop(spark, exempt_na, seed):
    rng = random.Random(seed)

    def row(seq):
        # One parent, one name and one link hold about a third of the rows.
        return (
            seq,
            rng.choice(["hot", "hot", "p1", "p2", "p3", "p4"]),
            rng.choice(["hot", *[f"n{i}" for i in range(60)]]) if rng.random() < 0.7 else "hot",
            rng.choice(["N/A", *[f"l{i}" for i in range(40)]]) if rng.random() < 0.7 else "N/A",
        )

    stored = [row(i) for i in range(40)]
    rows = [row(i) for i in range(40, 900)]
    want = greedy(rows, stored, exempt_na)
    for partitions in (1, 8):
        assert dual(spark, rows, stored, exempt_na, partitions) == want


@pytest.mark.parametrize("exempt_na", [True, False])
def test_dual_key_in_two_batches(spark, exempt_na):
    """Only kept rows are stored, so the second batch starts from their keys."""
    rng = random.Random(3)
    rows = [
        (i, "p", f"n{rng.randrange(200)}", rng.choice(["N/A", f"l{rng.randrange(100)}"]))
        for i in range(300)
    ]
    first = [r for r in rows if r[0] < 150]
    kept = set(dual(spark, first, None, exempt_na))
    stored = [r for r in first if r[0] in kept]
    rest = dual(spark, [r for r in rows if r[0] >= 150], stored, exempt_na)
    assert rest == greedy([r for r in rows if r[0] >= 150], stored, exempt_na)


@pytest.mark.parametrize("cut", [0, 1, 77, 299])
def test_one_key_in_two_batches(spark, cut):
    """With one key, resuming after any cut keeps what one batch keeps."""
    rng = random.Random(cut)
    rows = [(i, f"k{rng.randrange(120)}") for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k string")
    whole = {r["seq"] for r in dedup_first(df, "k", "seq").collect()}
    first = dedup_first(df.where(df.seq < cut), "k", "seq")
    rest = dedup_first(resume_anti(df.where(df.seq >= cut), first, "k"), "k", "seq")
    assert {r["seq"] for r in first.union(rest).collect()} == whole


def test_dual_key_missing_values(spark):
    rows = [(1, None, None, None), (2, None, None, "x"), (3, "N/A", "a", None)]
    kept = dedup_dual_key(
        spark.createDataFrame(rows, ROWS), None, ["p"], "n", "l", "seq", exempt_na=False
    )
    assert [tuple(r) for r in kept.collect()] == [(1, "N/A", "N/A", "N/A")]


def test_dedup_first(spark):
    rows = [(3, "a", "z"), (1, "a", "x"), (2, "b", None), (4, None, "n"), (5, None, "m")]
    df = spark.createDataFrame(rows, "seq long, k string, v string")
    for partitions in (1, 8):
        got = dedup_first(df.repartition(partitions), "k", "seq")
        assert got.columns == df.columns
        assert sorted(tuple(r) for r in got.collect() if r[1]) == [(1, "a", "x"), (2, "b", None)]
        assert [tuple(r) for r in got.where("k IS NULL").collect()] == [(4, None, "n")]
        again = dedup_first(got, ["k"], "seq")
        assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_dedup_first_of_keys_alone(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted(r["k"] for r in dedup_first(df, "k", "k").collect()) == ["a", "b"]


def test_first_value_keeps_na_unless_told(spark):
    rows = [(1, "a", "N/A"), (2, "a", "x"), (3, "a", "y"), (4, "b", "N/A")]
    df = spark.createDataFrame(rows, "seq long, k string, v string")
    assert dict(map(tuple, first_value(df, ["k"], "v", "seq").collect())) == {"a": "N/A", "b": "N/A"}
    real = first_value(df, ["k"], "v", "seq", prefer_real=True)
    assert dict(map(tuple, real.collect())) == {"a": "x", "b": "N/A"}


def test_metrics_last_wins(spark):
    rows = [(1, "Views", "1", 0), (1, "Views", "2", 1), (1, "", "9", 2), (2, "Item Sold", "3", 0)]
    df = spark.createDataFrame(rows, "page long, label string, value string, pos int")
    long = last_values(df, "page", "label", "value", "pos")
    assert sorted(map(tuple, long.collect())) == [(1, "Views", "2"), (2, "Item Sold", "3")]
    wide = pivot_metrics(df, "page", "label", "value", "pos", ["Views", "Item Sold"], "Shop_")
    assert wide.columns == ["page", "shop_views", "shop_item_sold"]
    assert sorted(map(tuple, wide.collect())) == [(1, "2", None), (2, None, "3")]


def test_product_dim(spark):
    rows = [(2, "s", "p", "late"), (1, "s", "p", None), (3, "s", None, "x")]
    df = spark.createDataFrame(rows, "seq long, shop_link string, product_name string, tiktok_product_link string")
    got = product_dim(df, "seq")
    assert got.columns == ["shop_link", "product_name", "product_link"]
    assert sorted(map(tuple, got.collect())) == [("s", "N/A", "x"), ("s", "p", "N/A")]
