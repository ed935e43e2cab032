"""Filters of seen keys: the rows of a plain resume, whatever the filter lets through."""

import random

import pytest
from pyspark.sql import functions as F

from snaplake.operators.resume import resume_anti
from snaplake.sources.seen import SeenKeys

KEYS = ["shop", "page"]
ROWS = "shop string, page long, n long"


def made(spark, path, **options):
    return SeenKeys(spark, str(path / "seen"), spark.createDataFrame([], ROWS).select(*KEYS).schema, **options)


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize(
    "options",
    [
        {"blocks": 8},
        {"blocks": 1, "probes": 1},
        {"blocks": 8, "broadcast_bytes": 0},
        {"blocks": 3, "probes": 12},
    ],
)
def test_same_rows_with_and_without(spark, tmp_path, options):
    draw = random.Random(3)

    def some(count):
        found = [(draw.choice(["a", "b", None, "N/A", ""]), draw.choice([*range(9), None, -1, 2**63 - 1]), i) for i in range(count)]
        return spark.createDataFrame([*found, *found[:3]], ROWS)

    seen = made(spark, tmp_path, **options)
    stored = spark.createDataFrame([], ROWS)
    for batch in range(3):
        new = some(25)
        plain = resume_anti(new, stored, KEYS)
        assert sort(seen.unseen(new, lambda r, s=stored: resume_anti(r, s, KEYS)).collect()) == sort(plain.collect())
        seen.add(new, f"day {batch}")
        stored = stored.union(new)
    assert seen.mark(stored, "seen").where(~F.col("seen")).count() == 0  # of a key that was added all bits are set


def test_few_new_rows_are_asked_for(spark, tmp_path):
    seen = made(spark, tmp_path, blocks=4)
    keys = spark.range(24_000).select(F.lit("s").alias("shop"), F.col("id").alias("page"))
    seen.add(keys.where("page < 12000"), "d")
    asked = seen.mark(keys, "seen").where(F.col("seen")).agg(F.sum((F.col("page") < 12000).cast("int")), F.count("*"))
    old, all_ = asked.first()
    assert old == 12_000 and all_ - old < 240  # 2 % of the new ones; about 1 % is expected


def test_a_filter_too_full_loses_nothing(spark, tmp_path):
    seen = made(spark, tmp_path, blocks=1)
    keys = spark.range(40_000).select(F.lit("s").alias("shop"), F.col("id").alias("page"))
    stored = keys.where("page < 30000")
    seen.add(stored, "d")
    assert seen.unseen(keys, lambda r: resume_anti(r, stored, KEYS)).count() == 10_000


def test_filters_by_snapshot(spark, tmp_path):
    seen = made(spark, tmp_path)
    a, b = (spark.createDataFrame([(k, 1, 1)], ROWS) for k in "ab")
    seen.add(a, "2025-10-01 ~ 2025-10-01")
    seen.add(b, "2025-10-02 ~ 2025-10-02")
    seen.add(a, "2025-10-02 ~ 2025-10-02")  # another addition to a day
    both = a.union(b)

    def marks(*days):
        return sorted(tuple(r) for r in seen.mark(both, "seen", days).select("shop", "seen").collect())

    assert marks("2025-10-01 ~ 2025-10-01") == [("a", True), ("b", False)]
    assert marks("2025-10-02 ~ 2025-10-02") == [("a", True), ("b", True)]
    assert marks("2025-10-01 ~ 2025-10-01", "2025-10-03 ~ 2025-10-03") == [("a", True), ("b", True)]  # a day without filter
    assert made(spark, tmp_path / "none").mark(both, "seen").where("seen").count() == 2


def test_clashing_names_and_types(spark, tmp_path):
    seen = made(spark, tmp_path)
    rows = spark.createDataFrame([("a", 1, 1, 2)], "shop string, page int, block long, bits long")
    seen.add(rows, "d")
    assert seen.mark(rows, "seen").collect() == [("a", 1, 1, 2, True)]  # whole numbers of any width are one type
    with pytest.raises(TypeError):
        seen.mark(rows.withColumn("page", F.col("page").cast("string")), "seen")
    with pytest.raises(TypeError):
        made_of = rows.select(F.col("page").cast("double")).schema
        SeenKeys(spark, str(tmp_path / "x"), made_of)
    assert seen.unseen(rows.limit(0), lambda r: r).collect() == []


def test_surely_new_rows_are_not_shuffled(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    seen = made(spark, tmp_path)
    rows = spark.range(100).select(F.lit("s").alias("shop"), F.col("id").alias("page"))
    seen.add(rows.where("page < 50"), "d")
    plan = seen.mark(rows, "seen")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the blocks of the filter, not the rows
