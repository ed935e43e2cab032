"""Stored keys in sorted buckets: same rows as a plain resume, stored side left where it lies."""

import random

import pytest

from snaplake.operators.resume import resume_anti
from snaplake.sources.key_index import KeyIndex

KEYS = ["shop", "page"]
ROWS = "shop string, page long, n long"


@pytest.fixture
def index(spark, tmp_path):
    made = KeyIndex(spark, str(tmp_path / "keys"), KEYS, buckets=3)
    yield made
    for _, folder in made.runs():
        spark.sql(f"DROP TABLE IF EXISTS key_{folder.replace('-', '_')}")


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


def test_same_rows_as_a_plain_resume(spark, index):
    draw = random.Random(2)

    def some(count):
        found = [(draw.choice(["a", "b", None, "N/A", ""]), draw.choice([1, 2, 3, 4, None]), i) for i in range(count)]
        return spark.createDataFrame([*found, *found[:2]], ROWS)

    stored = spark.createDataFrame([], ROWS)
    assert sort(index.unseen(some(9)).collect()) and index.runs() == []
    for _ in range(5):
        new = some(6)
        assert sort(index.unseen(new).collect()) == sort(resume_anti(new, stored, ["shop", "page"]).collect())
        index.add(new)
        stored = stored.union(new)
    assert [level for level, _ in index.runs()] == [2, 0]  # five additions
    assert index.unseen(stored).count() == 0
    again = KeyIndex(spark, index.root, KEYS, buckets=3)  # found again by another session
    assert again.unseen(stored).count() == 0
    held = sum(index.run(folder).count() for _, folder in index.runs())
    assert held == stored.fillna("N/A", ["shop"]).select(*KEYS).distinct().count()


def test_stored_side_is_neither_shuffled_nor_sorted(spark, index, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    for n in range(3):
        index.add(spark.createDataFrame([(f"s{i}", i, n) for i in range(50 * n, 50 * n + 60)], ROWS))
    assert len(index.runs()) == 2
    new = spark.createDataFrame([(f"s{i}", i, 0) for i in range(100, 300)], ROWS)
    keys = index._unseen_keys(new)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    # One exchange to combine the new keys and one to deal them out; one sort, of these.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 1
    assert keys.count() == 300 - 160


def test_a_run_that_is_not_whole_does_not_count(spark, index):
    import os

    index.add(spark.createDataFrame([("a", 1, 1)], ROWS))
    ((_, folder),) = index.runs()
    os.makedirs(f"{index.root}/run-000-half")
    assert index.runs() == [(0, folder)]
    assert index.unseen(spark.createDataFrame([("a", 1, 2), ("b", 1, 3)], ROWS)).collect() == [("b", 1, 3)]
