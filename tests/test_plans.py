"""Physical plans: what the engine must do at scale, seen in small."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as contract
from snaplake import catalog
from snaplake.operators.dedup import dedup_dual_key, dedup_first
from snaplake.operators.enrich import lookup_first
from snaplake.operators.filters import snapshot_rows
from snaplake.operators.resume import number_pages, resume_anti

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    rows = df.collect()
    text = plan(df)
    return rows, text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def small_is_skewed(conf, no_broadcast):
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")


@pytest.fixture
def hot(spark):
    """Half the rows under one key, in eight input splits."""
    return spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") % 50).cast("string").alias("n"),
        (F.col("id") % 90).cast("string").alias("l"),
    )


def test_hot_key_of_a_lookup_is_split(spark, hot, small_is_skewed):
    dim = spark.range(400).selectExpr("id AS seq", "id AS k", "concat('v', id) AS v")
    rows, text = final_plan(lookup_first(hot, dim, ["k"], "v", "seq"))
    assert "SortMergeJoin(skew=true)" in text
    assert len(rows) == 20_000
    assert all(r["v"] == (f"v{r['k']}" if r["k"] < 400 else "N/A") for r in rows)


def test_hot_text_key_is_split(spark, hot, small_is_skewed):
    rows = hot.withColumn("k", F.concat(F.lit("https://h.example/?id="), "k"))
    dim = rows.where("seq < 900").withColumn("v", F.col("n"))
    found, text = final_plan(lookup_first(rows, dim, ["k"], "v", "seq", normalise=True))
    assert "SortMergeJoin(skew=true)" in text
    assert len(found) == 20_000
    known = rows.where("seq < 900 AND seq % 2 = 1")
    left, text = final_plan(resume_anti(rows, known, "k"))
    assert "SortMergeJoin(skew=true)" in text
    assert sum(r["k"].endswith("=7") for r in left) == 0


def test_hot_key_of_a_resume_is_split(spark, hot, small_is_skewed):
    stored = spark.range(100, 300).selectExpr("id AS k").union(spark.range(9).selectExpr("100L AS k"))
    rows, text = final_plan(resume_anti(hot, stored, "k"))
    assert "SortMergeJoin(skew=true)" in text
    assert sum(r["k"] == 7 for r in rows) >= 10_000


def test_dedup_combines_before_the_shuffle(hot):
    text = plan(dedup_first(hot, "k", "seq"))
    assert "partial_min_by" in text
    assert text.count("Exchange ") == 1


def test_dual_key_shuffles_rows_twice(hot, no_broadcast):
    new, stored = hot.where("seq >= 5000"), hot.where("seq < 5000")
    text = plan(dedup_dual_key(new, stored, ["k"], "n", "l", "seq", True))
    # Once per key for the rows, once per key for the stored keys.
    assert text.count("Exchange hashpartitioning") == 4
    assert text.count("partial_min_by") == 2
    assert "Window" not in text


def test_page_numbers_never_gather_a_parent(hot):
    text = plan(number_pages(hot, ["k"], "seq", 10, parts=6))
    windows = re.findall(r"Window \[row_number\(\).*?\], \[(.*?)\]", text)
    assert windows and all("_slice" in w for w in windows)


def test_snapshot_bounds_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(snapshot_rows(orders, "o_orderdate", "1997-05-01", "1997-05-31").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


@pytest.fixture
def written(monkeypatch):
    """The plans of all that is written during a test."""
    plans = []
    for name in ("save", "parquet"):

        def spy(self, *args, write=getattr(DataFrameWriter, name), **options):
            plans.append(plan(self._df))
            return write(self, *args, **options)

        monkeypatch.setattr(DataFrameWriter, name, spy)
    return plans


WRITERS = {
    "incremental_append", "late_dim_backfill", "sheet_overwrite", "snapshot_rerun", "product_dim_upsert",
    "table_routing", "dual_sink", "sheet_scan", "empty_sink", "daily_run",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_joins_or_python_rows(spark, name, written):
    last = plan(contract.queries()[name](spark, SF))
    assert written or name not in WRITERS
    for text in [*written, last]:
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
        assert "BatchEvalPython" not in text
