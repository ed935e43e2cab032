"""Tables, sheets, routing, cursors, streams and backfill, on small data."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.operators import reshape
from snaplake.operators.enrich import lookup_first
from snaplake.schemas import SCHEMAS, conform, headers
from snaplake.session import shared_dir
from snaplake.sources import jdbc, sheets, tables
from snaplake.streaming import backfill, ingest

ROWS = "k long, v string, date_filter string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROWS)


def read(spark, path):
    return sorted(map(tuple, spark.read.schema(ROWS).parquet(path).collect()))


def test_shared_folder_follows_the_session(spark):
    parent = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{parent}/snaplake/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_schemas_match_headers():
    assert [f.name for f in SCHEMAS["videos"].fields][:3] == ["seq", "shop_link", "product_name"]
    assert SCHEMAS["videos"].fieldNames()[-2:] == ["created_at", "date_filter"]
    assert "product_concentration_rate_l30d" in SCHEMAS["product_metrics"].fieldNames()
    assert "shop_self_operated_account_revenue" in headers("shop_metrics")
    assert "date_filter" not in SCHEMAS["product_dim"].fieldNames()


def test_conform(spark):
    df = spark.createDataFrame([("x", "1", "?")], "extra string, b string, c string")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.IntegerType()),
                           T.StructField("b", T.LongType())])
    got = conform(df, schema)
    assert got.schema == schema
    assert tuple(got.first()) == (None, None, 1)


def test_load_first_only_skips_absence(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType())])
    good = f"{tmp_path}/good"
    spark.range(3).toDF("k").write.parquet(good)
    assert tables.load_first(spark, [f"{tmp_path}/no", good], schema).count() == 3
    assert tables.load_first(spark, [f"{tmp_path}/no"], schema).schema == schema
    with pytest.raises(Exception, match="no.such.format"):
        tables.load_first(spark, [(good, "no.such.format")], schema)
    spark.range(2).toDF("k").write.csv(f"{tmp_path}/sheet")
    sources = [f"{tmp_path}/no", (f"{tmp_path}/sheet", "csv"), good]
    assert tables.load_first(spark, sources, schema).count() == 2


def test_snapshot_overwrite_scan_and_rerun(spark, tmp_path):
    path = f"{tmp_path}/t"
    a, b = "2025-10-01 ~ 2025-10-01", "2025-10-02 ~ 2025-10-02"
    tables.overwrite_snapshot(rows(spark, (1, "x", a), (2, "y", b)), path)
    tables.overwrite_snapshot(rows(spark, (3, "z", b)), path)
    tables.overwrite_snapshot(rows(spark, (3, "z", b)), path)
    assert read(spark, path) == [(1, "x", a), (3, "z", b)]
    scan = tables.snapshot_scan(spark, path, "2025-10-02", "2025-10-02", ["k"])
    assert [tuple(r) for r in scan.collect()] == [(3,)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_filter" in plan
    assert "ReadSchema: struct<k:bigint>" in plan


def test_append_new_twice(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_new(rows(spark, (1, "x", "a"), (2, "y", "b")), path, ["k"], "v")
    tables.append_new(rows(spark, (1, "x", "a"), (3, "z", "b")), path, ["k"], "v")
    tables.append_new(rows(spark, (1, "x", "b")), path, ["k"], "v")
    tables.append_new(rows(spark), path, ["k"], "v")
    tables.append_new(rows(spark, (9, "second", "c"), (9, "first", "c")), path, ["k"], "v")
    assert read(spark, path)[-1] == (9, "first", "c")
    assert read(spark, path)[:-1] == [(1, "x", "a"), (1, "x", "b"), (2, "y", "b"), (3, "z", "b")]
    assert tables.saved_cursor(spark.read.parquet(path), "k") == 9
    assert tables.saved_cursor(rows(spark), "k") == -1


def test_has_data(spark):
    assert not tables.has_data(rows(spark), rows(spark))
    assert tables.has_data(rows(spark), rows(spark, (1, "x", "a")))


def test_upsert_dim_is_unique(spark, tmp_path):
    path = f"{tmp_path}/dim"
    dim = "shop string, product string, link string, seq long"
    first = spark.createDataFrame([("s", "p", "old", 5)], dim)
    second = spark.createDataFrame([("s", "p", "new", 1), ("s", "q", "b", 3), ("s", "q", "a", 2)], dim)
    for load in (first, second, second):
        tables.upsert_dim(load, path, ["shop", "product"])
    got = sorted((r["product"], r["link"]) for r in spark.read.parquet(path).collect())
    assert got == [("p", "old"), ("q", "a")]


def test_route_tables(spark, tmp_path):
    mixed = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "tag string, k long, v string")
    schema = T.StructType([T.StructField("k", T.LongType())])
    for _ in range(2):
        tables.route_tables(mixed, "tag", str(tmp_path))
    found = [tables.routed_table(spark, str(tmp_path), "tag", t, schema) for t in "abc"]
    assert [df.columns for df in found] == [["k"]] * 3
    assert [df.count() for df in found] == [2, 1, 0]


def test_dual_sink_goes_on_after_a_failure(spark, tmp_path):
    def broken(df):
        raise OSError("no sheet")

    with pytest.raises(OSError, match="no sheet"):
        tables.dual_sink(
            rows(spark, (1, "x", "a")), broken, lambda df: tables.append_rows(df, f"{tmp_path}/t")
        )
    assert read(spark, f"{tmp_path}/t") == [(1, "x", "a")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sheets_keep_text(spark, tmp_path, fmt):
    texts = ['a "quoted", text', "two\nlines", " outer ", "", None, "N/A", "é　"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, v string")
    sheets.write_sheet(df, str(tmp_path), "Sheet", fmt)
    got = sheets.read_sheet(spark, str(tmp_path), "Sheet", df.schema, fmt)
    if fmt == "csv":  # as in a workbook, an empty cell is a missing value
        texts[texts.index("")] = None
    assert [r["v"] for r in got.orderBy("k").collect()] == texts


def test_empty_sheet_has_its_columns(spark, tmp_path):
    frames = {name: tables.empty(spark, schema) for name, schema in SCHEMAS.items()}
    sheets.write_sheets(frames, str(tmp_path))
    for name, schema in SCHEMAS.items():
        stored = spark.read.parquet(sheets.sheet_path(str(tmp_path), name))
        assert stored.columns == schema.fieldNames()
        assert stored.count() == 0
    assert sheets.read_sheet(spark, str(tmp_path), "none", SCHEMAS["videos"]).count() == 0


def test_create_tables(spark, tmp_path):
    tables.create_tables(spark, str(tmp_path))
    tables.create_tables(spark, str(tmp_path))
    assert spark.table("lives").columns == SCHEMAS["lives"].fieldNames()


def test_reshape_columns(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert reshape.prefix_columns(df, "Shop_", keep=["a"]).columns == ["a", "Shop_b"]
    assert reshape.fill_missing_column(df, "b", "x").first()["b"] is None
    assert reshape.fill_missing_column(df, "c", "x").first()["c"] == "x"
    # Only an absent column falls through, a missing value does not.
    assert reshape.column_fallback(df, "c", "z", "b", "a").first()["c"] is None
    assert reshape.column_fallback(df, "c", "z").first()["c"] == "N/A"
    assert tuple(reshape.cast_all_string(df).first()) == ("1", None)
    other = spark.createDataFrame([("x", 2.0)], "b string, d double")
    united = reshape.union_ragged(df, other)
    assert united.columns == ["a", "b", "d"]
    assert sorted(map(str, map(tuple, united.collect()))) == ["(1, None, None)", "(None, 'x', 2.0)"]


def test_stream_takes_each_file_and_key_once(spark, tmp_path):
    landing, path, offsets = (f"{tmp_path}/{n}" for n in ("landing", "table", "offsets"))

    def land(*values):
        rows(spark, *values).coalesce(1).write.mode("append").parquet(landing)

    def drain(checkpoint=offsets):
        stream = ingest.read_landing(spark, landing, rows(spark).schema, files_per_batch=1)
        ingest.append_stream(stream, path, checkpoint, ["k"], "v")
        return len(read(spark, path))

    land((1, "x", "a"), (2, "y", "a"), (3, "z", "b"))
    assert drain() == 3
    assert drain() == 3
    land((3, "z", "b"), (4, "w", "b"))
    assert drain() == 4
    # A lost checkpoint replays every file; the stored keys keep it from counting twice.
    assert drain(f"{tmp_path}/offsets2") == 4


def test_stream_into_two_sinks(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    rows(spark, (1, "x", "a"), (2, "y", "b")).write.parquet(landing)

    def save(batch, batch_id):
        tables.dual_sink(
            batch,
            lambda df: tables.append_new(df, f"{tmp_path}/t", ["k"], "v"),
            lambda df: sheets.write_sheet(df, str(tmp_path), "Sheet", "csv", "date_filter"),
        )

    for offsets in ("one", "two"):  # the second checkpoint replays the batch
        stream = ingest.read_landing(spark, landing, rows(spark).schema)
        ingest.drain(stream, save, f"{tmp_path}/{offsets}")
    want = [(1, "x", "a"), (2, "y", "b")]
    assert read(spark, f"{tmp_path}/t") == want
    sheet = sheets.read_sheet(spark, str(tmp_path), "Sheet", rows(spark).schema, "csv")
    assert sorted(map(tuple, sheet.collect())) == want


def test_late_links_rewrite_only_touched_snapshots(spark, tmp_path):
    path = f"{tmp_path}/facts"
    facts = spark.createDataFrame(
        [(1, "ann", "N/A", "d1"), (2, "bob", "N/A", "d1"), (3, "bob", "kept", "d2"), (4, "cid", "N/A", "d3")],
        "k long, creator string, link string, date_filter string",
    )
    tables.overwrite_snapshot(facts, path)
    files = {d: sorted(os.listdir(f"{path}/date_filter={d}")) for d in ("d1", "d3")}
    late = spark.createDataFrame([("bob", "b", 1)], "creator string, url string, seq long")

    def enrich(stored):
        return lookup_first(stored, late, ["creator"], "url", "seq", into="link")

    backfill.backfill_late(spark, path, late, ["creator"], enrich)
    after = spark.read.parquet(path)
    assert {r["k"]: r["link"] for r in after.collect()} == {1: "N/A", 2: "b", 3: "b", 4: "N/A"}
    assert sorted(os.listdir(f"{path}/date_filter=d3")) == files["d3"]
    assert sorted(os.listdir(f"{path}/date_filter=d1")) != files["d1"]
    nobody = late.where("seq = 0")
    backfill.backfill_late(spark, path, nobody, ["creator"], enrich)
    assert spark.read.parquet(path).count() == 4


def test_spine_and_catch_up(spark):
    assert backfill.date_spine(spark, "2025-10-01", "2025-11-30").count() == 61
    loaded = backfill.date_spine(spark, "2025-10-01", "2025-10-05").where(
        F.dayofmonth("day").isin(1, 4)
    )
    seen = []
    days = backfill.catch_up(loaded, "2025-10-01", "2025-10-05", seen.append)
    assert days == seen == [date(2025, 10, d) for d in (2, 3, 5)]
    stamps = spark.sql("SELECT timestamp_ntz'2025-10-03 10:00:00' AS t UNION SELECT timestamp_ntz'2025-10-05 01:00:00'")
    assert backfill.data_spine(stamps, "t").count() == 3


def test_jdbc_columns_follow_the_headers():
    assert headers("product_creators")["tiktok_link"] == "TikTok Link"


def test_jdbc_reads_over_several_connections():
    options = jdbc.read_options("jdbc:x", "lives", ("id", 1, 900, 8), {"user": "u"})
    assert options == {
        "url": "jdbc:x", "dbtable": "lives", "user": "u", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "lives")


def test_rows_without_partition_are_kept_and_not_doubled(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k int, v string, date_filter string"
    batches = [[(1, "a", None), (2, "b", None)], [(2, "b", None), (3, "c", "d1"), (3, "d", "d1"), (3, "e", "d2")], []]
    for batch in [*batches, *batches]:
        tables.append_new(spark.createDataFrame(batch, schema), path, ["k"], "v")
    found = spark.read.schema(schema).parquet(path)
    assert sorted(map(tuple, found.collect())) == [(1, "a", "N/A"), (2, "b", "N/A"), (3, "c", "d1"), (3, "e", "d2")]


def test_missing_number_keys_meet_the_stored_ones(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "k long, t date, v string, date_filter string"
    df = spark.createDataFrame([(None, None, "a", "d"), (None, None, "b", "d"), (0, None, "c", "d")], schema)
    for _ in range(2):
        tables.append_new(df, path, ["k", "t"], "v")
    found = spark.read.schema(schema).parquet(path)
    assert sorted(map(tuple, found.collect()), key=str) == [(0, None, "c", "d"), (None, None, "a", "d")]


def test_a_snapshot_without_rows_is_emptied(spark, tmp_path):
    df = spark.createDataFrame([(1, "d 1 ~ d/1"), (2, "d2")], "k int, date_filter string")
    path = f"{tmp_path}/sheet"
    sheets.write_sheet(df, str(tmp_path), "sheet", partition="date_filter")
    none = df.where("k > 5")
    sheets.write_sheet(none, str(tmp_path), "sheet", partition="date_filter", value="d 1 ~ d/1")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(2, "d2")]
    sheets.write_sheet(none, str(tmp_path), "fresh", partition="date_filter", value="d2")
    fresh = spark.read.parquet(f"{tmp_path}/fresh")
    assert fresh.columns == ["k", "date_filter"] and fresh.isEmpty()


def test_no_copy_is_left_after_a_rewrite(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows(spark, (1, "x", "a")).write.partitionBy("date_filter").parquet(path)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")

    def copies():
        folder = f"{shared}/snaplake"
        return {f for f in (os.listdir(folder) if os.path.isdir(folder) else []) if f.startswith("replace-")}

    before = copies()
    stored = spark.read.schema(rows(spark).schema).parquet(path)
    tables.replace_snapshots(stored.withColumn("v", F.lit("y")), path)
    assert read(spark, path) == [(1, "y", "a")] and copies() == before
