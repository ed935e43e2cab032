"""The log of versions: whole commits, files rewritten one by one, sinks caught up alone."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.operators.enrich import lookup_first
from snaplake.sources import versions
from snaplake.sources.versions import Conflict, Ledger, Warehouse, backfill_files

SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("creator_link", T.StringType()),
        T.StructField("date_filter", T.StringType()),
    ]
)
A, B = "2025-10-01 ~ 2025-10-01", "2025-10-02 ~ 2025-10-02"


def rows(spark, *found):
    return spark.createDataFrame(found, SCHEMA)


def names(df):
    return sorted(r["name"] for r in df.collect())


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def data_files(house):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, files in os.walk(house.root)
        for f in files
        if f.endswith(".parquet")
    }


def test_a_commit_shows_in_all_tables_at_once(spark, house):
    assert house.read("videos", SCHEMA).count() == 0 and house.state().version == -1
    commit = house.commit()
    commit.append("videos", rows(spark, (1, "v", "N/A", A), (2, "w", "N/A", None)))
    commit.append("lives", rows(spark, (3, "l", "N/A", B)))
    assert house.read("videos", SCHEMA).count() == 0
    assert commit.publish() == 0
    assert names(house.read("videos", SCHEMA)) == ["v", "w"] and names(house.read("lives", SCHEMA)) == ["l"]
    before = house.state()
    again = house.commit()
    again.append("videos", rows(spark, (4, "x", "N/A", B)))
    again.publish()
    assert names(house.read("videos", SCHEMA, state=before)) == ["v", "w"]
    assert names(house.read("videos", SCHEMA, [B])) == ["x"] and names(house.read("videos", SCHEMA, [None])) == ["w"]
    assert house.read("videos", SCHEMA).columns == SCHEMA.fieldNames()


def test_a_commit_that_fails_leaves_nothing_to_see(spark, house):
    commit = house.commit()
    commit.append("videos", rows(spark, (1, "v", "N/A", A)))
    broken = rows(spark, (2, "l", "N/A", A)).withColumn("name", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        commit.append("lives", broken)
    assert house.versions() == [] and house.read("videos", SCHEMA).isEmpty()


def test_commits_side_by_side(spark, house):
    first, second, third = house.commit(), house.commit(), house.commit()
    first.append("videos", rows(spark, (1, "v", "N/A", A)))
    second.append("lives", rows(spark, (2, "l", "N/A", A)))
    third.append_new("videos", rows(spark, (3, "v", "N/A", A)), ["name"], "seq")
    assert (first.publish(), second.publish()) == (0, 1)
    with pytest.raises(Conflict, match="videos"):
        third.publish()  # it has not seen the row that the first has added
    retry = house.commit()
    retry.append_new("videos", rows(spark, (3, "v", "N/A", A), (4, "z", "N/A", A)), ["name"], "seq")
    retry.publish()
    assert [(r["seq"], r["name"]) for r in house.read("videos", SCHEMA).orderBy("seq").collect()] == [(1, "v"), (4, "z")]


def test_a_replayed_batch_adds_nothing(spark, house):
    keys = {"videos": ["name"], "lives": ["name"]}
    for batch in (0, 0, 1, 1, 0):
        frames = {"videos": rows(spark, (batch, f"v{batch}", "N/A", A)), "lives": rows(spark, (batch, f"l{batch}", "N/A", A))}
        versions.append_stream(house, "pages", batch, frames, keys, "seq")
    assert house.versions() == [0, 1]
    assert names(house.read("videos", SCHEMA)) == ["v0", "v1"] and names(house.read("lives", SCHEMA)) == ["l0", "l1"]


def test_the_list_is_repeated_now_and_then(spark, house, monkeypatch):
    monkeypatch.setattr(versions, "WHOLE_EVERY", 4)
    for i in range(10):
        commit = house.commit("s", i)
        commit.append("videos", rows(spark, (i, f"v{i}", "N/A", A)))
        commit.publish()
    read = []
    entry = Warehouse.entry
    monkeypatch.setattr(Warehouse, "entry", lambda self, v: read.append(v) or entry(self, v))
    state = house.state()
    assert read == [8, 9] and len(state.tables["videos"]) == 10 and state.streams == {"s": 9}
    assert len(house.state(5).tables["videos"]) == 6


def test_late_links_rewrite_the_files_they_are_in(spark, house, conf):
    conf("spark.sql.files.maxRecordsPerFile", "3")
    commit = house.commit()
    commit.append("videos", rows(spark, *((i, f"c{i}", "N/A", A) for i in range(300))).coalesce(1))
    commit.publish()
    before = data_files(house)
    assert len(before) == 100
    late = spark.createDataFrame([("c201", "link", 1), ("nobody", "x", 2)], "name string, link string, seq long")
    late = late.withColumn("seq_", F.col("seq")).drop("seq")

    def enrich(stored):
        return lookup_first(stored, late, ["name"], "link", "seq_", into="creator_link")

    def may_change(stored):
        return stored.join(late.select("name"), "name", "left_semi").select(*stored.columns)

    assert backfill_files(house, "videos", SCHEMA, enrich, "creator_link", may_change) == 1
    after = data_files(house)
    assert len(after) == 101 and before.items() <= after.items()
    stored = house.read("videos", SCHEMA)
    assert stored.count() == 300
    assert [tuple(r) for r in stored.where("creator_link <> 'N/A'").collect()] == [(201, "c201", "link", A)]
    assert len(house.state().tables["videos"]) == 100
    assert names(house.read("videos", SCHEMA, state=house.state(0)).where("creator_link <> 'N/A'")) == []
    assert backfill_files(house, "videos", SCHEMA, enrich, "creator_link", may_change) == 0
    assert house.versions() == [0, 1]
    assert house.vacuum(1) == 1 and house.read("videos", SCHEMA).count() == 300


def test_a_rewrite_and_a_change_of_the_same_table_conflict(spark, house):
    commit = house.commit()
    commit.append("videos", rows(spark, (1, "v", "N/A", A)))
    commit.publish()
    rewrite = house.commit()
    rewrite.replace("videos", list(rewrite.base.tables["videos"]), rows(spark, (1, "v", "link", A)))
    other = house.commit()
    other.append("videos", rows(spark, (2, "w", "N/A", A)))
    other.publish()
    with pytest.raises(Conflict):
        rewrite.publish()
    assert names(house.read("videos", SCHEMA)) == ["v", "w"]


def test_a_sink_that_fails_is_caught_up_alone(spark, house, tmp_path):
    for i in range(3):
        commit = house.commit("pages", i)
        commit.append("videos", rows(spark, (i, f"v{i}", "N/A", A)))
        commit.append("lives", rows(spark, (i, f"l{i}", "N/A", A)))
        commit.publish()
    calls, broken = [], [True]

    def sink(name):
        def write(version, frames):
            calls.append((name, version))
            if name == "sheets" and version == 1 and broken:
                frames["videos"].write.mode("overwrite").parquet(f"{tmp_path}/{name}/{version}/videos")
                raise OSError("sheet is locked")
            for table, df in frames.items():
                df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/{version}/{table}")

        return write

    ledger, sinks = Ledger(house), {"sheets": sink("sheets"), "database": sink("database")}
    schemas = {"videos": SCHEMA, "lives": SCHEMA}
    with pytest.raises(OSError, match="locked"):
        ledger.catch_up_all(sinks, schemas)
    assert (ledger.applied("sheets"), ledger.applied("database")) == (0, 2)
    broken.clear()
    calls.clear()
    assert ledger.catch_up_all(sinks, schemas) == {"sheets": [1, 2], "database": []}
    assert calls == [("sheets", 1), ("sheets", 2)]
    for name in sinks:
        stored = spark.read.parquet(*(f"{tmp_path}/{name}/{v}/{t}" for v in range(3) for t in schemas))
        assert names(stored) == ["l0", "l1", "l2", "v0", "v1", "v2"]
