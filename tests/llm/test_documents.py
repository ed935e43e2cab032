"""The operators over documents, against plain versions, on messy and on whole tables."""

import inspect
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from compare import compare, connect
from conftest_llm import LONG, sort
from snaplake.llm import (
    catalog,
    components,
    decontamination,
    line_dedup,
    mixing,
    sharding,
    simhash,
    substring_dedup,
)

ITEMS = [(1, LONG), (1, LONG), (2, "Same LINE"), (3, None), (4, ""), (None, "tail"), (10, "no id here call 1 614 555 8001 or 10 0")]


def items(spark):
    return spark.createDataFrame([(*i, 0) for i in ITEMS], "item_id long, text string, slice int")


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(spark, sf, name):
    got, want, _ = compare(spark, connect(sf), catalog.QUERIES[name], catalog.ORACLES[name], sf)
    assert got == want and got[1]


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_lines(messy):
    df, rows, _ = messy
    for batches in (1, 7):
        assert sort(line_dedup.drop_common_lines(df, batches=batches).collect()) == sort(brute.line_dedup(rows))


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, min_docs=4, fanout=2)
    for n in range(5):
        runs.absorb(spark.createDataFrame([(1, 1), (n, 2), (9, 9)], "h1 long, h2 long"))
    assert len(runs.levels) > 1 and runs.settled
    assert sort(runs.frequent().collect()) == [(1, 1), (9, 9)]
    runs.drop()


def test_runs_are_met_where_they_lie(spark, conf):
    """A batch is exchanged for its counts and dealt out; runs are neither exchanged nor sorted."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    runs = line_dedup.LineRuns(spark, min_docs=3, buckets=5)
    for n in range(5):
        runs.absorb(spark.createDataFrame([(1, 1), (n, 2)], "h1 long, h2 long"))
    tables = [t for level in runs.levels for t in level]
    settled = [t for level in runs.settled for t in level]
    assert len(tables) == 2 and settled

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    both = spark.table(tables[0]).join(runs._other(tables[1]), runs._same(), "full_outer")
    merge = plan(runs._open(both.select(*(F.coalesce(c, f"of_{c}").alias(c) for c in ("h1", "h2")))))
    assert "SortMergeJoin" in merge and merge.count("Bucketed: true") >= 2
    joined = plan(both)
    assert joined.count("Bucketed: true") == 2 and "Exchange" not in joined and "Sort [" not in joined
    opened = plan(runs._open(spark.table(tables[0])))
    assert opened.count("SortMergeJoin") == len(settled)
    assert "Exchange" not in opened and "Sort [" not in opened
    assert sort(runs.frequent().collect()) == [(1, 1)]
    runs.drop()


def test_lines_settle_once(spark):
    """A line settles from level 0 while level 1 holds shares of it, before and after that is merged."""
    per_batch = [2, 2, 1, 2, 2, 2, 4, 4, 4, 1]
    runs = line_dedup.LineRuns(spark, min_docs=10, fanout=3)
    for n, times in enumerate(per_batch):
        runs.absorb(spark.createDataFrame([(1, 1)] * times + [(2, n)], "h1 long, h2 long"))
        if n >= 8:
            assert sort(runs.frequent().collect()) == [(1, 1)]
    runs.drop()


def test_lines_near_the_limit_in_many_batches(spark):
    rows = [(i, "\n".join([f"own {i}", *(f"line {n}" for n in range(7, 14) if i % 20 < n)])) for i in range(20)]
    rows += [(100 + i, "line 7\nline 9\nLine 11") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sort(line_dedup.drop_common_lines(df, batches=30).collect()) == sort(brute.line_dedup(rows))


def test_batches_grow_with_the_texts():
    sizes = (0, 1 << 30, 30 << 30, 1 << 50)
    assert [line_dedup.batches_for(s) for s in sizes] == [4, 4, 100, 100]
    assert line_dedup.batches_for(5 << 30) == 20


def test_substrings(messy):
    df, rows, _ = messy
    for shard_words in (4_000_000, 100):
        found = substring_dedup.remove_repeats(df, shard_words=shard_words)
        assert sort(found.collect()) == sort(brute.substring_dedup(rows))


def test_sketch_loses_no_repeat(spark):
    """A sketch far too small only sends more windows to the exact pass."""
    rows = [(i, f"w{i} " + " ".join(f"c{j}" for j in range(i % 7, i % 7 + 20))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sort(substring_dedup.remove_repeats(df).collect()) == sort(brute.substring_dedup(rows))


def test_the_largest_id_is_an_id(spark):
    top, text = (1 << 63) - 1, " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(top, text), (None, text), (4, text + " end")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {top: 20, None: 20, 4: 0}


def test_shards(messy, nothing):
    df, rows, _ = messy
    for n in (1, 4, 16):
        found = sharding.shard_documents(df, shards=n)
        got = found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()
        assert sort(got) == sort(brute.shards(rows, n))
    assert found.where("grown_shard IS NOT NULL OR law <> 'bytes'").isEmpty()
    assert set(found.columns) >= {"text", "score", "begin"}
    assert sharding.shard_documents(nothing).collect() == []


def test_shards_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = catalog.op6_sharding(spark, sf).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sort(got) == sort(brute.shards([tuple(r) for r in docs]))
    held = [0] * 16
    for row in got:
        held[row["shard"]] += row["size"]
    assert max(held) - min(held) <= 2 * max(row["size"] for row in got)


def test_equal_rows_are_cut_apart(spark):
    """Rows that all miss their id and have one text are spread over all shards."""
    df = spark.createDataFrame([(None, "same")] * 800 + [(1, "other")], "doc_id long, text string").repartition(4)
    placed = sharding.shard_documents(df, shards=8)
    ranged = sharding.cut_shards(sharding.with_sizes(df), ["doc_id", "text_crc32", "size"], 8)
    assert ranged.columns == ["doc_id", "text", "size", "text_crc32", "shard", "slot"]
    counts = {r["shard"]: (r["n"], r["last"]) for r in placed.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()}
    assert sorted(counts) == list(range(8))
    assert all(99 <= n <= 102 and last == n - 1 for n, last in counts.values())


def test_simhash(messy, spark, sf):
    df, rows, _ = messy
    found = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id")
    assert sort(found.collect()) == sort(brute.simhash(rows))
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sort(catalog.op8_simhash(spark, sf).collect()) == sort(brute.simhash(docs))


def test_trees_and_tiles_lose_no_link(spark, monkeypatch):
    import random

    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    prints = {c for c in centres}
    for c in centres * 20:
        for _ in range(rng.randint(1, 5)):
            c ^= 1 << rng.randrange(64)
        prints.add(c)
    prints |= {rng.getrandbits(64) for _ in range(500)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fingerprint long").repartition(4)
    want = brute.classes(prints)
    for tile, walk in ((1 << 16, 1 << 16), (20, 100)):
        monkeypatch.setattr(simhash, "WALK", walk)
        edges = simhash.linked(df, 3, leaf_rows=64, sample_rows=400, tile_rows=tile)
        roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
        got = [roots.get(p[0], p[0]) for p in signed]
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(got)) for j in range(0, i, 7))


def test_lookups_are_not_repeated_for_small_leaves():
    assert inspect.signature(simhash.linked).parameters["tile_rows"].default == 8192
    assert simhash.tile_blocks(11_000, 2_048, 8192) == (2, 1)
    assert simhash.tile_blocks(30_000, 9_000, 8192) == (4, 2)
    assert simhash.tile_blocks(5, 0, 8192) == (1, 1)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(30)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    df = spark.createDataFrame([e[::-1] if sum(e) % 3 else e for e in edges], "u long, v long")
    found = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert all(found.get(i, i) == 0 for i in range(31))
    assert all(found[1000 + i] == 1000 for i in range(1, 50))


def test_one_of_each(messy):
    df, rows, _ = messy
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sort(kept.select("doc_id", "text").collect()) == sort(brute.one_of_each(rows))


def test_mixing(messy, spark, sf):
    df, _, rows = messy
    got = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = brute.mixing([(r[0], r[3], r[1]) for r in rows])

    def rounded(found):
        return sort((d, n, s, round(t, 6), k) for d, n, s, t, k in found)

    assert rounded(got) == rounded(want)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    got = catalog.op9_mixing(spark, sf).collect()
    assert rounded(got) == rounded(brute.mixing([tuple(r) for r in docs]))
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in mixing.mix(df).collect())


def test_equal_rows_are_taken_up_to_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_BITS", 3)  # many ranges of few rows each
    rows = [(None, "ten words of one text that is always the same", "a")] * 100
    rows += [(i, f"some other words here {i} " * 20, "b") for i in range(3)]
    rows += [(7, "x y", "c")] * 40 + [(8, "", "c")] * 5 + [(9, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = brute.mixing([(d, s, t) for d, t, s in rows])
    assert sort((*r[:3], round(r[3], 6), r[4]) for r in got) == sort((*r[:3], round(r[3], 6), r[4]) for r in want)
    for size in {r["source_size"] for r in got if r["source_size"]}:
        of = [r for r in got if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= max(r["size"] for r in of)
    assert mixing.mixed_rows(df).count() == sum(r["copies"] for r in mixing.mix(df).collect())


def test_budget_is_refined_to_a_document(spark):
    """Buckets of one bit, so that every budget is refined many times."""
    rows = [(f"s{i % 3}", 1 + i % 5, (i * 2654435761) % (1 << 60)) for i in range(600)]
    df = spark.createDataFrame(rows, "source string, size long, position long")
    few = {r["source"]: r["threshold"] for r in mixing.source_rules(df, level_bits=4).collect()}
    many = {r["source"]: r["threshold"] for r in mixing.source_rules(df, level_bits=20).collect()}

    def chosen(limits):
        return [r for r in rows if r[2] < limits[r[0]]]

    assert chosen(few) == chosen(many)


def test_contamination(messy, spark):
    df, rows, _ = messy
    for slop, size in ((0, 4 << 20), (2, 60)):
        found = decontamination.contamination(df, items(spark), slop=slop, slice_bytes=size)
        got = found.drop("k1", "k2").collect()
        want = [(*r[:3], r[3], r[4]) for r in brute.contamination(rows, ITEMS, slop=slop)]
        assert sort(got) == sort(want)
    clean = decontamination.decontaminated(df, items(spark))
    bad = {(r[0], t) for r, (_, t) in zip(brute.contamination(rows, ITEMS), rows, strict=True) if r[2]}
    assert clean.columns == df.columns
    assert sort(clean.select("doc_id", "text").collect()) == sort(r for r in rows if r not in bad)


def test_postings_of_a_frequent_term(spark):
    """A term of several rows of postings, met across the border of two of them."""
    n = 2 * decontamination.PIECE + 50
    docs = spark.createDataFrame([(1, "a " * n + "b c"), (2, "b " * n), (3, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "A " * 10), (8, "a " * 9 + "B"), (9, "b c")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: (n + 2, n + 2, ["7", "8", "9"]), 2: (n, 0, []), 3: (2, 0, [])}


def test_the_benchmark_stays_in_spark(messy, spark, monkeypatch):
    """The driver fetches no rows of either table."""
    df, _, _ = messy

    def refuse(*_):
        raise AssertionError("fetched")

    for name in ("collect", "toLocalIterator", "first", "head", "take", "toPandas", "toArrow"):
        monkeypatch.setattr(type(df), name, refuse)
    decontamination.contamination(df, items(spark), window=3)


def test_rows_may_come_in_another_order_each_time(spark):
    def in_another_order(batches):
        for batch in batches:
            order = list(range(batch.num_rows))
            random.SystemRandom().shuffle(order)
            yield batch.take(pa.array(order))

    draw = random.Random(4)
    texts = [" ".join(draw.choice(LONG.split()) for _ in range(30)) for _ in range(60)]
    bench = [(i, " ".join(texts[i].split()[5:20])) for i in range(0, 60, 5)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 4 + [(None, texts[5])] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).mapInArrow(
        in_another_order, "doc_id long, text string"
    )
    want = sort(r[:4] for r in brute.contamination(rows, bench))
    for size in (100, 4 << 20):
        found = decontamination.contamination(
            docs, spark.createDataFrame(bench, "item_id long, text string"), slice_bytes=size
        )
        assert sort(r[:4] for r in found.select("doc_id", "n_words", "n_hit", "items").collect()) == want


def test_nothing(nothing, spark):
    benchmark = items(spark)
    for found in (
        line_dedup.drop_common_lines(nothing),
        substring_dedup.remove_repeats(nothing),
        simhash.near_duplicates(nothing),
        simhash.one_of_each(nothing),
        mixing.mix(nothing),
        mixing.mixed_rows(nothing),
        decontamination.contamination(nothing, benchmark),
    ):
        assert found.collect() == []
    one = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    hits = decontamination.contamination(one, benchmark.limit(0)).where(F.col("n_hit") > 0)
    assert hits.isEmpty()


def test_columns_named_like_helpers_stay(spark):
    """Names that the operators use for themselves are still columns of what they return."""
    odd = ["_k1", "__k2", "_source", "_epochs", "_threshold", "_part", "_row", "_read", "_begin", "_0", "_copy"]
    rows = [(i, f"{LONG} {'abc'[i % 3]} " * 3 + f"{i // 6} tail", "ab"[i % 2], *[f"{i}"] * len(odd)) for i in range(12)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *odd]).withColumn("doc_id", F.col("doc_id").cast("long"))
    few = spark.createDataFrame([(1, "0 tail abc"), (2, "1 tail")], "item_id long, text string")
    for found in (
        simhash.one_of_each(df),
        mixing.mix(df),
        mixing.mixed_rows(df),
        decontamination.decontaminated(df, few),
        sharding.shard_documents(df),
    ):
        assert found.columns[: len(df.columns)] == df.columns
        got = found.collect()
        assert got and all(r[c] == str(r["doc_id"]) for r in got for c in odd)


def test_a_small_table_is_sampled_too(spark, monkeypatch):
    """The driver never sees all fingerprints, however few there are."""
    from snaplake.llm import vptree

    seen, build = [], vptree.build
    monkeypatch.setattr(vptree, "build", lambda sample, *rest: seen.append(len(sample)) or build(sample, *rest))
    df = spark.range(400).select(F.xxhash64("id").alias("fingerprint"))
    simhash.linked(df).collect()
    assert seen and max(seen) < 300
