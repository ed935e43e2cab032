"""The pipeline, against the plain versions one after the other."""

import pytest

import brute
import corpus_pipeline
from conftest_llm import SCHEMA, sort
from snaplake.llm import quality

SF = "/root/testdata/sf0.001"


def plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    scores = model.score([(r[1] or "").encode() for r in rows])
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.3]
    stays = set(brute.one_of_each([r[:2] for r in rows]))
    rows = [r for r in rows if r[:2] in stays]
    hit = brute.contamination([r[:2] for r in rows], [tuple(i) for i in items])
    rows = [r for r, h in zip(rows, hit, strict=True) if not h[2]]
    mixed = brute.mixing([(r[0], r[2], r[1]) for r in rows])
    rows = [
        r[:2] for r, m in zip(rows, mixed, strict=True) for _ in range(m[4] // m[1] if m[1] else 0)
    ]
    return brute.shards(rows)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "size", "text_crc32", "shard", "slot")
    assert sort(got.collect()) == sort(plain(spark, SF))


def test_stages_return_documents(spark, messy):
    df, _, _ = messy
    docs = df.select("doc_id", "text", "lang", "source")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source"]
        docs.collect()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_empty_documents(spark, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), SF).collect() == []
