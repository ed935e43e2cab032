"""The trained operators: held-out accuracy, gradients, and messy input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import sort
from snaplake.llm import catalog, learning, quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    ones = [s for s, y in zip(scores, labels, strict=True) if y]
    noughts = [s for s, y in zip(scores, labels, strict=True) if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in noughts])


def test_the_bound_counts_usable_documents(spark):
    """Labels of long, missing and absent documents do not take the places of others."""
    texts = [(i, f"short {i}" if i % 10 == 0 else None if i % 10 == 1 else "long " * 50) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 10 % 2) for i in range(400)], "doc_id long, quality int")
    found, kinds, share = learning.labelled_sample(docs, labels, "quality", F.lit(True), 10, 100)
    assert sorted(found) == sorted(f"short {i}".encode() for i in range(0, 200, 10))
    assert list(kinds).count(0) == list(kinds).count(1) == 10 and share == 0.5


@pytest.mark.parametrize("name,label,folds,held", [("op4_quality", "quality", 5, 0), ("op7_toxicity", "toxic", 3, 1)])
def test_held_out_documents(spark, name, label, folds, held):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = catalog.QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert auc([r["score"] for r in unseen], [labels[r["doc_id"]] for r in unseen]) > 0.85


def small(kind, texts, labels, **more):
    model = kind()
    model.fit(texts, np.array(labels, np.float32), 0.5, **more)
    return model


GOOD = b"a plain sentence of words that reads like any other, and goes on for a while. "
BAD = b"buy|buy|buy|now|$$$|" * 4


@pytest.mark.parametrize("kind", [quality.GatedAttention, toxicity.BiGru])
def test_messy_texts_have_scores(messy, nothing, kind):
    df, rows, _ = messy
    model = small(kind, [GOOD, BAD] * 20, [0, 1] * 20, epochs=3)
    got = quality.score_documents(df, model)
    assert sort(r[:1] for r in got.collect()) == sort((d,) for d, _ in rows)
    assert got.where("score IS NULL OR NOT score BETWEEN 0 AND 1").isEmpty()
    by_text = got.groupBy("doc_id").agg(F.count_distinct("score").alias("n")).where("doc_id = 2")
    assert by_text.first()["n"] == 1  # rows that repeat
    assert quality.score_documents(nothing, model).collect() == []


@pytest.mark.parametrize("kind", [quality.GatedAttention, toxicity.BiGru])
def test_neighbours_do_not_matter(kind):
    texts = [GOOD * 30, b"", BAD * 20, b"x", GOOD]
    model = small(kind, [GOOD, BAD] * 20, [0, 1] * 20, epochs=3)
    alone = np.concatenate([model.score([t]) for t in texts])
    assert np.allclose(model.score(texts), alone, atol=1e-5)


@pytest.mark.parametrize("kind", [quality.GatedAttention, toxicity.BiGru])
def test_a_passage_anywhere_counts(kind):
    model = small(kind, [GOOD * 5, GOOD * 3 + BAD] * 60, [0, 1] * 60, epochs=30)
    first, late, none = model.score([BAD + GOOD * 20, GOOD * 20 + BAD, GOOD * 21])
    assert min(first, late) > none


def test_no_labels_still_score(spark, messy):
    df, rows, _ = messy
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for train in (quality.train, toxicity.train):
        assert quality.score_documents(df, train(df, none)).count() == len(rows)


def test_gradients_of_the_attention():
    model = quality.GatedAttention()
    x, begins = quality.passages([GOOD * 20, BAD * 30, b""])
    d = np.array([0.3, -0.7, 0.1], np.float32)
    grads = model._backward(x, model._forward(x, begins), d)
    _check(model.weights, grads, lambda: float(model._forward(x, begins)["logit"] @ d))


def test_gradients_of_the_network():
    model = toxicity.BiGru()
    vocabulary = toxicity.Vocabulary([GOOD * 2, BAD, b"one two"])
    table, (windows, _) = model.inputs(vocabulary), vocabulary.windows()
    d = np.linspace(-1, 1, len(windows)).astype(np.float32)
    kept: dict = {}
    model.forward(table, windows, kept)
    grads = model.backward(table, kept, d)
    _check(model.weights, grads, lambda: float(model.forward(table, windows) @ d))


def _check(weights, grads, loss, step=1e-2):
    rng = np.random.default_rng(0)
    for name, grad in grads.items():
        flat, g = weights[name].reshape(-1), np.asarray(grad).reshape(-1)
        at = int(np.argmax(np.abs(g)))
        for i in (at, int(rng.integers(len(g)))):
            kept = flat[i]
            flat[i] = kept + step
            up = loss()
            flat[i] = kept - step
            down = loss()
            flat[i] = kept
            assert np.isclose((up - down) / (2 * step), g[i], rtol=0.05, atol=5e-3), name


def test_all_windows_cover_the_text():
    vocabulary = toxicity.Vocabulary([b" ".join(b"w%d" % i for i in range(n)) for n in (0, 1, 63, 64, 65, 200)])
    windows, of = vocabulary.windows()
    for doc, words in enumerate(vocabulary.docs):
        seen = windows[of == doc]
        assert set(seen[seen >= 0].tolist()) == set(words.tolist())
