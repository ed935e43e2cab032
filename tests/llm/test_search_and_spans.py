"""Top-k search and personal data, against plain versions."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest_llm import sort
from snaplake.llm import catalog, pii, top_k


def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)]  # ties beyond k
    rows += [(50, rows[50][1]), (None, [1.0] * 8), (7000, None), (7001, [1.0, None]), (7050, [])]
    rows += [(7002, [math.nan] * 8), (7003, [math.inf] * 8), (7100, [2.0, 1.0])]
    return rows


@pytest.mark.parametrize("strip,block", [(4096, 512), (16, 2)])
def test_top_k(spark, strip, block):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, row int, strip int")
    found = top_k.top_k(df, F.col("vec_id") % 50 == 0, k=5, strip_rows=strip, block_rows=block)
    assert sort(found.collect()) == sort(brute.top_k(rows, lambda i: i % 50 == 0))


def test_queries_by_tiles(spark, monkeypatch):
    """Every row is a query; a hot vector and ties reach over tiles, strips and blocks."""
    rows = [r for r in vectors() if r[0] is not None]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = sort(brute.top_k(rows, lambda i: True))
    monkeypatch.setattr(top_k, "ACCUMULATORS", 1)
    for rows_each in (1 << 14, 50):
        found = top_k.top_k(df, F.lit(True), k=5, strip_rows=rows_each, block_rows=rows_each)
        assert sort(found.collect()) == want


@pytest.mark.parametrize("huge", [[1e6, 7e5], [-3e7, 1e6, 1e13], [1e300, -1e300, 2e16, -5e9]])
def test_huge_components_take_part(spark, huge):
    rows = [r for r in vectors() if r[0] is not None]
    rows += [(8000 + i, [x, -1.5, x / 3] + [0.25] * 5) for i, x in enumerate(huge)] + [(8050, [2e6] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = top_k.top_k(df, F.col("vec_id") % 50 == 0, k=5, strip_rows=60)
    assert sort(found.collect()) == sort(brute.top_k(rows, lambda i: i % 50 == 0))


def test_top_k_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k.top_k(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    two = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    assert sort(top_k.top_k(two, F.lit(True)).collect()) == [(1, 1, 2, 131072), (2, 1, 1, 131072)]


def test_bounds_prove_rows_out():
    rng = np.random.default_rng(0)
    data = rng.integers(-3, 4, (500, 16))
    data[:5] = 60
    of, rows = top_k.ImpactIndex(data).search(np.full((1, 16), 50), 5)
    assert set(rows) == set(range(5)) and set(of) == {0}


def test_spans(messy):
    df, rows, _ = messy
    found = pii.find_personal_data(df).select(
        "doc_id",
        pii.named(F.filter("spans", lambda s: s["base"])).alias("base"),
        pii.named(F.col("spans")).alias("all"),
    )
    got = [tuple(r) for r in found.collect()]
    assert sort(r[:2] for r in got) == sort((d, ",".join(brute.base_spans(t))) for d, t in rows)
    assert all(set(r[1].split(",")) <= set(r[2].split(",")) for r in got if r[1])


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e a@b.c_d@e.f .a@b-.c. a@b",
        "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 00000000000000000000255.1.1.1",
        "4111111111111111 4111 1111-1111 1111 4111111111111112 12345678901234567890 5 5",
        "+1 (614) 555-8001 +12 +1234567890123456 +1((( +44 20 7946 0958.",
        "é😀 +1 (614) 555-8001😀 x@y.zé 1.2.3.4",
        "1" * 5000 + " " + "a" * 5000 + "@" + "b." * 3000 + "c",
    ],
)
def test_strict_rules_as_stated(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.find_personal_data(df, model=(None, {})).select(pii.named(F.col("spans"))).first()[0]
    assert got == ",".join(brute.base_spans(text))


def test_proposals_are_learnt_and_redacted(spark):
    rows = [(i, f"please call +1 ({200 + i}) 555-{1000 + i} today, code {i}7.{i % 9}") for i in range(300)]
    rows += [(1000, "please call 1 (614) 555 8001 today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = df.join(pii.find_personal_data(df), "doc_id").where("doc_id = 1000")
    text, spans = found.select(pii.redacted(F.col("text"), F.col("spans")), pii.named(F.col("spans"))).first()
    assert spans.startswith("phone:")
    assert "555" not in text and text.startswith("please call ") and len(text) == len(rows[-1][1])


def test_rare_kinds_have_thresholds(spark):
    """Far more numbers than the sample has rows do not take the places of the other kinds."""
    numbers = " ".join(f"{10 + n},{n}7" for n in range(60))
    rows = [(i, f"{numbers} {i}") for i in range(300)]
    rows += [(1000 + i, f"please call +1 ({200 + i}) 555-{1000 + i} or write to a{i}@b.example.com") for i in range(40)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))[1]
    assert {pii.KINDS.index("email"), pii.KINDS.index("phone")} <= set(pii.train(found, rows=240)[1])


def test_phones_of_which_a_third_lack_the_plus(spark):
    rows = [
        (i, f"please call {'+' if i % 3 else ''}1 ({200 + i}) 555-{1000 + i} today, code {i}7.{i % 9} of 12.{10 + i % 20}.99")
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(pii.find_personal_data(df).select("doc_id", pii.named(F.col("spans"))).collect())
    assert got == {i: f"phone:12:{12 + text[12:].index(' today')}" for i, text in rows}


def test_cards_with_more_digits_beside_them(spark):
    def number(i, luhn):
        digits = next(d for d in map(str, range(4000123400000000 + 7919 * 10 * i, 10**16)) if brute.luhn(d) == luhn)
        return " ".join(digits[n : n + 4] for n in range(0, 16, 4))

    rows = [(i, f"pay {number(i, True)} today") for i in range(200)]
    rows += [(200 + i, f"part {number(300 + i, False)} in stock") for i in range(200)]
    rows += [(1000, "pay 4111 1111 1111 1111 12/27"), (1001, "pay 77 4111 1111 1111 1111 today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(pii.find_personal_data(df).select("doc_id", pii.named(F.col("spans"))).collect())
    assert "card:4:23" in got[1000].split(",") and "card:7:26" in got[1001].split(",")
    assert not any("card" in got[200 + i] for i in range(200))


def test_many_candidates_in_one_text_take_time_in_proportion(spark):
    def seconds(count):
        text = " ".join(f"{i % 9000 + 1000} call 555 {i % 10000:04d} 12" for i in range(count))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        started = time.time()
        _, found, paths = pii.candidates(docs)
        return found.count(), time.time() - started

    seconds(1000)
    (few, short), (many, long) = seconds(8_000), seconds(32_000)
    assert many > 3.9 * few > 30_000
    assert long < 4 * 2.5 * short + 5


def test_no_spans_in_nothing(nothing):
    assert pii.find_personal_data(nothing).collect() == []


def test_native_plans(spark, sf):
    for name in ("op2_pii", "op3_line_dedup", "op9_mixing"):
        plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
