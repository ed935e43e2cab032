"""What the trained operators share: a bounded labelled sample, folds and Adam steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.frames import staged
from snaplake.session import drop_dir


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, seen: Column, rows: int, most_bytes: int
) -> tuple[list[bytes], np.ndarray, float]:
    """Texts, their labels, and the share of label 1 among all that may be learnt from.

    ``rows`` labels at most of either kind, in the order of a hash of their id, of those that
    have a document of ``most_bytes`` or fewer; of ids that repeat, 4 * ``rows`` texts in all.
    This is all that reaches the driver.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & seen).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.xxhash64("doc_id")
    short = docs.select("doc_id", F.encode("text", "UTF-8").alias("text")).where(F.octet_length("text") <= most_bytes)
    # Ids only, once each, are dealt out for this.
    with_text, path = staged(usable.join(short.select("doc_id").distinct(), "doc_id", "left_semi"), "labels-usable")
    first = [with_text.where(F.col("label") == y).orderBy(place, "doc_id").limit(rows) for y in (0, 1)]
    some = first[0].unionByName(first[1])
    picked = (
        short.join(F.broadcast(some), "doc_id")  # 2 * rows rows of two numbers
        .select("text", "label", place.alias("place"))
        .orderBy("place", "text", "label")
        .limit(4 * rows)
        .collect()
    )
    drop_dir(docs.sparkSession, path)
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return (
        [bytes(r["text"]) for r in picked],
        np.array([r["label"] for r in picked], np.float32),
        min(max(share, 1e-3), 1 - 1e-3),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def prior_shift(labels: np.ndarray, share: float) -> float:
    """What to add to a logit learnt on a sample whose share of ones differs."""
    mean = min(max(float(labels.mean()) if len(labels) else share, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)) - np.log(mean / (1 - mean)))


class Adam:
    """Steps for a dictionary of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, decay: float = 1e-4):
        self.weights, self.rate, self.decay, self.t = weights, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = g + self.decay * self.weights[k]
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.weights[k] -= self.rate * m / (np.sqrt(v) + 1e-7)
