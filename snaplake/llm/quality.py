"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded from
its bytes; a gated attention, learnt from document labels alone, weighs the
passages; the weighted mean of their encodings is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm import words
from snaplake.llm.frames import small_batches
from snaplake.llm.learning import Adam, fold, labelled_sample, prior_shift, sigmoid

PASSAGE = 512
PAIRS = 256
RUNS = 512
EXTRAS = 4
FEATURES = 256 + PAIRS + EXTRAS


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and where each text's passages begin (and end).

    A text is cut into near equal passages of about PASSAGE bytes, one at least.
    Features: roots of the shares of bytes and of hashed byte pairs, how often
    runs of four bytes come back, the share of capitals, and the length.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, np.rint(sizes / PASSAGE).astype(np.int64))
    begins = words.offsets(counts)
    pad = 4  # zero bytes end a text, so neighbours do not matter
    data = np.frombuffer(b"".join(t + bytes(pad) for t in texts) + bytes(pad), np.uint8)
    of = np.repeat(np.arange(len(texts)), sizes + pad)
    inside = np.arange(len(of)) - words.offsets(sizes + pad)[of]
    length = -(-np.maximum(sizes, 1) // counts)
    passage = begins[of] + np.minimum(inside // length[of], counts[of] - 1)
    n, total = int(begins[-1]), len(of)
    own = inside <= sizes[of]  # where a run of four does not reach the next text
    passage = passage[own]

    def histogram(buckets: np.ndarray, wide: int) -> np.ndarray:
        found = np.bincount(passage * wide + buckets[own], minlength=n * wide)
        return found.reshape(n, wide).astype(np.float32)

    single = histogram(data[:total], 256)
    size = single.sum(axis=1, keepdims=True)
    code = data[:total].astype(np.uint32)
    pair = code | data[1 : total + 1].astype(np.uint32) << np.uint32(8)
    run = pair | data[2 : total + 2].astype(np.uint32) << np.uint32(16) | data[3 : total + 3].astype(np.uint32) << np.uint32(24)
    mixed = [(x * np.uint32(0x9E3779B1)) >> np.uint32(32 - b) for x, b in ((pair, 8), (run, 9))]
    pairs, runs = histogram(mixed[0].astype(np.int64), PAIRS), histogram(mixed[1].astype(np.int64), RUNS)
    shares = runs / size
    capitals = single[:, 65:91].sum(axis=1) / (single[:, 65:91].sum(axis=1) + single[:, 97:123].sum(axis=1) + 1)
    extras = np.stack(
        [np.log((shares * shares).sum(axis=1) * 64), shares.max(axis=1) * 4, capitals * 2, np.log(size[:, 0]) - 5], 1
    )
    single[:, 0] = 0
    return np.hstack([np.sqrt(single / size), np.sqrt(pairs / size), extras]).astype(np.float32), begins


class GatedAttention:
    """Passage encoder, gated attention and scorer; weights are trained in numpy."""

    def __init__(self, hidden: int = 32, gate: int = 16, seed: int = 4):
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {
            "encode": start(FEATURES, hidden), "encode0": np.zeros(hidden, np.float32),
            "view": start(hidden, gate), "gate": start(hidden, gate), "attend": start(gate),
            "score": start(hidden), "score0": np.zeros(1, np.float32),
        }
        self.shift = 0.0

    def _forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode0"])
        view, gate = np.tanh(h @ w["view"]), sigmoid(h @ w["gate"])
        e = (view * gate) @ w["attend"]
        of = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        e = np.exp(e - np.maximum.reduceat(e, begins[:-1])[of])
        a = e / np.add.reduceat(e, begins[:-1])[of]
        bag = np.add.reduceat(a[:, None] * h, begins[:-1], axis=0)
        logit = bag @ w["score"] + w["score0"]
        return {"h": h, "view": view, "gate": gate, "a": a, "of": of, "bag": bag, "logit": logit}

    def _backward(self, x: np.ndarray, f: dict[str, np.ndarray], d: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients for ``d``, the loss by logit."""
        w = self.weights
        d_bag = d[:, None] * w["score"]
        by_passage = d_bag[f["of"]]
        d_a = (by_passage * f["h"]).sum(axis=1)
        mean = np.bincount(f["of"], f["a"] * d_a, minlength=len(d))
        d_e = (f["a"] * (d_a - mean[f["of"]])).astype(np.float32)
        d_view = d_e[:, None] * w["attend"] * f["gate"] * (1 - f["view"] ** 2)
        d_gate = d_e[:, None] * w["attend"] * f["view"] * f["gate"] * (1 - f["gate"])
        d_h = f["a"][:, None] * by_passage + d_view @ w["view"].T + d_gate @ w["gate"].T
        d_h *= 1 - f["h"] ** 2
        return {
            "encode": x.T @ d_h, "encode0": d_h.sum(axis=0),
            "view": f["h"].T @ d_view, "gate": f["h"].T @ d_gate,
            "attend": (f["view"] * f["gate"]).T @ d_e,
            "score": f["bag"].T @ d, "score0": d.sum(keepdims=True),
        }

    def fit(self, texts: list[bytes], labels: np.ndarray, share: float, epochs: int = 25, batch: int = 64) -> None:
        if not len(labels):
            return
        rng = np.random.default_rng(5)
        adam = Adam(self.weights, 0.004)
        parts = [passages(texts[a : a + batch]) for a in range(0, len(texts), batch)]
        x = np.concatenate([part for part, _ in parts])
        begins = words.offsets(np.concatenate([np.diff(cuts) for _, cuts in parts]))
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for a in range(0, len(order), batch):
                some = order[a : a + batch]
                rows = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in some])
                cuts = words.offsets(begins[some + 1] - begins[some])
                f = self._forward(x[rows], cuts)
                d = ((sigmoid(f["logit"]) - labels[some]) / len(some)).astype(np.float32)
                adam.step(self._backward(x[rows], f, d))
        self.shift = prior_shift(labels, share)

    def score(self, texts: list[bytes]) -> np.ndarray:
        x, begins = passages(texts)
        # Rounded, since the last bits depend on what else is in the slice.
        return np.round(sigmoid(self._forward(x, begins)["logit"].astype(np.float64) + self.shift), 5)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int = 2000, most_bytes: int = 1 << 15
) -> GatedAttention:
    """A model from ``rows`` labels at most of either kind, none of the held-out fold."""
    model = GatedAttention()
    seen = fold(F.col("doc_id"), folds) != held
    model.fit(*labelled_sample(docs, labels, "quality", seen, rows, most_bytes))
    return model


def score_documents(docs: DataFrame, model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``score``, a row per document, from whole texts and nothing else.

    A missing text is scored as an empty one; rows that repeat are scored alike;
    an empty table gives an empty one. ``keep`` names long columns to carry along.
    """
    columns = ["doc_id", *keep]
    lean = docs.select(
        *(F.col(c).cast("long").alias(c) for c in columns), F.col("text").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            scores = model.score(words.texts(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(scores, pa.float64())], [*columns, "score"]
            )

    schema = ", ".join([*(f"{c} long" for c in columns), "score double"])
    return small_batches(lean).mapInArrow(run, schema)


def accepted(docs: DataFrame, model, threshold: float) -> DataFrame:
    """The rows of ``docs`` whose whole text scores ``threshold`` or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            yield batch.filter(pa.array(model.score(words.texts(batch, "text")) >= threshold))

    return small_batches(docs).mapInArrow(run, docs.schema)
