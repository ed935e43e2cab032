"""Document toxicity by a bidirectional gated recurrent network over words.

A word's input has a part from the word and a part from its runs of four and five
characters: hashed vectors, and how strongly the word or run spoke for toxicity in the
labelled sample. The network reads overlapping windows of words both ways; attention
pools its states; a document scores as its highest window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm import words
from snaplake.llm.decontamination import terms_of
from snaplake.llm.learning import Adam, fold, labelled_sample, prior_shift, sigmoid

WINDOW, STRIDE = 64, 48
GRAMS = (4, 5)
BUCKETS = 1 << 18
HASHED = 6
INPUTS = 3 + 2 * HASHED
HIDDEN = 8
BLOCK = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _buckets(x: np.ndarray) -> np.ndarray:
    return (_mix(x) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _signs(x: np.ndarray) -> np.ndarray:
    """A fixed vector of HASHED values of one or minus one for each hash."""
    bits = (x[:, None] >> np.arange(3, 3 + 5 * HASHED, 5, dtype=np.uint64)) & np.uint64(1)
    return bits.astype(np.float32) * 2 - 1


def grams(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character runs of each word, its ends marked, and the words they are of."""
    data = np.frombuffer(b"".join(b"^" + w + b"$" for w in found) + bytes(8), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in found], np.int64)
    of = np.repeat(np.arange(len(found)), sizes)
    left = np.repeat(words.offsets(sizes)[1:], sizes) - np.arange(len(of))
    hashes, owners = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        code = np.full(len(at), n, np.uint64)
        for j in range(n):
            code = (code << np.uint64(8)) | data[at + j]
        hashes.append(_mix(code))
        owners.append(of[at])
    return np.concatenate(hashes), np.concatenate(owners)


class Vocabulary:
    """The distinct words of some documents, and each document's words by number."""

    def __init__(self, texts: list[bytes]):
        numbers: dict[bytes, int] = {}
        self.docs = []
        for text in texts:
            found = terms_of(text)
            self.docs.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found)))
        self.words = list(numbers)
        self.hashes = words.word_hashes(self.words)[:, 0]
        self.grams, self.owners = grams(self.words)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers by window, -1 past the end, and each window's document.

        Windows begin every STRIDE words until one reaches the end of the text.
        """
        sizes = np.array([len(d) for d in self.docs], np.int64)
        counts = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
        of = np.repeat(np.arange(len(sizes)), counts)
        start = STRIDE * (np.arange(len(of)) - words.offsets(counts)[of])
        flat = np.concatenate([*self.docs, np.zeros(1, np.int64)])
        at = start[:, None] + np.arange(WINDOW)
        inside = at < sizes[of][:, None]
        places = np.where(inside, words.offsets(sizes)[of][:, None] + at, 0)
        return np.where(inside, flat[places], -1), of


class BiGru:
    """Two gated recurrent layers, one per direction, attention and a scorer, in numpy."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {"attend": start(2 * HIDDEN, HIDDEN), "query": start(HIDDEN),
                        "score": start(2 * HIDDEN), "score0": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            self.weights |= {f"in_{way}": start(INPUTS, 3 * HIDDEN), f"in0_{way}": np.zeros(3 * HIDDEN, np.float32),
                             f"re_{way}": start(HIDDEN, 3 * HIDDEN)}
        self.word_signal = np.zeros(BUCKETS, np.float32)
        self.gram_signal = np.zeros(BUCKETS, np.float32)
        self.shift = 0.0

    def learn_signals(self, vocabulary: Vocabulary, labels: np.ndarray) -> None:
        """How far words and runs of characters are off their expected share of toxic documents.

        One document of either kind is left out of the count, so that what only
        one document has says as little here as it will in documents not seen.
        """
        share = float(labels.mean())
        order = np.argsort(vocabulary.owners, kind="stable")
        sorted_grams = _buckets(vocabulary.grams[order])
        cuts = np.searchsorted(vocabulary.owners[order], np.arange(len(vocabulary.words) + 1))
        by_word = [sorted_grams[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        word_at = _buckets(vocabulary.hashes)
        seen = np.zeros((2, 2, BUCKETS), np.float32)
        for doc, label in zip(vocabulary.docs, labels, strict=True):
            distinct = np.unique(doc)
            seen[0, int(label), np.unique(word_at[distinct])] += 1
            if len(distinct):
                seen[1, int(label), np.unique(np.concatenate([by_word[i] for i in distinct.tolist()]))] += 1
        seen = np.maximum(seen - 1, 0)
        total = seen.sum(axis=1)
        off = (seen[:, 1] - total * share) / np.sqrt(total * share * (1 - share) + 1)
        self.word_signal, self.gram_signal = np.clip(off, -6, 6) / 3

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        """A row of inputs per distinct word."""
        n = len(vocabulary.words)
        out = np.zeros((n + 1, INPUTS), np.float32)
        out[:n, 0] = self.word_signal[_buckets(vocabulary.hashes)]
        out[:n, 3 : 3 + HASHED] = 0.3 * _signs(vocabulary.hashes)
        if len(vocabulary.owners):
            order = np.argsort(vocabulary.owners, kind="stable")
            owners, hashes = vocabulary.owners[order], vocabulary.grams[order]
            begins = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            of, many = owners[begins], np.diff(np.r_[begins, len(owners)])[:, None]
            signal = self.gram_signal[_buckets(hashes)]
            out[of, 1] = np.maximum.reduceat(signal, begins)
            out[of, 2] = np.add.reduceat(signal, begins) / many[:, 0]
            out[of, 3 + HASHED :] = np.add.reduceat(_signs(hashes), begins, axis=0) / many
        return out

    def _read(self, way: str, gates: np.ndarray, mask: np.ndarray, states: np.ndarray, keep: list | None) -> None:
        """Run one direction over (time, window) gates into ``states``."""
        re = self.weights[f"re_{way}"]
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        steps = range(gates.shape[0]) if way == "f" else range(gates.shape[0] - 1, -1, -1)
        for t in steps:
            back = h @ re
            zr = sigmoid(gates[t, :, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, n, back[:, 2 * HIDDEN :]))
            h = h + mask[t] * (1 - z) * (n - h)
            states[t] = h

    def forward(self, table: np.ndarray, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows of word numbers; ``table`` holds the inputs by word."""
        w = self.weights
        steps, count = windows.shape[1], len(windows)
        ids = windows.T
        mask = (ids >= 0).astype(np.float32)[:, :, None]
        states = np.empty((steps, count, 2 * HIDDEN), np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            gates = (table @ w[f"in_{way}"] + w[f"in0_{way}"])[ids]
            self._read(way, gates, mask, states[:, :, part], kept[way] if keep is not None else None)
        view = np.tanh(states @ w["attend"])
        e = np.where(mask[:, :, 0] > 0, view @ w["query"], np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = (a[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep |= {"ids": ids, "mask": mask, "states": states, "view": view, "a": a, "pooled": pooled, "kept": kept}
        return pooled @ w["score"] + w["score0"]

    def backward(self, table: np.ndarray, f: dict, d: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients through time for ``d``, the loss by logit."""
        w = self.weights
        grads = {"score": f["pooled"].T @ d, "score0": d.sum(keepdims=True)}
        d_pooled = d[:, None] * w["score"]
        d_a = (f["states"] * d_pooled).sum(axis=2)
        d_e = f["a"] * (d_a - (f["a"] * d_a).sum(axis=0))
        grads["query"] = np.einsum("tb,tbk->k", d_e, f["view"])
        d_view = d_e[:, :, None] * w["query"] * (1 - f["view"] ** 2)
        grads["attend"] = np.einsum("tbi,tbk->ik", f["states"], d_view, optimize=True)
        d_states = f["a"][:, :, None] * d_pooled + d_view @ w["attend"].T
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            re = w[f"re_{way}"]
            g_re, g_in, g_in0 = np.zeros_like(re), np.zeros_like(w[f"in_{way}"]), np.zeros(3 * HIDDEN, np.float32)
            d_h = np.zeros((len(d), HIDDEN), np.float32)
            for t, h, z, r, n, back in reversed(f["kept"][way]):
                d_h = d_h + d_states[t][:, part]
                m = f["mask"][t]
                d_n = d_h * m * (1 - z) * (1 - n * n)
                d_z = -d_h * m * (n - h) * z * (1 - z)
                d_r = d_n * back * r * (1 - r)
                d_gate = np.hstack([d_z, d_r, d_n])
                d_back = np.hstack([d_z, d_r, d_n * r])
                g_re += h.T @ d_back
                g_in += table[f["ids"][t]].T @ d_gate
                g_in0 += d_gate.sum(axis=0)
                d_h = d_h * (1 - m * (1 - z)) + d_back @ re.T
            grads |= {f"re_{way}": g_re, f"in_{way}": g_in, f"in0_{way}": g_in0}
        return grads

    def _logits(self, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
        parts = [self.forward(table, windows[a : a + BLOCK]) for a in range(0, len(windows), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def fit(self, texts: list[bytes], labels: np.ndarray, share: float, epochs: int = 10, batch: int = 96, steps: int = 300) -> None:
        """In each round, a toxic document teaches by its highest window, others by that and one more.

        Few documents go round more often, up to ``steps`` batches.
        """
        if not len(labels):
            return
        rng = np.random.default_rng(8)
        vocabulary = Vocabulary(texts)
        windows, of = vocabulary.windows()
        self.learn_signals(vocabulary, labels)
        table = self.inputs(vocabulary)
        begins = np.searchsorted(of, np.arange(len(texts)))
        adam = Adam(self.weights, 0.01)
        for _ in range(max(epochs, min(8 * epochs, steps * batch // len(texts)))):
            logits = self._logits(table, windows)
            order = np.lexsort((logits, of))
            top = order[np.searchsorted(of[order], np.arange(len(texts)), "right") - 1]
            some = begins + rng.integers(0, 1 << 30, len(texts)) % np.bincount(of, minlength=len(texts))
            picked = np.concatenate([top, some[labels == 0]])
            picked = picked[rng.permutation(len(picked))]
            for a in range(0, len(picked), batch):
                rows = picked[a : a + batch]
                f: dict = {}
                logit = self.forward(table, windows[rows], f)
                d = ((sigmoid(logit) - labels[of[rows]]) / len(rows)).astype(np.float32)
                adam.step(self.backward(table, f, d))
        self.shift = prior_shift(labels, share)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The highest window's probability; a text without words is one empty window."""
        vocabulary = Vocabulary(texts)
        windows, of = vocabulary.windows()
        logits = self._logits(self.inputs(vocabulary), windows)
        begins = np.searchsorted(of, np.arange(len(texts)))
        # Rounded, since the last bits depend on what else is in the slice.
        return np.round(sigmoid(np.maximum.reduceat(logits, begins).astype(np.float64) + self.shift), 5)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, rows: int = 1500, most_bytes: int = 1 << 15
) -> BiGru:
    """A model from ``rows`` labels at most of either kind, none of the held-out fold."""
    model = BiGru()
    seen = fold(F.col("doc_id"), folds) != held
    model.fit(*labelled_sample(docs, labels, "toxic", seen, rows, most_bytes))
    return model
