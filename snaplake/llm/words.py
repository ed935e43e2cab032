"""Words and their hashes inside Python tasks, a bounded slice of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice has about ``most`` bytes of text, or one long row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // most
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """UTF-8 texts; a missing one is empty."""
    return [t or b"" for t in batch.column(text).cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits per word, as two unsigned numbers."""
    joined = b"".join(map(xxhash.xxh3_128_digest, words))
    return np.frombuffer(joined, dtype=np.uint64).reshape(-1, 2)


def offsets(sizes: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and the end of the last."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def covered(starts: np.ndarray, lengths: np.ndarray | int, total: int) -> np.ndarray:
    """True at each of ``total`` places inside any of the given ranges."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0
