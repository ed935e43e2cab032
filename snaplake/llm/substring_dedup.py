"""Remove passages that an earlier document has, with a count-min prefilter.

Documents are packed into chunks. Every chunk sketches its windows: a hash row of
the sketch is a list of cells with counts, and cells are dealt out by range, so
that each task merges its share of all partition sketches and no one holds the
whole. A cell's merged count is never below the true count of a window in it.
Chunks get back one bit per cell they have sent, and only windows that look
repeated in every hash row go to the second pass. It groups them exactly, by 96 bits of
hash: each chunk sends a window once, with its smallest document, and gets back
whether another chunk has a smaller one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm import words
from snaplake.llm.frames import small_batches, staged

#: Hash rows of the sketch; the two halves of a window's hash give the cells.
ROWS = 2
#: A missing id ranks with the largest one; whether an id is there is kept apart.
NO_ID = np.iinfo(np.int64).max

CHUNK = "chunk long, n_words long, doc_ids binary, has_id binary, ends binary, body binary"
SENT = "pass int, shard long, chunk long, n long, cells binary, extra binary"
REPLY = "pass int, shard long, chunk long, n long, flags binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Documents in packed chunks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in words.slices(batches, "text"):
            found = words.texts(batch, "text")
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            row = {
                "chunk": [number],
                "n_words": [sum(len(t.split()) for t in found)],
                "doc_ids": [ids.astype(np.int64).tobytes()],
                "has_id": [batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False).tobytes()],
                "ends": [np.cumsum([len(t) for t in found]).astype(np.int64).tobytes()],
                "body": [zstandard.compress(b"".join(found), 1)],
            }
            yield pa.RecordBatch.from_pydict(row)
            number += 1

    return small_batches(docs).mapInArrow(run, CHUNK)


class Windows:
    """The documents of a chunk, and a 128-bit hash of every window in them."""

    def __init__(self, row: dict, length: int):
        ends = np.frombuffer(row["ends"], np.int64)
        body = zstandard.decompress(row["body"]) if len(ends) else b""
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.has_id = np.frombuffer(row["has_id"], bool)
        bounds = [0, *ends.tolist()]
        self.words = [body[a:b].split() for a, b in zip(bounds, bounds[1:], strict=False)]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.bounds = words.offsets(sizes)
        hashed = words.word_hashes([w for doc in self.words for w in doc])
        of = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(of)) - self.bounds[of]
        self.starts = np.flatnonzero(place + length <= sizes[of])
        self.docs = of[self.starts]
        odd = np.random.default_rng(13).integers(0, 1 << 63, (length, 2), np.uint64) * np.uint64(2) + np.uint64(1)
        total = np.zeros((len(self.starts), 2), np.uint64)
        for i in range(length):
            part = hashed[self.starts + i]
            part ^= part >> np.uint64(29)
            total += part * odd[i]
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        self.hashes = total ^ (total >> np.uint64(32))


def _shard(values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Which of equal ranges of ``bits``-bit numbers each value is in."""
    top = (values >> np.uint64(max(bits - 32, 0))).astype(np.uint64)
    return ((top * np.uint64(shards)) >> np.uint64(min(bits, 32))).astype(np.int64)


def _sent(number: int, chunk: int, values: np.ndarray, shards: np.ndarray, *extra: np.ndarray) -> dict:
    """Sorted values cut by shard, each share packed as steps from one to the next."""
    cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else np.zeros(0, int)
    out: dict = {"pass": [], "shard": [], "chunk": [], "n": [], "cells": [], "extra": []}
    for a, b in zip(cuts, [*cuts[1:], len(shards)], strict=True) if len(cuts) else ():
        steps = np.diff(values[a:b], prepend=np.uint64(0))
        out["pass"].append(number)
        out["shard"].append(int(shards[a]))
        out["chunk"].append(chunk)
        out["n"].append(int(b - a))
        out["cells"].append(_steps(steps))
        out["extra"].append(b"".join(np.ascontiguousarray(x[a:b]).tobytes() for x in extra))
    return out


def _steps(steps: np.ndarray) -> bytes:
    """The first value in full, then steps as small as they fit; bytes of a kind together."""
    rest = steps[1:]
    most = int(rest.max()) if len(rest) else 0
    width = next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << (8 * w))
    planes = rest.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return zstandard.compress(steps[:1].tobytes() + bytes([width]) + np.ascontiguousarray(planes).tobytes(), 1)


def _values(packed: bytes) -> np.ndarray:
    raw = zstandard.decompress(packed)
    first, width = np.frombuffer(raw[:8], np.uint64), raw[8]
    planes = np.frombuffer(raw[9:], np.uint8).reshape(width, -1)
    steps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)
    return np.cumsum(np.concatenate([first, steps]), dtype=np.uint64)


def _cells(windows: Windows, number: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's share of one hash row: cells in order, their counts, and each window's cell."""
    cells = windows.hashes[:, number] >> np.uint64(64 - bits)
    return np.unique(cells, return_inverse=True, return_counts=True)


def _flags(replies: pa.Table, number: int) -> np.ndarray:
    """The answers to what a chunk has sent in one pass, in the order sent."""
    mine = replies.filter(pc.equal(replies.column("pass"), number)).sort_by("shard")
    parts = [
        np.unpackbits(np.frombuffer(f, np.uint8), count=n)
        for f, n in zip(mine.column("flags").to_pylist(), mine.column("n").to_pylist(), strict=True)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _suspects(windows: Windows, replies: pa.Table, bits: int) -> np.ndarray:
    """Windows that every hash row of the merged sketch counts twice or more."""
    repeated = np.ones(len(windows.starts), bool)
    for number in range(ROWS):
        _, at, _ = _cells(windows, number, bits)
        repeated &= _flags(replies, number)[at] if len(at) else repeated
    return np.flatnonzero(repeated)


def _keys(windows: Windows, suspects: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct suspect windows of a chunk, with their smallest document, and each suspect's key."""
    high = windows.hashes[suspects, 0]
    low = (windows.hashes[suspects, 1] >> np.uint64(32)).astype(np.uint32)
    ids = windows.ids[windows.docs[suspects]]
    order = np.lexsort((ids, low, high))
    high, low, ids = high[order], low[order], ids[order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])] if len(order) else np.zeros(0, bool)
    key = np.empty(len(order), np.int64)
    key[order] = np.cumsum(new) - 1
    return high[new], low[new], ids[new], key


def _reply(group: pa.Table, number: int, flags: np.ndarray) -> pa.Table:
    ends = words.offsets(np.array(group.column("n").to_pylist(), np.int64))
    packed = [np.packbits(flags[a:b]).tobytes() for a, b in zip(ends, ends[1:], strict=False)]
    return pa.table(
        {
            "pass": pa.array([number] * len(packed), pa.int32()),
            "shard": group.column("shard"),
            "chunk": group.column("chunk"),
            "n": group.column("n"),
            "flags": pa.array(packed, pa.binary()),
        }
    )


def _merge_cells(group: pa.Table) -> pa.Table:
    """Add up one range of a hash row over all chunks; flag cells counted twice or more."""
    cells = np.concatenate([_values(x) for x in group.column("cells").to_pylist()])
    counts = np.frombuffer(b"".join(group.column("extra").to_pylist()), np.uint8).astype(np.int64)
    _, at = np.unique(cells, return_inverse=True)
    return _reply(group, group.column("pass")[0].as_py(), np.bincount(at, counts)[at] >= 2)


def _merge_keys(group: pa.Table) -> pa.Table:
    """Find each window's smallest document over all chunks; flag chunks that are later."""
    high = np.concatenate([_values(x) for x in group.column("cells").to_pylist()])
    low, ids = [], []
    for extra, n in zip(group.column("extra").to_pylist(), group.column("n").to_pylist(), strict=True):
        raw = zstandard.decompress(extra)
        low.append(np.frombuffer(raw[: 4 * n], np.uint32))
        ids.append(np.frombuffer(raw[4 * n :], np.int64))
    low, ids = np.concatenate(low), np.concatenate(ids)
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    starts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
    least = np.minimum.reduceat(ids[order], starts)
    flags = np.empty(len(order), bool)
    flags[order] = ids[order] > np.repeat(least, np.diff(np.r_[starts, len(order)]))
    return _reply(group, ROWS, flags)


def remove_repeats(
    docs: DataFrame,
    window: int = 13,
    shard_words: int = 4_000_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``, a row per document.

    A word goes if a run of ``window`` words over it also begins in a document with
    a smaller id; the runs are those of the input. Kept words are joined by one
    space. Missing and empty texts have no words, shorter ones no windows. Rows
    with the same id do not count as earlier than one another; a missing id ranks with
    2^63-1, later than all others, and is given back as missing. Other columns of ``docs`` are not read, and an
    empty table gives an empty one.
    """
    lean = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunks, _ = staged(_chunks(lean), "substring-chunks")
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    bits = max(10, int(4 * total).bit_length())  # four to eight cells a window
    shards = -(-max(total, 1) // shard_words)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                windows = Windows(row, window)
                for number in range(ROWS):
                    cells, _, counts = _cells(windows, number, bits)
                    few = np.minimum(counts, 255).astype(np.uint8)
                    out = _sent(number, row["chunk"], cells, _shard(cells, bits, shards), few)
                    if out["n"]:
                        yield pa.RecordBatch.from_pydict(out, schema=_SENT)

    def suspects(mine: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for row in mine.to_pylist():
            windows = Windows(row, window)
            high, low, ids, _ = _keys(windows, _suspects(windows, replies, bits))
            sent = _sent(ROWS, row["chunk"], high, _shard(high, 64, shards))
            ends = words.offsets(np.array(sent["n"], np.int64))
            sent["extra"] = [
                zstandard.compress(low[a:b].tobytes() + ids[a:b].tobytes(), 1)
                for a, b in zip(ends, ends[1:], strict=False)
            ]
            out.append(pa.Table.from_pydict(sent, schema=_SENT))
        return pa.concat_tables(out)

    def remove(mine: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict = {"doc_id": [], "n_words": [], "n_removed": [], "kept_text": []}
        for row in mine.to_pylist():
            windows = Windows(row, window)
            suspect = _suspects(windows, replies, bits)
            _, _, least, key = _keys(windows, suspect)
            later = _flags(replies, ROWS)
            earlier = least[key] < windows.ids[windows.docs[suspect]]
            if len(key):
                earlier |= later[key]
            gone = words.covered(windows.starts[suspect[earlier]], window, int(windows.bounds[-1]))
            for doc, found in enumerate(windows.words):
                a, b = windows.bounds[doc : doc + 2]
                drop = gone[a:b]
                kept = [found[i] for i in np.flatnonzero(~drop).tolist()] if drop.any() else found
                out["doc_id"].append(int(windows.ids[doc]) if windows.has_id[doc] else None)
                out["n_words"].append(len(found))
                out["n_removed"].append(int(drop.sum()))
                out["kept_text"].append(b" ".join(kept))
        return pa.table(
            {
                **{c: pa.array(out[c], pa.int64()) for c in ("doc_id", "n_words", "n_removed")},
                "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string()),
            }
        )

    sent = chunks.mapInArrow(sketch, SENT)
    replies, _ = staged(sent.groupBy("pass", "shard").applyInArrow(_merge_cells, REPLY), "substring-cells")
    by_chunk = chunks.groupBy("chunk")
    sent = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(suspects, SENT)
    found, _ = staged(sent.groupBy("pass", "shard").applyInArrow(_merge_keys, REPLY), "substring-keys")
    answers = replies.unionByName(found)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_text string"
    )


_SENT = pa.schema(
    [
        ("pass", pa.int32()),
        ("shard", pa.int64()),
        ("chunk", pa.int64()),
        ("n", pa.int64()),
        ("cells", pa.binary()),
        ("extra", pa.binary()),
    ]
)
