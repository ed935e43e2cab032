"""Near-duplicates by SimHash, linked through vantage-point trees.

Of two fingerprints that differ in k bits, one half differs in k // 2 bits at
most. So there is a tree per half, searched with that smaller reach, and what it
finds is checked on all 64 bits. The trees come from a bounded sample; every
fingerprint is filed in the leaf it belongs to and looked up in all leaves that the
triangle bounds leave over. Leaves are cut into tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm import vptree, words
from snaplake.llm.components import components
from snaplake.llm.frames import digest128, dropped, small_batches, staged, unused

SEED = 42
LANES = np.uint64(0x0101010101010101)
#: A vantage-point tree is built from twice as many fingerprints at most: 16 MB on the driver.
MOST_SAMPLE = 1 << 20
#: Fingerprints that walk down a tree together.
WALK = 1 << 16


def shingle_hashes(text: bytes, length: int) -> np.ndarray:
    """XXH64 of every run of ``length`` words; of all words if there are fewer."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = min(length, len(found))
    spans = zip(starts[: len(found) - length + 1].tolist(), ends[length - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), ">u8").astype(np.uint64)


def simhash(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint per array: a bit is set if it is in over half of the hashes.

    Bits are counted eight at a time in the byte lanes of a number, in runs of
    255 so that no lane overflows.
    """
    sizes = np.array([len(h) for h in hashes], np.int64)
    if not sizes.sum():
        return np.zeros(len(hashes), np.uint64)
    flat = np.concatenate(hashes)
    full = np.flatnonzero(sizes)
    starts = words.offsets(sizes)[:-1][full]
    runs = -(-sizes[full] // 255)
    first = words.offsets(runs)[:-1]
    run_starts = np.repeat(starts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    prints = np.zeros(len(full), np.uint64)
    for low in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(low)) & LANES, run_starts)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(counts, first, axis=0)
        for byte in range(8):
            over = (2 * counts[:, byte] > sizes[full]).astype(np.uint64)
            prints |= over << np.uint64(8 * byte + low)
    result = np.zeros(len(hashes), np.uint64)
    result[full] = prints
    return result


def fingerprints(
    docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (a long) and ``k1``, ``k2``, which stand for id and text."""
    keys = digest128(F.col(doc_id), F.col(text), salt="row")
    columns = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *(k.alias(n) for k, n in zip(keys, ("k1", "k2"), strict=True)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            prints = simhash([shingle_hashes(t, shingle) for t in words.texts(batch, "text")])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(prints.view(np.int64)),
                    batch.column("k1"),
                    batch.column("k2"),
                ],
                ["doc_id", "fingerprint", "k1", "k2"],
            )

    return small_batches(columns).mapInArrow(run, "doc_id long, fingerprint long, k1 long, k2 long")


def _halves(prints: np.ndarray) -> list[np.ndarray]:
    return [(prints >> np.uint64(32)).astype(np.uint32), prints.astype(np.uint32)]


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of several batches together, since a walk costs about the same for few."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(batch.column("fingerprint").to_numpy(zero_copy_only=False).astype(np.int64))
        if sum(map(len, held)) >= WALK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def tile_blocks(visits: int, filed: int, tile_rows: int) -> tuple[int, int]:
    """Rows and columns of tiles of a leaf: what looks it up is cut apart from what is filed in it,
    so that lookups, which are many more, are not repeated for a leaf of few fingerprints."""
    return max(1, -(-visits // tile_rows)), max(1, -(-filed // tile_rows))


def linked(
    prints: DataFrame,
    most_bits: int = 3,
    leaf_rows: int = 2048,
    sample_rows: int = 1 << 14,
    tile_rows: int = 1 << 13,
) -> DataFrame:
    """Edges (u, v) that connect all of the distinct ``fingerprint`` rows within ``most_bits``.

    Trees are built from ``sample_rows`` fingerprints or one in 128, up to MOST_SAMPLE (twice
    that after rounding), chosen by hash, so that leaves stay small as the table grows. Never
    more than about half of the rows, also of a small table.
    Within a tile only a spanning star per class is given, never all pairs.
    """
    reach = most_bits // 2
    n = prints.count()
    one_in = max(2, n // min(max(sample_rows, n // 128), MOST_SAMPLE))
    chosen = prints.where(F.pmod(F.xxhash64(F.lit("sample"), "fingerprint"), F.lit(one_in)) == 0)
    sample = chosen.select("fingerprint").toPandas()["fingerprint"].to_numpy(np.int64).view(np.uint64)
    trees = [vptree.build(np.sort(half), n // leaf_rows, reach) for half in _halves(sample)]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points in _walks(batches):
            for number, (tree, half) in enumerate(zip(trees, _halves(points.view(np.uint64)), strict=True)):
                rows, leaves = tree.visits(half, reach)
                own_rows, own = tree.visits(half, 0)
                home = np.empty(len(points), np.int64)
                home[own_rows] = own
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), number, np.int32)),
                        pa.array(leaves.astype(np.int32)),
                        pa.array(points[rows]),
                        pa.array(home[rows] == leaves),
                    ],
                    ["tree", "leaf", "fingerprint", "home"],
                )

    visits, visits_path = staged(
        prints.mapInArrow(visit, "tree int, leaf int, fingerprint long, home boolean"), "simhash-visits"
    )
    # A row per leaf, of which the sample bounds the number.
    sizes = (
        visits.groupBy("tree", "leaf")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("home").cast("long")).alias("filed"))
        .collect()
    )
    blocks = [np.ones((2, tree.leaves), np.int64) for tree in trees]
    for row in sizes:
        blocks[row["tree"]][:, row["leaf"]] = tile_blocks(row["n"], row["filed"], tile_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A fingerprint goes to a row of tiles as query and, at home, to a column as data."""
        for batch in batches:
            tree, leaf, points = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "leaf", "fingerprint")
            )
            home = batch.column("home").to_numpy(zero_copy_only=False)
            high, wide = (
                np.where(tree == 0, blocks[0][axis][leaf * (tree == 0)], blocks[1][axis][leaf * (tree == 1)])
                for axis in (0, 1)
            )
            mixed = (points.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for data in (False, True):
                at = np.flatnonzero(home) if data else np.arange(len(points))
                own = (mixed % (wide if data else high).astype(np.uint64)).astype(np.int64)
                times = (high if data else wide)[at]
                other = np.arange(times.sum()) - np.repeat(words.offsets(times)[:-1], times)
                at = np.repeat(at, times)
                tile = (other, own[at]) if data else (own[at], other)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tree[at].astype(np.int32)),
                        pa.array(leaf[at].astype(np.int32)),
                        *(pa.array(t.astype(np.int32)) for t in tile),
                        pa.array(points[at]),
                        pa.array(np.full(len(at), data)),
                    ],
                    ["tree", "leaf", "row", "col", "fingerprint", "data"],
                )

    def search(tile: pa.Table) -> pa.Table:
        points = tile.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64)
        data = tile.column("data").to_numpy()
        u, v = vptree.link(points[~data], points[data], most_bits)
        return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

    tiles = visits.mapInArrow(
        deal, "tree int, leaf int, row int, col int, fingerprint long, data boolean"
    ).groupBy("tree", "leaf", "row", "col")
    edges, _ = staged(tiles.applyInArrow(search, "u long, v long").distinct(), "simhash-edges")
    return dropped(edges, visits_path)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    most_bits: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``class``, ``k1``, ``k2``, a row per document.

    Documents whose fingerprints differ in ``most_bits`` bits or fewer are linked;
    ``component_id`` is the smallest id a document reaches, itself included. A
    missing text is empty, and texts without words have fingerprint zero, linked
    like any other. Rows may repeat; a missing id is never the smallest, and a
    class of such rows alone has none. ``class`` tells classes apart in any case; ``k1``
    and ``k2`` stand for id and text. Other columns of ``docs`` are not read. An empty table
    gives an empty one.
    """
    prints, prints_path = staged(fingerprints(docs, shingle, doc_id, text), "simhash-prints")
    unique, unique_path = staged(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-unique"
    )
    edges = linked(unique.select("fingerprint"), most_bits)
    roots = components(edges)
    classes = unique.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    classes, classes_path = staged(classes, "simhash-classes")
    smallest, smallest_path = staged(
        classes.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-smallest"
    )
    found, _ = staged(
        classes.join(smallest, "root").select(
            "fingerprint", "component_id", F.col("root").alias("class")
        ),
        "simhash-found",
    )
    dropped(found, unique_path, classes_path, smallest_path)
    return prints.join(found, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
        "class",
        "k1",
        "k2",
    )


def one_of_each(
    docs: DataFrame,
    shingle: int = 3,
    most_bits: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: that with the smallest id.

    A missing id is larger than all; among equal ids the smaller hash stays, and of
    equal rows any one. All columns of the rows that stay are kept.
    """
    found, found_path = staged(near_duplicates(docs, shingle, most_bits, doc_id, text), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    best, best_path = staged(
        found.groupBy("class").agg(F.min(order).alias("best")).select("class", "best.k1", "best.k2"),
        "simhash-best",
    )
    rest = found.join(best.select("class", F.col("k1").alias("b1"), F.col("k2").alias("b2")), "class")
    rest, _ = staged(rest.where("k1 <> b1 OR k2 <> b2").select("k1", "k2").distinct(), "simhash-rest")
    again, _ = staged(
        found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2"),
        "simhash-again",
    )
    dropped(rest, found_path, best_path)
    names = unused(docs, "k1", "k2")
    keys = digest128(F.col(doc_id), F.col(text), salt="row")
    keyed = docs.withColumns(dict(zip(names, keys, strict=True)))
    rest, again = (frame.toDF(*names) for frame in (rest, again))
    # What goes is a share of all documents, so it is dealt out with them at any size.
    kept = keyed.join(rest.hint("shuffle_hash"), names, "left_anti")
    if not again.isEmpty():  # equal rows: only they are dealt out by key once more
        once = kept.join(again, names, "left_semi").dropDuplicates(names)
        kept = kept.join(again, names, "left_anti").unionByName(once)
    return kept.drop(*names)
