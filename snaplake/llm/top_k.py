"""Exact top-k inner product search with an impact-ordered index, score at a time.

Rows are dealt into strips. The index of a strip has a posting segment for every
dimension and impact level, an impact being the size of a component. Segments are
processed from the highest level down, for a block of queries at once, adding to
one accumulator per query and row. What is left of a row after a level is a
vector of small components, so by Cauchy-Schwarz its part of the score lies within
the product of its length and the query's. Rows whose upper bound is below the
k-th best lower bound of the strip are proved out. Processing stops when those left are few
enough to be scored again exactly, or when no segment is left.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged

MOST_LONG = (1 << 63) - 1
LEVELS = 16
#: Accumulators at a time, few enough to stay in cache.
ACCUMULATORS = 1 << 19
#: A strip is not cut below this many rows to keep more tasks busy.
LEAST_STRIP = 2048
FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, or the nearest number within ``MOST_LONG`` of zero."""
    least = F.lit(-MOST_LONG)
    return F.transform(vector, lambda x: F.greatest(F.floor(F.lit(scale) * x.cast("double")).cast("long"), least))


def usable(vector: Column) -> Column:
    """No vector that is missing or has a missing or non-finite component."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )


class ImpactIndex:
    """Posting segments of a strip of integer vectors, by impact level, then dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        size = np.abs(vectors)
        self.top = top = max(int(size.max(initial=0)), 1)
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        level = np.where(size > 0, (size * LEVELS + top - 1) // top, 0)
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.left: list[np.ndarray] = []
        for impact in range(LEVELS, 0, -1):
            of_level = []
            rows, dims = np.nonzero(level == impact)
            order = np.argsort(dims, kind="stable")
            rows, dims = rows[order], dims[order]
            cuts = np.searchsorted(dims, np.arange(vectors.shape[1] + 1))
            for d in np.flatnonzero(np.diff(cuts)):
                ids = rows[cuts[d] : cuts[d + 1]]
                of_level.append((int(d), ids, vectors[ids, d]))
            self.segments.append(of_level)
            rest = np.where(level < impact, vectors, 0).astype(np.float64)
            self.left.append(np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9))

    def search(self, queries: np.ndarray, k: int, few: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of every possible member of a top k: all members, and few others.

        Scores so far are exact integers; bounds are rounded outwards.
        """
        n, width = self.vectors.shape
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        largest = self.top * int(np.abs(queries).max(initial=0)) * max(width, 1)
        kind = np.int32 if 4 * largest < 1 << 31 else np.int64
        asked = queries.astype(kind)
        sums = np.zeros((n, len(queries)), kind)
        possible = np.ones((len(queries), n), bool)
        for of_level, left in zip(self.segments, self.left, strict=True):
            for d, ids, impacts in of_level:
                sums[ids] += impacts.astype(kind)[:, None] * asked[:, d]
            # Bounds cost about as much as a level; they prove little while much is left.
            if n <= k or np.median(left) > 0.12 * np.median(self.lengths):
                continue
            slack = np.ceil(lengths[:, None] * left).astype(kind)
            so_far = np.ascontiguousarray(sums.T)
            bar = np.partition(so_far - slack, n - k, axis=1)[:, n - k]
            possible = so_far + slack >= bar[:, None]
            if possible.mean() <= few:
                break
        return np.nonzero(possible)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones are filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _split(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose products surely fit a long with room for bounds, and the others."""
    fits = np.abs(vectors).max(axis=1, initial=0) <= math.isqrt((1 << 61) // max(vectors.shape[1], 1))
    return np.flatnonzero(fits), np.flatnonzero(~fits)


def _unbounded(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Scores of all pairs in whole numbers of any size, then the nearest long."""
    scores = queries.astype(object) @ data.T.astype(object)
    return np.clip(scores, -MOST_LONG, MOST_LONG).astype(np.int64)


def _best(of: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which of the scored pairs are among the k best of their query; ties to the smaller id."""
    order = np.lexsort((ids, -scores, of))
    first = np.r_[True, of[order][1:] != of[order][:-1]] if len(order) else np.zeros(0, bool)
    begins = np.flatnonzero(first)
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return order[rank < k]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    strip_rows: int = 1 << 14,
    block_rows: int = 1 << 14,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` best rows of every query.

    All rows are searched, but for those with the query's own id. The score is the inner
    product of the vectors as integers; of unequal lengths the shorter one is
    filled up with zeros. Vectors that are missing, or have missing or non-finite
    components take no part, and neither do rows without an id. A component or score
    beyond a long is the nearest long; vectors too large for the index are scored one by one. Rows that repeat under one id are separate candidates; queries that repeat are
    asked once. Fewer than ``k`` candidates are all returned. Other columns are
    not read, and an empty table gives an empty one.
    """
    found = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        quantised(F.col(vector), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("row"),
    )
    found, path = staged(found, "top-k-vectors")
    counted = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_query").alias("asked"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"),
        F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0)).alias("top"),
    ).first()
    if counted["top"] < 1 << 31:  # half the bytes to shuffle
        found = found.withColumn("v", F.col("v").cast("array<int>"))
    # A row travels once per block of queries and a query once per strip, so both are large; only
    # where that leaves tasks idle are strips smaller.
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    strips = max(1, -(-counted["n"] // strip_rows), min(tasks, counted["n"] // LEAST_STRIP))
    blocks = max(1, -(-counted["asked"] // block_rows))
    width = counted["width"]
    strip = F.pmod(F.xxhash64("row"), F.lit(strips)).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    rows = found.select(
        "vec_id", "v", strip.alias("strip"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    asked = found.where("is_query").dropDuplicates(["vec_id"]).select(
        "vec_id", "v", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip")
    )

    def search(strip_: pa.Table, block_: pa.Table) -> pa.Table:
        if not (strip_.num_rows and block_.num_rows):
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        data, queries = _matrix(strip_.column("v"), width), _matrix(block_.column("v"), width)
        ids, names = (t.column("vec_id").to_numpy() for t in (strip_, block_))
        # One more than asked for, as a query may find itself; its own copies go first.
        own = np.unique(ids, return_counts=True)[1].max(initial=1)
        (rows, large), (plain, wide) = _split(data), _split(queries)
        index, tile = ImpactIndex(data[rows]), max(16, ACCUMULATORS // len(data))
        parts = []

        def keep(of: np.ndarray, at: np.ndarray, scores: np.ndarray) -> None:
            other = ids[at] != names[of]
            of, at, scores = of[other], at[other], scores[other]
            best = _best(of, ids[at], scores, k)
            parts.append((names[of[best]], ids[at[best]], scores[best]))

        for first in range(0, len(plain), tile):
            some = plain[first : first + tile]
            of, at = index.search(queries[some], k + int(own))
            of, at = some[of], rows[at]
            scores = np.empty(len(of), np.int64)
            for a in range(0, len(of), 1 << 18):
                part = slice(a, a + (1 << 18))
                scores[part] = (data[at[part]] * queries[of[part]]).sum(axis=1)
            keep(of, at, scores)
        for asked_, against in ((plain, large), (wide, np.arange(len(data)))):
            for of in asked_ if len(against) else ():
                keep(np.full(len(against), of), against, _unbounded(queries[of], data[against]))
        of, at, scores = (np.concatenate(c) for c in zip(*parts, strict=True))
        best = _best(of, at, scores, k)
        return pa.table({"query_id": of[best], "vec_id": at[best], "score": scores[best]})

    best, _ = staged(
        rows.groupBy("strip", "block").cogroup(asked.groupBy("strip", "block")).applyInArrow(search, FOUND),
        "top-k-strips",
    )
    dropped(best, path)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
