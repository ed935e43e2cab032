"""Centroid clustering in whole numbers, with bounds that spare most comparisons.

Every vector keeps its nearest and second-nearest centroid, an upper bound of its
distance to the first and a lower bound of its distance to all others. Bounds move with
the centroids, and a vector whose bounds stay apart is not looked at. Of the others, the
distances to both remembered centroids are taken anew, and the search begins at the
closer one, c: its neighbours come in the order of their distance from it, and as any
centroid that is nearer than the second-nearest so far lies within that distance plus
the vector's own from c, the ball that is searched shrinks with each one found. Bounds
are floating numbers with a margin and only rule out; what they leave is compared in
integers, ties to the smaller number.

Vectors lie in blocks with their bounds. A round is one pass that writes the blocks
anew, with the sums of their clusters, which Spark adds up; what reaches the driver is a
row for each component of each centroid.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged
from snaplake.llm.top_k import usable

MOST_LONG = (1 << 63) - 1
BLOCK_ROWS = 4096
LIMB = 30
#: Bounds give way by this share, far more than floating numbers can be wrong.
MARGIN = 1e-9

_PARTS = pa.list_(
    pa.struct([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())])
)
_BLOCK = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("wide", pa.bool_()),
        ("vectors", pa.binary()),
        ("near", pa.binary()),
        ("second", pa.binary()),
        ("upper", pa.binary()),
        ("lower", pa.binary()),
        ("parts", _PARTS),
    ]
)
BLOCK = (
    "ids array<bigint>, wide boolean, vectors binary, near binary, second binary, upper binary, lower binary, "
    "parts array<struct<cluster:int,dim:int,limb:int,total:bigint>>"
)
PLACED = "vec_id long, cluster int, distance long"


def kept_vector(vector: Column, dims: int) -> Column:
    """Exactly ``dims`` components, all of them finite numbers."""
    return F.coalesce(usable(vector) & (F.size(vector) == dims), F.lit(False))


def small_bound(dims: int) -> int:
    """Vectors of components within this bound of zero have squared distances that fit a long."""
    return math.isqrt((1 << 62) // max(dims, 1)) // 2


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly."""
    y = scale * x
    return math.floor(y) if math.isfinite(y) and abs(y) < 1 << 53 else math.floor(Fraction(x) * scale)


def _integers(vectors: np.ndarray, scale: int, small: int) -> np.ndarray:
    """floor(scale * x) of all components, as longs if every one is small."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    if (np.abs(scaled) <= small).all():
        return scaled.astype(np.int64)
    return np.array([[whole(x, scale) for x in row] for row in vectors.tolist()], object)


def _blocks(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """Kept vectors as integers in blocks; those with large components in blocks of their own."""
    small = small_bound(dims)

    def block(ids: list, rows: np.ndarray, wide: bool) -> pa.RecordBatch:
        held = rows if wide else _integers(rows, scale, small).astype(np.int32)
        none = np.full(len(rows), -1, np.int32).tobytes()
        row = {
            "ids": [ids],
            "wide": [wide],
            "vectors": [held.tobytes()],
            "near": [none],
            "second": [none],
            "upper": [np.full(len(rows), np.inf).tobytes()],
            "lower": [np.zeros(len(rows)).tobytes()],
            "parts": [[]],
        }
        return pa.RecordBatch.from_pydict(row, schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks are filled across batches, whatever the session makes the size of these.
        waiting = {wide: ([], np.empty((0, dims))) for wide in (False, True)}
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = flat.reshape(-1, dims)
            with np.errstate(over="ignore"):
                fits = (np.abs(np.floor(rows * scale)) <= small).all(axis=1)
            for wide in (False, True):
                at = np.flatnonzero(fits != wide)
                of, held = waiting[wide]
                of, held = of + [ids[i] for i in at.tolist()], np.concatenate([held, rows[at]])
                while len(of) >= BLOCK_ROWS:
                    yield block(of[:BLOCK_ROWS], held[:BLOCK_ROWS], wide)
                    of, held = of[BLOCK_ROWS:], held[BLOCK_ROWS:]
                waiting[wide] = of, held
        for wide, (of, held) in waiting.items():
            if of:
                yield block(of, held, wide)

    return vectors.mapInArrow(run, BLOCK)


class Centroids:
    """Integer centroids, their distances from each other, and each one's neighbours in order."""

    def __init__(self, rows: list[list[int]], before: list[list[int]] | None = None):
        self.rows = rows
        self.wide = any(abs(x) > small_bound(len(row)) for row in rows for x in row)
        self.table = np.array(rows, object if self.wide else np.int64)
        self.apart = np.array([[_root(squared(a, b)) for b in rows] for a in rows]).reshape(len(rows), len(rows))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        others = self.apart + np.diag(np.full(len(rows), np.inf))
        self.half = others.min(axis=1, initial=np.inf) / 2
        moved = [0.0] * len(rows) if before is None else [_root(squared(a, b)) for a, b in zip(before, rows, strict=True)]
        self.moved = np.array(moved)


def squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _root(n: int) -> float:
    """The square root of a whole number of any size."""
    return math.sqrt(n) if n < 1 << 1000 else float(math.isqrt(n)) if n < 1 << 2000 else math.inf


class Search:
    """Assign the vectors of a block, given what is remembered of each."""

    def __init__(self, vectors: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.vectors = vectors
        self.near, self.second = near.copy(), second.copy()
        self.upper, self.lower = upper.copy(), lower.copy()
        self.compared = 0

    def distances(self, rows: np.ndarray, cents: Centroids, which: np.ndarray | int) -> np.ndarray:
        self.compared += len(rows)
        apart = self.vectors[rows] - cents.table[which]
        return (apart * apart).sum(axis=1)

    def shift(self, cents: Centroids) -> None:
        """Let the bounds follow the centroids."""
        if len(self.near) and self.near[0] >= 0:
            self.upper += cents.moved[self.near]
            by_far = np.argsort(-cents.moved, kind="stable")
            far, next_ = cents.moved[by_far[0]], cents.moved[by_far[1]] if len(by_far) > 1 else 0.0
            self.lower -= np.where(self.near == by_far[0], next_, far)

    def assign(self, cents: Centroids) -> None:
        """The nearest centroid of every vector, exactly."""
        k = len(cents.rows)
        if k == 1:
            self.near[:] = 0
            return
        if len(self.near) and self.near[0] < 0:
            self.near[:], self.second[:] = 0, 1
        else:
            self.shift(cents)
        open_ = np.flatnonzero(~self._apart(cents, np.arange(len(self.near))))
        first = self.distances(open_, cents, self.near[open_])
        self.upper[open_] = _roots(first)
        left = ~self._apart(cents, open_)
        open_, first = open_[left], first[left]
        if not len(open_):
            return
        other = self.distances(open_, cents, self.second[open_])
        a, b = self.near[open_], self.second[open_]
        swap = (other < first) | ((other == first) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        one, two = np.where(swap, other, first), np.where(swap, first, other)
        start, begun = a.copy(), _roots(one)
        for c in np.unique(start):
            at = np.flatnonzero(start == c)
            for j in cents.order[c]:
                if j == c:
                    continue
                # Beyond this ball no centroid is nearer than the second-nearest so far.
                reach = (begun[at] + _roots(two[at])) * (1 + MARGIN)
                at = at[cents.apart[c, j] <= reach]
                if not len(at):
                    break
                new = at[(a[at] != j) & (b[at] != j)]
                found = self.distances(open_[new], cents, j)
                closer = (found < one[new]) | ((found == one[new]) & (j < a[new]))
                between = ~closer & ((found < two[new]) | ((found == two[new]) & (j < b[new])))
                push = new[closer]
                b[push], two[push] = a[push], one[push]
                a[push], one[push] = j, found[closer]
                put = new[between]
                b[put], two[put] = j, found[between]
        self.near[open_], self.second[open_] = a, b
        self.upper[open_], self.lower[open_] = _roots(one), _roots(two)

    def _apart(self, cents: Centroids, rows: np.ndarray) -> np.ndarray:
        """Vectors whose nearest centroid the bounds prove to be the same."""
        least = np.maximum(self.lower[rows], cents.half[self.near[rows]])
        with np.errstate(invalid="ignore"):
            return self.upper[rows] * (1 + MARGIN) + MARGIN < least * (1 - MARGIN)


def _roots(numbers: np.ndarray) -> np.ndarray:
    if numbers.dtype == object:
        return np.array([_root(n) for n in numbers.tolist()], np.float64)
    return np.sqrt(numbers.astype(np.float64))


def _parts(vectors: np.ndarray, near: np.ndarray, k: int) -> list[dict]:
    """The number of vectors in each cluster (dimension -1), and the sums of their components in limbs."""
    out = []
    for c in range(k):
        mine = vectors[near == c]
        if not len(mine):
            continue
        out.append((c, -1, 0, len(mine)))
        for dim, total in enumerate(mine.sum(axis=0).tolist()):
            limb, sign, size = 0, -1 if total < 0 else 1, abs(total)
            while size:
                out.append((c, dim, limb, sign * (size & ((1 << LIMB) - 1))))
                size >>= LIMB
                limb += 1
    return [dict(zip(("cluster", "dim", "limb", "total"), x, strict=True)) for x in out]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A block at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _opened(row: dict, dims: int, scale: int, cents: Centroids) -> Search:
    held = np.frombuffer(row["vectors"], np.float64 if row["wide"] else np.int32).reshape(-1, dims)
    vectors = _integers(held, scale, -1) if row["wide"] else held.astype(object if cents.wide else np.int64)
    bounds = [
        np.frombuffer(row[c], t)
        for c, t in (("near", np.int32), ("second", np.int32), ("upper", np.float64), ("lower", np.float64))
    ]
    return Search(vectors, *bounds)


def _round(blocks: DataFrame, cents: Centroids, dims: int, scale: int) -> DataFrame:
    """Every block with its vectors assigned, their bounds, and the sums of its clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                search = _opened(row, dims, scale, cents)
                search.assign(cents)
                for c in ("near", "second", "upper", "lower"):
                    row[c] = getattr(search, c).tobytes()
                row["parts"] = _parts(search.vectors, search.near, len(cents.rows))
                yield pa.RecordBatch.from_pylist([row], schema=_BLOCK)

    return blocks.drop("parts").mapInArrow(run, BLOCK)


def _moved(blocks: DataFrame, cents: Centroids) -> Centroids:
    """Each centroid at the floor of its vectors' mean; one without vectors stays."""
    part = blocks.select(F.explode("parts").alias("x")).select("x.*")
    sums = part.groupBy("cluster", "dim", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = [list(r) for r in cents.rows]
    totals: dict[tuple[int, int], int] = {}
    for r in sums.collect():  # a row for each component of each centroid, in limbs of 30 bits
        at = (r["cluster"], r["dim"])
        totals[at] = totals.get(at, 0) + (int(r["total"]) << (LIMB * r["limb"]))
    for c in range(len(rows)):
        if n := totals.get((c, -1), 0):
            rows[c] = [totals.get((c, d), 0) // n for d in range(len(rows[c]))]
    return Centroids(rows, cents.rows)


def _exact(row: dict, dims: int, scale: int, cents: Centroids) -> tuple[np.ndarray, np.ndarray]:
    search = _opened(row, dims, scale, cents)
    search.assign(cents)
    return search.near, search.distances(np.arange(len(search.near)), cents, search.near)


def _placed(blocks: DataFrame, cents: Centroids, dims: int, scale: int) -> DataFrame:
    """A row per vector; a distance beyond a long is the nearest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                near, distance = _exact(row, dims, scale, cents)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array(near, pa.int32()),
                        pa.array([min(d, MOST_LONG) for d in distance.tolist()], pa.int64()),
                    ],
                    names=["vec_id", "cluster", "distance"],
                )

    return blocks.drop("parts").mapInArrow(run, PLACED)


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster`` and ``distance`` (squared) for every kept vector, and the centroids.

    Vectors of another length, missing ones and those with a missing or non-finite
    component take no part. Components are floor(scale * x). The first centroids are the k
    vectors whose sha256 of ``seed:id`` is smallest, or all if there are fewer; rows with the
    same id follow one another by their components, those without an id come last. Every
    round assigns all vectors and moves the centroids; then vectors are assigned once more.
    Equal vectors go to one cluster, a row of its own each; other columns are not read. An
    empty table gives an empty one and no centroids.
    """
    kept = vectors.where(kept_vector(F.col(vector), dims)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    blocks, path = staged(_blocks(kept, dims, scale), "cluster-blocks")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "vector").limit(k).collect()
    rows = [[whole(x, scale) for x in r["vector"]] for r in first]
    if not rows:
        return vectors.sparkSession.createDataFrame([], PLACED), rows
    cents = Centroids(rows)
    for _ in range(rounds):
        done, done_path = staged(_round(blocks, cents, dims, scale), "cluster-round")
        blocks, path = dropped(done, path), done_path
        cents = _moved(blocks, cents)
    placed, _ = staged(_placed(blocks, cents, dims, scale), "clusters")
    return dropped(placed, path), cents.rows


def described(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``placed`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; a sum beyond a long is the nearest long."""
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    by_cluster = {r["cluster"]: int(r["total"]) for r in sums.collect()}  # a row per centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>"), F.col("cluster"))

    totals = [min(by_cluster.get(c, 0), MOST_LONG) for c in range(len(centroids))]
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster(totals, "bigint").alias("cluster_inertia"),
        F.lit(min(sum(by_cluster.values()), MOST_LONG)).cast("long").alias("inertia"),
        of_cluster(names, "string").alias("centroid_sha256"),
    )
