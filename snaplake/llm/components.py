"""Connected components of a graph of any size, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged


def _large_star(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """Every larger neighbour of a node is tied to the least of its neighbourhood."""
    both, both_path = staged(
        edges.select("u", "v").union(edges.select("v", "u")).toDF("u", "v").where("u <> v"), "cc-both"
    )
    least, least_path = staged(
        both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least"
    )
    found = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.where("u <> v").distinct(), [both_path, least_path]


def _small_star(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """Every smaller neighbour of a node, and the node, is tied to the least of them."""
    down, down_path = staged(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "cc-down"
    )
    least, least_path = staged(down.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct(), [down_path, least_path]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the least node it reaches) for every node of an edge.

    ``edges`` has ``u`` and ``v``. Nodes linked to none but themselves are left
    out. The pairs of a hub are never gathered: joins on it can be split.
    """
    current, path = staged(edges.where("u <> v").select("u", "v"), "cc-edges")
    before = None
    for _ in range(most_rounds):
        stars, used = _large_star(current)
        stars, stars_path = staged(stars, "cc-stars")
        dropped(stars, path, *used)
        stars, used = _small_star(stars)
        current, path = staged(stars, "cc-edges")
        dropped(current, stars_path, *used)
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")
        ).first()
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
