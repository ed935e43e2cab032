"""Contiguous shards of near equal bytes, from global prefix sums of sizes.

Rows are put in order over partitions; each partition sums its own sizes and
counts its rows; the totals of the partitions, a row each, give every partition
its offset. A row is then placed by where in the whole its bytes begin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.frames import dropped, staged, whole_text, without

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``size`` (bytes of the text and one) and ``text_crc32``."""
    encoded = F.encode(whole_text(F.col(text)), "UTF-8")
    return docs.withColumn("size", (F.octet_length(encoded) + 1).cast("long")).withColumn(
        "text_crc32", F.crc32(encoded)
    )


def cut_shards(sized: DataFrame, order: Sequence[str], shards: int = 16) -> DataFrame:
    """``sized`` with ``shard`` and ``slot``: rows in the given order, NULL last, cut
    at equal shares of the bytes.

    A row goes to the shard in which the middle of its bytes lies, so a shard is off
    by one row's size at most. Rows equal in all of ``order`` may change places. More shards
    than rows, or one row larger than a share, leave shards empty; so does an
    empty table.
    """
    spark = sized.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in order]
    # Rows equal in all keys, if many, are cut apart by where they were read.
    read = sized.withColumn("_read", F.monotonically_increasing_id())
    ranged = read.repartitionByRange(parts, *keys, "_read").drop("_read")
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    ranged, path = staged(ranged, "shard-parts")

    totals = ranged.groupBy("_part").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(  # a row per partition
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
    )
    offsets, offsets_path = staged(offsets, "shard-offsets")
    total = totals.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("n")).first()["n"]

    local = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * F.col("_begin") + F.col("size")
    placed = (
        ranged.withColumn("_end", F.sum("size").over(local))
        .withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*keys)))
        .join(offsets, F.col("_part") == F.col("_of"))
        .withColumn("_begin", F.col("_bytes_before") + F.col("_end") - F.col("size"))
        .withColumn("_row", F.col("_rows_before") + F.col("_row"))
        .withColumn(
            "shard",
            F.least(F.expr(f"{shards} - 1"), F.floor(middle * shards / (2 * max(total, 1)))).cast("int"),
        )
        .drop("_end", "_begin", "_of", "_part", "_bytes_before", "_rows_before")
    )
    placed, placed_path = staged(placed, "shard-rows")
    firsts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_row").alias("_first"))
    result = (
        placed.join(F.broadcast(firsts), F.col("shard") == F.col("_shard"))  # `shards` rows at most
        .withColumn("slot", (F.col("_row") - F.col("_first")).cast("long"))
        .drop("_row", "_shard", "_first")
    )
    return dropped(result, path, offsets_path)


def shard_documents(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` and ``grown_shard``.

    In order of id, then checksum and size. A missing text has size 1; rows with
    a missing id come last; repeated rows are placed one by one. ``grown_shard``
    is NULL, since a cut by bytes moves rows anywhere when a shard is added.
    Columns of ``docs`` with a name above are replaced.
    """
    docs = without(docs, RESULT)
    names = [f"_{i}" for i in range(len(docs.columns))]  # apart from what the cut adds
    at = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    sized = with_sizes(docs.toDF(*names), at[text.lower()])
    placed = cut_shards(sized, [at[doc_id.lower()], "text_crc32", "size"], shards)
    return placed.select(
        *(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
