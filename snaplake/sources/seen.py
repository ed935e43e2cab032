"""Bloom filters of stored keys by snapshot: rows that are surely new skip the exact resume.

A filter is a table of blocks of 32,768 bits, a folder per snapshot. A key sets a few bits
of one block, so a block is all that a key is asked of. Filters of several snapshots, and of
several additions to one, are merged by OR of equal blocks. Of a key that was added all bits
are set: a row with a missing bit is new, and only the others are asked for in the stored
table. A filter that has become too full sends more rows there and loses none.

Add the keys to the filter before the rows are stored: a key too many costs a question,
a key too few would let a stored row in again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.functions.values import na_default
from snaplake.schemas import SNAPSHOT

BITS = 32_768  # of a block, as many as Spark's bitmaps hold
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT = (T.StringType, T.DateType, T.BooleanType)


class SeenKeys:
    """Keys seen so far, below ``root``, by the columns of ``keys``.

    ``blocks`` and ``probes`` hold for the life of a filter: at 10 bits a key (3,000 keys a
    block) and 7 probes about one new key in a hundred is asked for. Missing text keys count
    as ``N/A``. Keys are whole numbers, texts, dates or booleans; for others equal values need
    not have equal digests. A merged filter goes along to every task if it has
    ``broadcast_bytes`` at most, which its blocks tell; a larger one is joined by block.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: T.StructType,
        blocks: int = 64,
        probes: int = 7,
        broadcast_bytes: int = 64 << 20,
    ) -> None:
        for field in keys:
            if not isinstance(field.dataType, _WHOLE + _EXACT):
                raise TypeError(f"{field.name}: no filter for keys of {field.dataType.simpleString()}")
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys
        self.blocks, self.probes, self.broadcast_bytes = blocks, probes, broadcast_bytes

    def _key(self, rows: DataFrame) -> list[Column]:
        """The key columns of ``rows`` under one type for equal values."""
        key = []
        for field in self.keys:
            kind = rows.schema[field.name].dataType
            if isinstance(field.dataType, _WHOLE) and isinstance(kind, _WHOLE):
                key.append(F.col(field.name).cast("long"))
            elif not isinstance(kind, type(field.dataType)):
                raise TypeError(f"{field.name}: {kind.simpleString()} asked of {field.dataType.simpleString()}")
            else:
                key.append(na_default(F.col(field.name)) if isinstance(kind, T.StringType) else F.col(field.name))
        return key

    def _digests(self, rows: DataFrame) -> tuple[Column, Column]:
        """The block of a key, and a number that its bits are drawn from."""
        key = self._key(rows)
        block = F.pmod(F.xxhash64(F.lit("block"), *key), F.lit(self.blocks)).cast("int")
        return block, F.xxhash64(F.lit("bits"), *key)

    def _bits(self, draw: Column) -> list[Column]:
        """Steps of one odd width from one start, so no bit is drawn twice."""
        start = draw.bitwiseAND(BITS - 1)
        width = F.shiftright(draw, 15).bitwiseAND(BITS - 1).bitwiseOR(1)
        return [(start + i * width).bitwiseAND(BITS - 1) for i in range(self.probes)]

    def add(self, rows: DataFrame, snapshot: str) -> None:
        """Add the keys of ``rows`` to the filter of ``snapshot``; keys it has change nothing.

        Digests are combined before they are dealt out by block, so a hot key is one digest.
        """
        block, draw = self._digests(rows)
        drawn = rows.select(block.alias("block"), draw.alias("draw")).distinct().repartition("block")
        bits = drawn.select("block", F.explode(F.array(*self._bits(F.col("draw")))).alias("bit"))
        made = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        made.withColumn(SNAPSHOT, F.lit(snapshot)).write.mode("append").partitionBy(SNAPSHOT).parquet(self.root)

    def _stored(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        if not path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return None
        return self.spark.read.schema(f"block int, bits binary, {SNAPSHOT} string").parquet(self.root)

    def merged(self, snapshots: Iterable[str] | None = None) -> DataFrame | None:
        """One filter of all ``snapshots`` (by default of all there are), a row per block with
        its bits as 512 longs. None where one of them has no filter, so nothing is known of it."""
        stored = self._stored()
        if stored is None:
            return None
        if snapshots is not None:
            asked = set(snapshots)
            stored = stored.where(F.col(SNAPSHOT).isin(*asked))
            if stored.select(SNAPSHOT).distinct().count() < len(asked):
                return None
        both = stored.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        longs = F.transform(
            F.sequence(F.lit(0), F.lit(BITS // 64 - 1)),
            lambda i: F.conv(F.hex(F.substring("bits", i * 8 + 1, F.lit(8))), 16, -10).cast("long"),
        )
        return both.select("block", longs.alias("longs"))

    def mark(self, rows: DataFrame, name: str, snapshots: Iterable[str] | None = None) -> DataFrame:
        """Add ``name``: whether the key of a row may have been seen. False is certain."""
        merged = self.merged(snapshots)
        if merged is None:
            return rows.withColumn(name, F.lit(True))
        block, draw = self._digests(rows)
        # A block has 4 KB whatever the number of keys.
        if self.blocks * BITS // 8 <= self.broadcast_bytes:
            merged = F.broadcast(merged)
        filled = merged.select(F.col("block").alias("_seen_block"), F.col("longs").alias("_seen_longs"))
        has = F.lit(True)
        for bit in self._bits(draw):
            # A long holds eight bytes of the bitmap, the first one highest.
            at = F.get("_seen_longs", F.shiftright(bit, 6).cast("int"))
            has &= F.getbit(at, bit.bitwiseAND(63).bitwiseXOR(56).cast("int")) == 1
        joined = rows.join(filled, block == F.col("_seen_block"), "left")
        return joined.select(*rows.columns, (F.col("_seen_block").isNotNull() & has).alias(name))

    def unseen(
        self,
        rows: DataFrame,
        exact: Callable[[DataFrame], DataFrame],
        snapshots: Iterable[str] | None = None,
    ) -> DataFrame:
        """Rows whose key is not stored; rows that repeat stay.

        ``exact`` finds these among rows that may have been seen: a plain resume, or a
        :class:`~snaplake.sources.key_index.KeyIndex`. The others pass without being
        shuffled. ``rows`` is read once for each of the two, so it is best a written table.
        """
        marked = self.mark(rows, "_seen", snapshots)
        known = exact(marked.where(F.col("_seen")).drop("_seen"))
        return marked.where(~F.col("_seen")).drop("_seen").unionByName(known)
