"""Stored keys in sorted buckets, so that a resume need not shuffle or sort what is stored.

A run is a bucketed table of distinct keys, one sorted file a bucket. Keys that are added
make a run of their own; two runs of one level are merged into one of the next, so there
are as many runs as the number of additions has binary digits. All runs have the same
buckets: new keys are dealt out once, in that way, and meet run after run where it lies.
Merging two runs is a full outer join of equal buckets, without an exchange either.

With ``spark.sql.legacy.bucketedTableScan.outputOrdering`` Spark also relies on the order
inside a bucket and leaves out the sort of the stored side.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.fixed import NA
from snaplake.operators.keys import names

DIGEST = "_digest"


class KeyIndex:
    """Keys seen so far, below ``root``, by the columns ``on``. Keys are kept as text, missing ones as ``N/A``.

    ``buckets`` holds for the life of an index: choose it for the size the keys will have,
    about 128 MB of them a bucket.
    """

    def __init__(self, spark: SparkSession, root: str, on: str | Sequence[str], buckets: int = 8) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), names(on), buckets
        self.by = [DIGEST, *self.keys]
        self.of = [f"_of_{c}" for c in self.by]

    def _text(self, name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(NA))

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def runs(self) -> list[tuple[int, str]]:
        """Level and folder of every run that has been written whole, largest first."""
        if not self._fs().exists(self._path()):
            return []
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path())]
        whole = [n for n in names if n.startswith("run-") and self._fs().exists(self._path(n, "_SUCCESS"))]
        return sorted(((int(n.split("-")[1]), n) for n in whole), reverse=True)

    def run(self, folder: str) -> DataFrame:
        """The keys of a run, with its buckets declared to this session."""
        name = f"key_{folder.replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{c}` string" for c in self.keys)
            by = ", ".join(f"`{c}`" for c in self.by)
            self.spark.sql(
                f"CREATE TABLE {name} (`{DIGEST}` bigint, {columns}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{folder}'"
            )
        return self.spark.table(name)

    def _write(self, keys: DataFrame, level: int) -> str:
        """Write keys that lie by bucket already."""
        folder = f"run-{level:03d}-{uuid.uuid4().hex}"
        (
            keys.sortWithinPartitions(*self.by)
            .write.bucketBy(self.buckets, *self.by)
            .sortBy(*self.by)
            .option("path", f"{self.root}/{folder}")
            .saveAsTable(f"key_{folder.replace('-', '_')}")
        )
        return folder

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` by bucket. They are combined before they are dealt
        out, so it does not matter how many rows a key has."""
        keys = rows.select(*(self._text(c).alias(c) for c in self.keys)).distinct()
        dealt = keys.select(F.xxhash64(*self.keys).alias(DIGEST), *self.keys).repartition(self.buckets, *self.by)
        # The number keeps the optimizer from moving a join below this, to rows that are not combined.
        return dealt.withColumn("_number", F.monotonically_increasing_id())

    def _known(self, folder: str) -> DataFrame:
        return self.run(folder).toDF(*self.of)

    def _same(self) -> list[Column]:
        return [F.col(c) == F.col(o) for c, o in zip(self.by, self.of, strict=True)]

    def _unseen_keys(self, rows: DataFrame) -> DataFrame:
        keys = self._dealt(rows)
        for _, folder in self.runs():
            keys = keys.join(self._known(folder), self._same(), "left_anti")
        return keys.select(*self.by)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not in the index; rows that repeat stay. Of the rows only those
        keys are asked for, so that a hot key is one question."""
        fresh = self._unseen_keys(rows).toDF(*self.of)
        same = [F.xxhash64(*(self._text(c) for c in self.keys)) == F.col(self.of[0])]
        same += [self._text(c) == F.col(o) for c, o in zip(self.keys, self.of[1:], strict=True)]
        return rows.join(fresh, same, "left_semi")

    def add(self, rows: DataFrame) -> None:
        """Add the keys of ``rows``; keys the index has are not stored twice."""
        self._write(self._unseen_keys(rows), 0)
        self._merge()

    def _merge(self) -> None:
        """Merge runs of one level by twos until every level has one."""
        while True:
            runs = self.runs()
            pair = next(((a, b) for a, b in zip(runs, runs[1:], strict=False) if a[0] == b[0]), None)
            if pair is None:
                return
            (level, first), (_, second) = pair
            both = self.run(first).join(self._known(second), self._same(), "full_outer")
            merged = both.select(*(F.coalesce(c, o).alias(c) for c, o in zip(self.by, self.of, strict=True)))
            self._write(merged, level + 1)
            for folder in (first, second):
                self.spark.sql(f"DROP TABLE IF EXISTS key_{folder.replace('-', '_')}")
                self._fs().delete(self._path(folder), True)
