"""Drop lines that many documents share, by levelled sorted runs of line hashes.

Documents come in batches. A run holds line hashes in order, with the number of
documents that have the line. Level 0 takes a run per batch; two runs of a level are
merged into one of the next. Lines that have reached the limit leave the levels for
runs of settled lines, which are merged by levels as well, and a new batch is merge
anti-joined with these first, so a line that is settled is not counted again. What
higher levels still hold of a settled line goes when they are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm.frames import SPACES, ascii_lower, digest128, staged, whole_text
from snaplake.session import drop_dir, shared_dir

KEY = ["h1", "h2"]
#: Text of a batch; there are four batches at least, and a hundred at most, which are larger then.
BATCH_BYTES = 256 << 20


def line_key(line: Column) -> Column:
    """The line as it is compared: stripped of ASCII space, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """While this holds, Spark relies on the order of rows in the one file of a bucket."""
    setting = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


class LineRuns:
    """Sorted runs by level: of (h1, h2, docs) for open lines, of (h1, h2) for settled ones.

    A run is a table of sorted buckets, a file each. All runs have the same buckets, so a
    batch is dealt out once, by its counts, and meets run after run where that lies; merging
    two runs is a join of equal buckets. Neither exchanges a run or sorts it again to read it.
    """

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}
        self.levels: list[list[str]] = []
        self.settled: list[list[str]] = []

    def _write(self, rows: DataFrame, name: str) -> str:
        """Write rows that lie by bucket already; returns the table."""
        path = shared_dir(self.spark, name)
        table = path.rsplit("/", 1)[-1].replace("-", "_")
        with _in_order(self.spark):
            (
                rows.sortWithinPartitions(*KEY)
                .write.bucketBy(self.buckets, *KEY)
                .sortBy(*KEY)
                .option("path", path)
                .saveAsTable(table)
            )
        self.paths[table] = path
        return table

    def _push(self, levels: list[list[str]], level: int, table: str, name: str) -> None:
        """Put a run on its level, and merge a full level into one run of the next."""
        while len(levels) <= level:
            levels.append([])
        levels[level].append(table)
        if len(levels[level]) >= self.fanout:
            (merged, *others), levels[level] = levels[level], []
            for other in others:
                merged = self._merge(merged, other, name)
            self._push(levels, level + 1, merged, name)

    def _other(self, table: str) -> DataFrame:
        run = self.spark.table(table)
        return run.toDF(*(f"of_{c}" for c in run.columns))

    def _same(self) -> Column:
        return (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))

    def _merge(self, first: str, second: str, name: str) -> str:
        """One run of two; lines that reach the limit by it make a settled run as well."""
        both = self.spark.table(first).join(self._other(second), self._same(), "full_outer")
        keys = [F.coalesce(c, f"of_{c}").alias(c) for c in KEY]
        if name == "line-settled":
            merged = self._write(both.select(*keys), name)
        else:
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("of_docs", F.lit(0))
            merged = self._write(self._open(both.select(*keys, docs.alias("docs"))), name)
            reached = self.spark.table(merged).where(F.col("docs") >= self.min_docs).select(*KEY)
            self._push(self.settled, 0, self._write(reached, "line-settled"), "line-settled")
        self._remove(first, second)
        return merged

    def _open(self, lines: DataFrame) -> DataFrame:
        """``lines`` without those that are settled, by a merge with each settled run."""
        for table in (t for level in self.settled for t in level):
            lines = lines.join(self._other(table), self._same(), "left_anti")
        return lines

    def absorb(self, lines: DataFrame) -> None:
        """Count a batch of (h1, h2) rows, one for each document and line."""
        counts = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs")).repartition(self.buckets, *KEY)
        # The number keeps the optimizer from moving a join below the counts.
        counts = counts.withColumn("number", F.monotonically_increasing_id())
        self._push(self.levels, 0, self._write(self._open(counts).drop("number"), "line-run"), "line-run")

    def frequent(self) -> DataFrame:
        """All lines found in ``min_docs`` documents or more, once each."""
        waiting = [t for level in self.levels for t in level]
        while len(waiting) > 1:  # the smallest first
            waiting = [self._merge(waiting[0], waiting[1], "line-run"), *waiting[2:]]
        self.levels = [waiting]
        found = [self.spark.table(t) for level in self.settled for t in level]
        found += [self._open(self.spark.table(t)).where(F.col("docs") >= self.min_docs) for t in waiting]
        if not found:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        return reduce(DataFrame.unionByName, (run.select(*KEY) for run in found))

    def _remove(self, *tables: str) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            drop_dir(self.spark, self.paths.pop(table))

    def drop(self) -> None:
        self._remove(*list(self.paths))
        self.levels, self.settled = [], []


def batches_for(size: int) -> int:
    """Batches for ``size`` bytes of text."""
    return min(max(4, -(-size // BATCH_BYTES)), 100)


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_text``, a row per document.

    A line goes from every document if its key has ``min_chars`` signs at least and
    ``min_docs`` documents have it; a line repeated within a document counts once.
    A missing or empty text is one empty line. Each row is a document, also if
    rows repeat or their id is missing. Other columns of ``docs`` are not read.
    An empty table gives an empty one. Without ``batches`` their number follows the size of the texts.
    """
    spark = docs.sparkSession
    whole = whole_text(F.col(text))
    if batches is None:
        size = docs.select(F.sum(F.octet_length(whole)).alias("size")).first()["size"] or 0
        batches = batches_for(size)
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.split(whole, "\n", -1).alias("lines"),
    ).select("doc_id", "row", F.posexplode("lines").alias("pos", "line"))
    key = line_key(F.col("line"))
    keyed = keyed.withColumn("key", key).select(
        "doc_id",
        "row",
        "pos",
        "line",
        (F.char_length("key") >= min_chars).alias("counts"),
        *(h.alias(n) for h, n in zip(digest128(F.col("key"), salt="line"), KEY, strict=True)),
        F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int").alias("batch"),
    )
    path = shared_dir(spark, "lines")
    keyed.write.partitionBy("batch").parquet(path)  # row numbers are fixed from here on
    keyed = spark.read.schema(keyed.schema).parquet(path)

    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        of_batch = keyed.where((F.col("batch") == batch) & F.col("counts"))
        runs.absorb(of_batch.select("row", *KEY).distinct().select(*KEY))
    frequent, _ = staged(runs.frequent().withColumn("gone", F.lit(True)), "line-frequent")
    runs.drop()

    hit = keyed.join(frequent, KEY, "left").select(
        "doc_id", "row", "pos", "line", (F.col("gone").isNotNull() & F.col("counts")).alias("gone")
    )
    lines = F.sort_array(F.collect_list(F.struct("pos", "gone", "line")))
    grouped = hit.groupBy("row").agg(F.first("doc_id").alias("doc_id"), lines.alias("lines"))
    kept = F.filter("lines", lambda x: ~x["gone"])
    return grouped.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(kept)).cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("kept_text"),
    )

