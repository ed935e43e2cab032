"""Warehouse tables: Parquet directories, partitioned by snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.functions.dates import label
from snaplake.operators.dedup import dedup_new
from snaplake.operators.keys import Seq, with_keys
from snaplake.schemas import LOAD_TIME, SCHEMAS, SEQ, SNAPSHOT
from snaplake.session import drop_dir, shared_dir


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, names anything."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(store.globStatus(where))


def load_first(
    spark: SparkSession,
    sources: Sequence[str | tuple[str, str]],
    schema: T.StructType,
    **options: object,
) -> DataFrame:
    """The first source that exists; a typed empty frame when none does.

    A source is a path to Parquet, or a path and its format. Only absence moves
    on to the next source. Any other failure is raised.
    """
    for source in sources:
        path, fmt = (source, "parquet") if isinstance(source, str) else source
        if not _exists(spark, path):
            continue
        try:
            return spark.read.schema(schema).format(fmt).options(**options).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return empty(spark, schema)


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def load_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A warehouse table, empty when it has not been written yet."""
    return load_first(spark, [table_path(root, table)], SCHEMAS[table])


def snapshot_scan(
    spark: SparkSession,
    table: str,
    start: str | date,
    end: str | date,
    columns: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Columns of one snapshot: a partition filter and a pruned read."""
    reader = spark.read.schema(schema) if schema else spark.read
    return (
        reader.parquet(table).where(F.col(SNAPSHOT) == F.lit(label(start, end))).select(*columns)
    )


def create_tables(spark: SparkSession, root: str) -> None:
    """Declare the warehouse tables in the session's catalog."""
    for table, schema in SCHEMAS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partition = f"PARTITIONED BY (`{SNAPSHOT}`)" if SNAPSHOT in schema.fieldNames() else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
            f"USING parquet {partition} LOCATION '{table_path(root, table)}'"
        )


def add_partition(spark: SparkSession, table: str, path: str, value: str) -> None:
    """Tell the catalog of a partition written by path, if ``table`` is declared there."""
    if not spark.catalog.tableExists(table):
        return
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    if about is None or about["data_type"].rstrip("/").removeprefix("file:") != path.rstrip("/").removeprefix("file:"):
        return
    if SNAPSHOT in SCHEMAS[table].fieldNames():
        quoted = value.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({SNAPSHOT} = '{quoted}')")
    spark.catalog.refreshTable(table)


def stamp(df: DataFrame) -> DataFrame:
    """Load time for rows that have none yet."""
    return df.withColumn(LOAD_TIME, F.coalesce(LOAD_TIME, F.current_timestamp()))


def _writer(df: DataFrame, partition: str | None, fmt: str = "parquet"):
    """Files sized by data volume: a large partition is split over tasks, small
    ones share a task, whatever the key distribution."""
    if partition is None:
        return df.hint("rebalance").write.format(fmt)
    return df.hint("rebalance", partition).write.format(fmt).partitionBy(partition)


def partition_path(spark: SparkSession, path: str, partition: str, value: str) -> str:
    """The folder of one partition, its value written as Spark writes it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path.rstrip('/')}/{partition}={escape(value)}"


def overwrite_snapshot(
    df: DataFrame,
    path: str,
    partition: str = SNAPSHOT,
    fmt: str = "parquet",
    value: str | None = None,
    **options: object,
) -> None:
    """Replace the partitions that occur in ``df``; all others stay.

    ``value`` names the one partition that ``df`` stands for: without rows it is
    left empty, with a file that has the columns.
    """
    if value is not None and df.isEmpty():
        only = partition_path(df.sparkSession, path, partition, value)
        overwrite_table(df.drop(partition), only, fmt, **options)
        return
    (
        _writer(df, partition, fmt)
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .save(path)
    )


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", **options: object) -> None:
    """Replace a whole unpartitioned table."""
    _writer(df, None, fmt).options(**options).mode("overwrite").save(path)


def append_rows(df: DataFrame, path: str, partition: str | None = SNAPSHOT) -> None:
    _writer(df, partition).mode("append").save(path)


def replace_snapshots(df: DataFrame, path: str, partition: str = SNAPSHOT) -> None:
    """Like :func:`overwrite_snapshot` where ``df`` is computed from ``path``."""
    copy = shared_dir(df.sparkSession, "replace")
    df.write.parquet(copy)
    overwrite_snapshot(df.sparkSession.read.schema(df.schema).parquet(copy), path, partition)
    drop_dir(df.sparkSession, copy)


def append_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    seq: Seq,
    partition: str = SNAPSHOT,
) -> None:
    """Append the first row of each key that its partition does not hold yet.

    Rows without a partition go to ``N/A``. The stored side is read for the
    partitions of ``df`` only. Running it again with the same rows adds nothing.
    """
    df = with_keys(df, [partition])
    labels = [row[0] for row in df.select(partition).distinct().collect()]  # one per snapshot
    if not labels:
        return
    stored = load_first(df.sparkSession, [path], df.schema).where(F.col(partition).isin(labels))
    append_rows(dedup_new(df, stored, [partition, *keys], seq), path, partition)


def saved_cursor(stored: DataFrame, seq: str = SEQ) -> int:
    """Highest ingest number stored so far, -1 for an empty table."""
    row = stored.agg(F.max(seq).alias("cursor")).first()
    return -1 if row is None or row["cursor"] is None else row["cursor"]


def has_data(*frames: DataFrame) -> bool:
    """True when any frame has a row; stops at the first one that has."""
    return any(not df.isEmpty() for df in frames)


def route_tables(df: DataFrame, tag: str, root: str) -> None:
    """Write each tagged share of a mixed frame to its own table, in one pass."""
    _writer(df, tag).option("partitionOverwriteMode", "dynamic").mode("overwrite").save(root)


def routed_table(
    spark: SparkSession, root: str, tag: str, table: str, schema: T.StructType
) -> DataFrame:
    """One routed table with its declared columns; empty if no row was routed to it."""
    return load_first(spark, [f"{root.rstrip('/')}/{tag}={table}"], schema)


def upsert_dim(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    seq: str = SEQ,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Add the keys a dimension lacks, each with its first row; ``watch`` sees these rows.

    Stored rows stay as they are, so only new keys are written.
    """
    stored = load_first(new.sparkSession, [path], new.schema)
    append_rows(watch(dedup_new(new, stored, keys, seq)), path, None)


def dual_sink(df: DataFrame, *sinks: Callable[[DataFrame], None]) -> None:
    """Give the same rows to several sinks, computing them once.

    The rows are written to the shared folder until all sinks have them, so a lost
    executor does not make them be computed again. A failing sink does not keep
    the others from being written; the first error is raised when all have been tried.
    """
    errors: list[Exception] = []
    path = shared_dir(df.sparkSession, "sinks")
    df.write.parquet(path)
    for write in sinks:
        try:
            write(df.sparkSession.read.schema(df.schema).parquet(path))
        except Exception as error:
            errors.append(error)
    drop_dir(df.sparkSession, path)
    if errors:
        raise errors[0]
