"""Session for local runs, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "snaplake", cores: str = "8", **options: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="snaplake-warehouse-"))
    )
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, for tables that cut lineage.

    The cluster names the parent in ``spark.checkpoint.dir``; a session without
    that setting uses its warehouse folder. On a cluster that must not be a folder of one machine.
    """
    parent = spark.conf.get(CHECKPOINT_DIR, None)
    if not parent:
        parent = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.conf.get("spark.master", "local").startswith("local")
        if not local and parent.startswith("file:"):
            raise ValueError(f"{CHECKPOINT_DIR} is not set, and {parent} may be a folder of one machine")
    return f"{parent.rstrip('/')}/snaplake/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    This cuts lineage in a way that outlives executors.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`shared_dir` has named, on whatever store it is."""
    if "/snaplake/" not in path:
        raise ValueError(f"not a staged folder: {path}")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
