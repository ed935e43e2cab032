"""File streams into snapshot tables.

A stream remembers which landed files it has taken; a batch is counted as done
only after its write has succeeded. A batch that is replayed after a failure
finds its rows stored and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from snaplake.operators.keys import Seq
from snaplake.schemas import SNAPSHOT
from snaplake.sources.tables import append_new


def read_landing(
    spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def drain(stream: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything landed so far, then stop."""
    query = (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: Seq,
    partition: str = SNAPSHOT,
) -> None:
    """Append the new rows of a landing folder to a table, each key once."""

    def save(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, path, keys, seq, partition)

    drain(stream, save, checkpoint)
