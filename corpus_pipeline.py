"""A training corpus from raw documents, in stages that are written one by one.

Each stage reads the table that the one before has written, and returns the columns
of ``documents`` for what it keeps; a document that the mix repeats is a row for
each time. The last stage returns where every document of the corpus goes: its id,
size and checksum, shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.llm import decontamination, mixing, quality, sharding, simhash
from snaplake.llm.frames import dropped, staged


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below 0.3 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels, folds=5, held=0), 0.3)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of documents linked at 3 bits or fewer, the smallest id stays."""
    return simhash.one_of_each(docs, shingle=3, most_bits=3)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a window of an item go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents come as often as their source needs them."""
    return mixing.mixed_rows(docs, weights=(1, 2, 3), cap=3)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: contiguous shards of near equal bytes."""
    lean = sharding.with_sizes(docs.select("doc_id", "text")).drop("text")
    placed = sharding.cut_shards(lean, ["doc_id", "text_crc32", "size"], shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


STAGES = [
    ("quality", keep_good),
    ("near-duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL cannot state the classifier; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; tables between stages are removed once read.

    Missing and empty texts are scored, fingerprinted, searched and mixed as empty ones, and
    long texts whole. Rows that repeat are near-duplicates of each other, of which one stays;
    a missing id is later than all others. Extra columns are carried up to the last stage,
    also under names that a stage uses itself. Empty tables give an empty result.
    """
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        kept, kept_path = staged(stage(spark, docs, sf_dir), f"stage-{name}")
        docs, path = (kept if path is None else dropped(kept, path)), kept_path
    return STAGES[-1][1](spark, docs, sf_dir)
