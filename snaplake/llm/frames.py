"""Column expressions and staged tables that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.session import drop_dir, shared_dir

#: The six ASCII space signs that separate words and are stripped from lines.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(text: Column) -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts of ASCII alone take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def digest128(*columns: Column, salt: str) -> list[Column]:
    """Two independent 64-bit hashes of the columns, for keys that stand for texts."""
    return [F.xxhash64(F.lit(f"{salt}{i}"), *columns) for i in (1, 2)]


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add; its own win over a clash."""
    return df.drop(*names)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` after as many underscores as keep them apart from the columns of ``df``."""
    taken, front = {c.lower() for c in df.columns}, "_"
    while any(f"{front}{n}".lower() in taken for n in names):
        front += "_"
    return [f"{front}{n}" for n in names]


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and go on from there: lineage ends in files
    that outlive executors. Returns the written table and its folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(df: DataFrame, *paths: str) -> DataFrame:
    """``df`` after folders that it does not read any more are removed."""
    for path in paths:
        drop_dir(df.sparkSession, path)
    return df


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """Bound the rows that go to Python at once, since texts may be very long."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= rows:
        conf.set(setting, str(rows))
    return df
