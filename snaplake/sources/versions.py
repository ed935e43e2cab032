"""Versions of several tables under one log: a commit is seen whole or not at all.

Data files are never changed. A commit writes new files first and then one log entry,
which names the files it adds and those it takes out, of all tables together; that
entry's appearance is the commit. Readers take the files of one version, so they see
either all that a batch has written to all tables or nothing of it. Late values rewrite
only the files that hold a row they change.

The log lists files by name with the snapshot they hold, so a reader opens those of the
snapshots it asks for. Every so often an entry repeats the whole list, so no reader goes
through all entries. Entries are put in place by a rename that fails if the name is
taken, which the store must do in one step (HDFS does, and local disks as in tests).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.operators.dedup import dedup_new
from snaplake.operators.keys import Seq, with_keys
from snaplake.schemas import SNAPSHOT
from snaplake.sources.tables import empty

#: An entry with a version divisible by this repeats the whole list of files.
WHOLE_EVERY = 20
_PART = "_part"
_MISSING = "__HIVE_DEFAULT_PARTITION__"

Files = dict[str, str | None]  # path below the root, and the snapshot the file holds


class Conflict(RuntimeError):
    """Another commit has changed a table that this one was computed from."""


@dataclass
class State:
    """The files of every table at a version, and the last batch of every stream."""

    version: int = -1
    tables: dict[str, Files] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def apply(self, entry: dict) -> None:
        if "tables" in entry:
            self.tables = {t: dict(files) for t, files in entry["tables"].items()}
            self.streams = dict(entry["streams"])
        else:
            for table, paths in entry["removed"].items():
                for path in paths:
                    self.tables[table].pop(path, None)
            for table, files in entry["added"].items():
                self.tables.setdefault(table, {}).update(files)
            if entry["stream"]:
                self.streams[entry["stream"]] = entry["batch"]
        self.version = entry["version"]


class Warehouse:
    """Tables below one root, with their common log."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    # --- the store

    def _path(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._fs().exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs().listStatus(path))

    def _read_text(self, *names: str) -> str:
        stream = self._fs().open(self._path(*names))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, text: str, folder: str, name: str) -> bool:
        """Make a file with all its text appear at once; False if there is one."""
        waiting = self._path(folder, f".{name}.{uuid.uuid4().hex}")
        out = self._fs().create(waiting, False)
        out.write(bytearray(text.encode()))
        out.close()
        renames = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(renames, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), self._conf)
        try:
            context.rename(waiting, self._path(folder, name), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self._fs().delete(waiting, False)
            return False
        return True

    # --- the log

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._names("_log") if n.endswith(".json") and n[0] != "."]

    def entry(self, version: int) -> dict:
        return json.loads(self._read_text("_log", f"{version:012d}.json"))

    def state(self, version: int | None = None) -> State:
        """All files at a version, by default the last one."""
        numbers = [v for v in self.versions() if version is None or v <= version]
        begin = max((i for i, v in enumerate(numbers) if v % WHOLE_EVERY == 0), default=0)
        state = State()
        for number in numbers[begin:]:
            state.apply(self.entry(number))
        return state

    # --- reading

    def read(
        self,
        table: str,
        schema: T.StructType,
        snapshots: Sequence[str | None] | None = None,
        state: State | None = None,
    ) -> DataFrame:
        """A table, or the snapshots named, at the last version or at that of ``state``."""
        files = (state or self.state()).tables.get(table, {})
        paths = [p for p, snapshot in files.items() if snapshots is None or snapshot in snapshots]
        return self._frame(paths, schema)

    def _frame(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{p}" for p in paths))

    def added(self, version: int, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
        """The rows that a version has added to each table; rewritten files are not new rows."""
        entry = self.entry(version)
        names = [t for t in schemas if entry["added"].get(t) and not entry["removed"].get(t)]
        return {t: self._frame(list(entry["added"][t]), schemas[t]) for t in names}

    def commit(self, stream: str | None = None, batch: int = 0) -> Commit:
        return Commit(self, stream, batch)

    def vacuum(self, keep: int) -> int:
        """Remove data files that none of the last ``keep`` versions has; returns their number."""
        live = {p for v in self.versions()[-keep:] for files in self.state(v).tables.values() for p in files}
        old = {p for v in self.versions() for files in self.entry(v)["added"].values() for p in files} - live
        return sum(self._fs().delete(self._path(p), False) for p in old)


class Commit:
    """Files written for one version, published together."""

    def __init__(self, house: Warehouse, stream: str | None, batch: int) -> None:
        self.house, self.stream, self.batch = house, stream, batch
        self.base = house.state()
        self.added: dict[str, Files] = {}
        self.removed: dict[str, list[str]] = {}
        self.reads: set[str] = set()

    @property
    def done(self) -> bool:
        """Whether a commit of this batch has been published before."""
        return self.stream is not None and self.base.streams.get(self.stream, -1) >= self.batch

    def read(self, table: str, schema: T.StructType, snapshots: Sequence[str | None] | None = None) -> DataFrame:
        """A table as this commit found it; a later change of it by others is a conflict."""
        self.reads.add(table)
        return self.house.read(table, schema, snapshots, self.base)

    def append(self, table: str, rows: DataFrame, snapshot: str | None = SNAPSHOT) -> None:
        """Write rows for ``table``, a file holding rows of one snapshot only."""
        folder = f"{table}/{uuid.uuid4().hex}"
        target = f"{self.house.root}/{folder}"
        if snapshot is None:
            rows.hint("rebalance").write.parquet(target)
        else:
            parted = rows.withColumn(_PART, F.col(snapshot).cast("string"))
            parted.hint("rebalance", _PART).write.partitionBy(_PART).parquet(target)
        self.added.setdefault(table, {}).update(self._written(folder))

    def _written(self, folder: str) -> Files:
        unescape = self.house._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        listed = self.house._fs().listFiles(self.house._path(folder), True)
        found: Files = {}
        while listed.hasNext():
            path = listed.next().getPath()
            if path.getName()[0] in "._":
                continue
            parent = path.getParent().getName()
            if parent.startswith(f"{_PART}="):
                value = unescape(parent.removeprefix(f"{_PART}="))
                found[f"{folder}/{parent}/{path.getName()}"] = None if value == _MISSING else value
            else:
                found[f"{folder}/{path.getName()}"] = None
        return found

    def append_new(
        self, table: str, rows: DataFrame, keys: Sequence[str], seq: Seq, snapshot: str = SNAPSHOT
    ) -> None:
        """The first row of each key that its snapshot does not hold yet."""
        rows = with_keys(rows, [snapshot])
        labels = [r[0] for r in rows.select(snapshot).distinct().collect()]  # one per snapshot
        stored = self.read(table, rows.schema, labels)
        self.append(table, dedup_new(rows, stored, [snapshot, *keys], seq), snapshot)

    def replace(self, table: str, paths: Sequence[str], rows: DataFrame, snapshot: str | None = SNAPSHOT) -> None:
        """Put files with ``rows`` in the place of ``paths``."""
        self.reads.add(table)
        self.append(table, rows, snapshot)
        self.removed.setdefault(table, []).extend(paths)

    def publish(self) -> int:
        """Make all that was written visible; returns the version, the present one if there is nothing to do."""
        if self.done or not (self.added or self.removed or self.stream):
            return self.base.version
        version = self.base.version + 1
        while True:
            entry = {
                "version": version,
                "stream": self.stream,
                "batch": self.batch,
                "added": self.added,
                "removed": self.removed,
            }
            if version % WHOLE_EVERY == 0:
                state = self.house.state(version - 1)
                state.apply(entry)
                entry |= {"tables": state.tables, "streams": state.streams}
            if self.house._put(json.dumps(entry), "_log", f"{version:012d}.json"):
                return version
            other = self.house.entry(version)
            if self.stream is not None and other["stream"] == self.stream:
                raise Conflict(f"batch {self.batch} of {self.stream}: version {version} is batch {other['batch']}")
            clash = self.reads & (other["added"].keys() | other["removed"].keys())
            if clash:
                raise Conflict(f"version {version} has changed {', '.join(sorted(clash))}")
            version += 1


def backfill_files(
    house: Warehouse,
    table: str,
    schema: T.StructType,
    enrich: Callable[[DataFrame], DataFrame],
    column: str,
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    snapshot: str | None = SNAPSHOT,
    snapshots: Sequence[str | None] | None = None,
) -> int:
    """Rewrite the files that hold a row whose ``column`` changes by ``enrich``; returns their number.

    ``candidates`` keeps the stored rows that may change, by a join with what has come
    late, say; only those are enriched to find the files, and only the files found are
    read again, enriched and replaced. All other files stay as they are.
    """
    commit = house.commit()
    files = {p: s for p, s in commit.base.tables.get(table, {}).items() if snapshots is None or s in snapshots}
    if not files:
        return 0
    commit.reads.add(table)
    stored = house._frame(list(files), schema).withColumns(
        {"_file": F.col("_metadata.file_path"), "_before": F.col(column)}
    )
    changed = enrich(candidates(stored) if candidates else stored)
    touched = changed.where(~F.col(column).eqNullSafe(F.col("_before"))).select("_file").distinct()
    # File names only, of which the log holds all.
    tails = {row["_file"].rsplit("/", 1)[-1] for row in touched.collect()}
    paths = [p for p in files if p.rsplit("/", 1)[-1] in tails]
    if not paths:
        return 0
    rows = enrich(house._frame(paths, schema)).select(*schema.fieldNames())
    commit.replace(table, paths, rows, snapshot)
    commit.publish()
    return len(paths)


class Ledger:
    """How far each sink outside the log has come, so that one that failed is caught up alone."""

    def __init__(self, house: Warehouse) -> None:
        self.house = house

    def applied(self, sink: str) -> int:
        """The last version that ``sink`` has, -1 for none."""
        return max((int(n) for n in self.house._names(f"_sinks/{sink}") if n[0] != "."), default=-1)

    def catch_up(
        self,
        sink: str,
        write: Callable[[int, dict[str, DataFrame]], None],
        schemas: Mapping[str, T.StructType],
    ) -> list[int]:
        """Give ``sink`` the rows of each version that it lacks, in order; returns these versions.

        A version counts as applied once ``write`` has returned. One whose write fails, or
        whose mark is lost, is given again: ``write`` replaces what it may have left of it.
        """
        done = []
        for version in [v for v in self.house.versions() if v > self.applied(sink)]:
            write(version, self.house.added(version, schemas))
            self.house._put("", f"_sinks/{sink}", f"{version:012d}")
            done.append(version)
        return done

    def catch_up_all(
        self,
        sinks: Mapping[str, Callable[[int, dict[str, DataFrame]], None]],
        schemas: Mapping[str, T.StructType],
    ) -> dict[str, list[int]]:
        """Catch up every sink; one that fails does not keep the others from it."""
        errors, done = [], {}
        for sink, write in sinks.items():
            try:
                done[sink] = self.catch_up(sink, write, schemas)
            except Exception as error:
                errors.append(error)
        if errors:
            raise errors[0]
        return done


def append_stream(
    house: Warehouse, name: str, batch_id: int, batches: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], seq: Seq
) -> int:
    """One batch of a stream into several tables as one version; a batch that is replayed adds nothing.

    For ``foreachBatch``: the batch number goes into the log with the files.
    """
    commit = house.commit(name, batch_id)
    if not commit.done:
        for table, rows in batches.items():
            commit.append_new(table, rows, keys[table], seq)
    return commit.publish()
