"""A keyed lake table kept as a log of change batches.

    <root>/_table.json                          key, order and schema
    <root>/log/writer=<w>/batch_id=<n>/         one folder per batch
    <root>/log/_commits/<w>.<n>@<bytes>         empty file per batch: written last, commits it
    <root>/base/version=<v>/                    compacted state, tombstones included, bucketed by key
    <root>/base/_version=<v>.json               batches that state covers: written last, commits it

A batch counts once its commit file is there, so readers never see half a batch; one listing finds all batches, their sizes
and, by the files' times, when they were committed. Writing a batch again withdraws the commit, and any base that holds the old
batch, and replaces the folder. Every stream writes under a name of its own, hence two jobs that ingest the same feed cannot
overwrite each other's batches; the state is the newest change per key, whichever batch it came in and however often.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import align
from ..sources import files
from ..specs import DELETE, TableSpec
from .state import dedup, latest_state, merge

#: A bucket of the base holds about this much, more once a table needs more buckets than Spark allows.
BUCKET_BYTES = 64 * 1024 * 1024
MAX_BUCKETS = 100_000

_COMMIT = re.compile(r"/([^/]+)\.(\d+)@(\d+)$")
_VERSION = re.compile(r"_version=(\d+)\.json$")


@dataclass(frozen=True)
class Batch:
    writer: str
    batch_id: int
    path: str
    size: int
    committed: int  # milliseconds


@dataclass(frozen=True)
class Base:
    version: int
    path: str
    marks: dict[str, int]  # newest batch covered, by writer
    gaps: frozenset[tuple[str, int]]  # batches below it that were not there
    buckets: int

    def covers(self, writer: str, batch_id: int) -> bool:
        return batch_id <= self.marks.get(writer, -1) and (writer, batch_id) not in self.gaps


def _millis(at: datetime | str) -> int:
    """A commit time; without a zone it is UTC."""
    at = datetime.fromisoformat(at) if isinstance(at, str) else at
    return int((at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp() * 1000)


class LogTable:
    """Create, append to, read back in time, and compact one table. Reads are lazy DataFrames."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec

    # -- definition ---------------------------------------------------------------------------

    def create(self) -> LogTable:
        """Create the table if it is absent; an existing one of the same key is left as it is."""
        path = f"{self.root}/_table.json"
        mine = {
            "key": list(self.spec.key),
            "order": list(self.spec.order),
            "schema": json.loads(self.spec.change_schema.json()),
        }
        if not files.exists(self.spark, path):
            files.write_text(self.spark, path, json.dumps(mine))
        elif json.loads(files.read_text(self.spark, path))["key"] != mine["key"]:
            raise ValueError(f"{self.root} holds a table with another key")
        return self

    # -- commits ------------------------------------------------------------------------------

    def batches(
        self, as_of_batch: int | None = None, writer: str | None = None, as_of_commit: datetime | str | None = None
    ) -> list[Batch]:
        """Committed batches, by one listing; all, or those that were there at some point.

        ``as_of_commit`` is a commit time. ``as_of_batch`` counts the batches of one ``writer``, which has to be named where
        there are several; of the others it takes what was committed by the time of that batch.
        """
        return self._chosen(self._listed(), as_of_batch, writer, as_of_commit)

    def _listed(self) -> list[Batch]:
        found = []
        for path, at in files.listing(self.spark, f"{self.root}/log/_commits/*"):
            if commit := _COMMIT.search(path):
                w, n = commit[1], int(commit[2])
                found.append(Batch(w, n, self._folder(w, n), int(commit[3]), at))
        return found

    @staticmethod
    def _chosen(
        found: list[Batch], as_of_batch: int | None, writer: str | None, as_of_commit: datetime | str | None
    ) -> list[Batch]:
        if as_of_commit is not None:
            found = [b for b in found if b.committed <= _millis(as_of_commit)]
        if as_of_batch is None:
            return found
        writers = {b.writer for b in found}
        if writer is None and len(writers) > 1:
            raise ValueError(f"batches are counted by writer; name one of {sorted(writers)}")
        mine = [b for b in found if b.batch_id <= as_of_batch and writer in (None, b.writer)]
        until = max((b.committed for b in mine), default=-1)
        return mine + [b for b in found if writer not in (None, b.writer) and b.committed <= until]

    def _folder(self, writer: str, batch_id: int) -> str:
        return f"{self.root}/log/writer={writer}/batch_id={batch_id}"

    def append_batch(self, changes: DataFrame, batch_id: int, writer: str = "batch", exact: bool = False) -> None:
        """Commit change records as batch ``batch_id`` of ``writer``, replacing an earlier attempt.

        With ``exact`` they have the table's types already and are written as they are, timestamps too. A base that holds the earlier attempt is withdrawn, so reads go by an older base or the log until the next compaction.
        """
        if "/" in writer or "@" in writer:
            raise ValueError("a writer is one path segment without @")
        rows = (changes if exact else align(changes, self.spec)).select(*self.spec.change_schema.fieldNames())
        commit = f"{self.root}/log/_commits/{writer}.{batch_id}@"
        for old in files.glob(self.spark, f"{commit}*"):
            files.delete(self.spark, old)
        for version in self._versions():
            if self._note(version).covers(writer, batch_id):
                files.delete(self.spark, f"{self.root}/base/_version={version}.json")
        folder = self._folder(writer, batch_id)
        rows.write.mode("overwrite").parquet(folder)
        files.write_text(self.spark, f"{commit}{files.size(self.spark, folder)}", "")

    def next_batch_id(self, writer: str = "batch") -> int:
        return 1 + max((b.batch_id for b in self.batches() if b.writer == writer), default=-1)

    def append(self, rows: DataFrame, op: str, seq: int | Column, ts: Column | None = None) -> None:
        """Commit plain rows as changes of one kind at position ``seq``."""
        position = F.lit(seq) if isinstance(seq, int) else seq
        stamp = F.localtimestamp() if ts is None else ts
        changes = rows.withColumns({"op": F.lit(op), "seq": position.cast("bigint"), "ts": stamp})
        self.append_batch(changes, self.next_batch_id())

    def delete(self, keys: DataFrame, seq: int | Column, ts: Column | None = None) -> None:
        """Delete by key: a tombstone for every row of ``keys``."""
        self.append(keys.select(*self.spec.key), DELETE, seq, ts)

    def delete_where(self, condition: Column, seq: int | Column, ts: Column | None = None) -> None:
        """Delete the current rows that satisfy ``condition``."""
        self.delete(self.read().where(condition), seq, ts)

    # -- reads --------------------------------------------------------------------------------

    def _read_log(self, batches: list[Batch]) -> DataFrame:
        partitions = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
        schema = T.StructType(self.spec.change_schema.fields + partitions)
        if not batches:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/log")
        return reader.parquet(*[b.path for b in batches])

    def log(
        self,
        as_of_batch: int | None = None,
        as_of_ts: Column | None = None,
        once: bool = False,
        writer: str | None = None,
        as_of_commit: datetime | str | None = None,
    ) -> DataFrame:
        """Committed change records with their ``writer`` and ``batch_id``.

        ``once`` leaves one copy of a change that several jobs or runs delivered. A change without event time belongs to
        every ``as_of_ts``.
        """
        rows = self._read_log(self.batches(as_of_batch, writer, as_of_commit))
        if as_of_ts is not None:
            rows = rows.where(F.col("ts").isNull() | (F.col("ts") <= as_of_ts))
        return dedup(rows, self.spec.key) if once else rows

    def batch(self, batch_id: int, writer: str = "batch") -> DataFrame:
        """The change records of one committed batch."""
        found = [b for b in self._listed() if (b.writer, b.batch_id) == (writer, batch_id)]
        return self._read_log(found).drop("writer", "batch_id")

    def versions(self, as_of_batch: int | None = None, writer: str | None = None) -> DataFrame:
        """The rows of the newest base that fits and the changes since, deletes included and not merged: the newest of a key counts."""
        everything = self._listed()
        base, batches = self._parts(everything, self._chosen(everything, as_of_batch, writer, None))
        since = self._read_log(batches).drop("writer", "batch_id")
        return since if base is None else self._open(base).unionByName(since)

    def since_base(self, as_of_batch: int) -> int:
        """How many batches up to ``as_of_batch`` the newest base that fits does not cover."""
        everything = self._listed()
        return len(self._parts(everything, [b for b in everything if b.batch_id <= as_of_batch])[1])

    def read(
        self,
        as_of_batch: int | None = None,
        as_of_ts: Column | None = None,
        columns: list[str] | None = None,
        keep_deletes: bool = False,
        writer: str | None = None,
        as_of_commit: datetime | str | None = None,
    ) -> DataFrame:
        """Current rows, or the rows as of a batch of a writer, a commit time or an event time (see ``batches`` and ``log``).

        With a base, the changes since are reduced to the newest per key and shuffled to the buckets of the base. Without one,
        the newest change per key is found by one aggregation. Building the plan takes one listing of commits and the note of
        the newest base that fits; nothing runs.
        """
        spec = self.spec
        wanted = columns or ([*spec.change_schema.fieldNames()] if keep_deletes else spec.columns)
        if as_of_ts is not None:
            # a base no longer knows older images, so event time is answered from the log
            return self._latest(self.log(as_of_batch, as_of_ts, False, writer, as_of_commit), wanted, keep_deletes)
        everything = self._listed()
        base, batches = self._parts(everything, self._chosen(everything, as_of_batch, writer, as_of_commit))
        if base is None:
            return self._latest(self._read_log(batches).drop("writer", "batch_id"), wanted, keep_deletes)
        needed = list(dict.fromkeys([*spec.key, *spec.order, "op", *wanted]))
        return self._visible(self._merged(base, batches, needed), wanted, keep_deletes)

    def _parts(self, everything: list[Batch], batches: list[Batch]) -> tuple[Base | None, list[Batch]]:
        """The base to start from, the newest that holds nothing but ``batches``, and the batches it does not cover."""
        others = set(everything) - set(batches)
        notes = (self._note(v) for v in self._versions())
        base = next((n for n in notes if not any(n.covers(b.writer, b.batch_id) for b in others)), None)
        return base, [b for b in batches if base is None or not base.covers(b.writer, b.batch_id)]

    def _merged(self, base: Base, batches: list[Batch], columns: list[str]) -> DataFrame:
        """Newest row of every key, deletes included. The base is not shuffled."""
        spec = self.spec
        state = self._open(base).select(*columns)
        if not batches:
            return state
        tail = self._read_log(batches).select(*columns)
        newest = latest_state(tail, spec.key, spec.order, keep_deletes=True).select(*columns)
        if base.buckets != self._shuffle_partitions():
            # Spark would rather shuffle both sides to its own number than the tail to fewer buckets
            newest = newest.repartition(base.buckets, *spec.key)
        return merge(state, newest, spec.key, spec.order)

    def _shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _latest(self, log: DataFrame, wanted: list[str], keep_deletes: bool) -> DataFrame:
        spec = self.spec
        needed = list(dict.fromkeys([*wanted, *(["op"] if keep_deletes else [])]))
        state = latest_state(log, spec.key, spec.order, columns=needed, keep_deletes=keep_deletes)
        return state.select(*wanted)

    @staticmethod
    def _visible(state: DataFrame, wanted: list[str], keep_deletes: bool) -> DataFrame:
        if not keep_deletes:
            state = state.where(F.coalesce(F.col("op") != DELETE, F.lit(True)))
        return state.select(*wanted)

    # -- compaction ---------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        """Committed bases, newest first."""
        notes = files.glob(self.spark, f"{self.root}/base/_version=*.json")
        return sorted((int(_VERSION.search(p).group(1)) for p in notes), reverse=True)

    def _note(self, version: int) -> Base:
        note = json.loads(files.read_text(self.spark, f"{self.root}/base/_version={version}.json"))
        gaps = frozenset((w, n) for w, n in note["gaps"])
        return Base(version, f"{self.root}/base/version={version}", note["marks"], gaps, note["buckets"])

    def _table_name(self, path: str) -> str:
        return "lakerill_" + hashlib.md5(path.encode()).hexdigest()

    def _open(self, base: Base) -> DataFrame:
        """The files of a base as a bucketed table, entered into this session's catalog if need be."""
        name = self._table_name(base.path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.change_schema)
            key = ", ".join(f"`{k}`" for k in self.spec.key)
            self.spark.sql(
                f"create table if not exists {name} ({columns}) using parquet"
                f" clustered by ({key}) sorted by ({key}) into {base.buckets} buckets location '{base.path}'"
            )
        return self.spark.table(name)

    def _buckets(self, base: Base | None, batches: list[Batch]) -> int:
        """Buckets for a new base: those of the last one, unless the table has outgrown them."""
        stored = sum(b.size for b in batches) + (files.size(self.spark, base.path) if base else 0)
        wanted = min(MAX_BUCKETS, max(1, -(-stored // BUCKET_BYTES)))
        return base.buckets if base and wanted <= 4 * base.buckets else wanted

    def compact(
        self, upto: int | None = None, drop_deletes_before: Column | None = None, buckets: int | None = None
    ) -> int | None:
        """Fold the batches up to ``upto`` into a new base and return its version.

        The last base is joined with the changes since, bucket by bucket, so only the changes are
        shuffled; the first base, and one with another number of ``buckets``, takes a shuffle of it all.
        Tombstones stay, because a change older than the delete may still arrive and would revive the
        row. ``drop_deletes_before`` gives the event time before which nothing arrives any more.
        The log stays too, for time travel.
        """
        spec = self.spec
        everything = self._listed()
        covered = [b for b in everything if upto is None or b.batch_id <= upto]
        if not covered:
            return None
        base, batches = self._parts(everything, covered)
        columns = spec.change_schema.fieldNames()
        number = buckets or self._buckets(base, batches)
        if base is None:
            state = latest_state(self._read_log(batches).select(*columns), spec.key, spec.order, keep_deletes=True)
        else:
            state = self._merged(base, batches, columns)
        if base is None or number != base.buckets or not batches:
            state = state.repartition(number, *spec.key)
        if drop_deletes_before is not None:
            gone = (F.col("op") == DELETE) & (F.col("ts") < drop_deletes_before)
            state = state.where(~F.coalesce(gone, F.lit(False)))
        taken = files.glob(self.spark, f"{self.root}/base/version=*")
        version = 1 + max((int(p.rsplit("=", 1)[1]) for p in taken), default=-1)  # one compaction at a time
        folder = f"{self.root}/base/version={version}"
        writer = state.select(*columns).write.format("parquet").option("path", folder)
        writer.bucketBy(number, *spec.key).sortBy(*spec.key).saveAsTable(self._table_name(folder))
        marks = {w: max(b.batch_id for b in covered if b.writer == w) for w in {b.writer for b in covered}}
        there = {(b.writer, b.batch_id) for b in covered}
        gaps = [(w, n) for w, mark in marks.items() for n in range(mark) if (w, n) not in there]
        note = {"marks": marks, "gaps": gaps, "buckets": number}
        files.write_text(self.spark, f"{self.root}/base/_version={version}.json", json.dumps(note))
        return version
