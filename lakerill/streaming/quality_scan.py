"""Quality scans of a table while it grows."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_of_column
from ..operators.lake import LogTable
from ..quality import Rule, report
from ..sources import files
from ..specs import BOOLEAN, DOUBLE, STRING, TIMESTAMP, schema_of
from .ingest import EVERY_MINUTE, start_ingest

SCAN_SECONDS = 300

SCAN_SCHEMA = schema_of(
    scan_ts=TIMESTAMP,
    table=STRING,
    check_name=STRING,
    value=DOUBLE,
    threshold=DOUBLE,
    passed=BOOLEAN,
    status=STRING,
)


#: A table of a scan: a lake table or a function is read anew for every scan, a frame as Spark sees it then.
Source = DataFrame | LogTable | Callable[[], DataFrame]


def _named_columns(rules: Sequence[Rule], table: str, tables: Mapping[str, Source]) -> list[str] | None:
    """The columns that the rules name, or None if an expression may name others."""
    own = [r for r in rules if r.table == table]
    if any(r.filter or r.metric == "custom" for r in own):
        return None
    parents = [r.args["parent_column"] for r in rules if r.metric == "orphan_count" and r.args["parent"] == table]
    return list(dict.fromkeys([r.column for r in own if r.column] + parents))


def scan_tables(
    spark: SparkSession,
    tables: Mapping[str, Source],
    rules: Sequence[Rule],
    out: str,
    number: int,
    as_of: Column | datetime | str | None = None,
) -> None:
    """Read all tables, evaluate the rules and write the results as scan ``number``.

    A lake table is merged once per scan: its columns that the rules name are kept until the results are written.
    """
    frames, kept = {}, []
    for name, source in tables.items():
        if isinstance(source, LogTable):
            columns = _named_columns(rules, name, tables)
            source = source.read(columns=columns or None).persist()
            kept.append(source)
        frames[name] = source() if callable(source) else source
    try:
        found = report(frames, rules, as_of, spark)
        stamped = found.withColumn("scan_ts", as_of_column(None)).select(*SCAN_SCHEMA.fieldNames())
        # a few rows: one per rule
        stamped.coalesce(1).write.mode("overwrite").parquet(f"{out}/scan={number}")
    finally:
        for df in kept:
            df.unpersist()


class PeriodicScan:
    """Scan after the first commit and then after commits that come ``every_seconds`` or later; append to ``out``.

    This is for streams that end; a feed that stops is only noticed by :class:`ClockedScan`.
    """

    def __init__(
        self,
        rules: Sequence[Rule],
        out: str,
        every_seconds: float = SCAN_SECONDS,
        others: Mapping[str, Source] | None = None,
        as_of: Column | datetime | str | None = None,
    ):
        self.rules = rules
        self.out = out
        self.every_seconds = every_seconds
        self.others = dict(others or {})
        self.as_of = as_of
        self._last: float | None = None
        self._waiting: int | None = None

    def __call__(self, table: LogTable, batch_id: int) -> None:
        now = time.monotonic()
        if self._last is not None and now - self._last < self.every_seconds:
            self._waiting = batch_id
            return
        self._last = now
        self._scan(table, batch_id)

    def finish(self, table: LogTable) -> None:
        """Scan what was committed since the last scan, after a stream that has ended."""
        if self._waiting is not None:
            self._scan(table, self._waiting)

    def _scan(self, table: LogTable, batch_id: int) -> None:
        self._waiting = None
        scan_tables(table.spark, {**self.others, table.spec.name: table}, self.rules, self.out, batch_id, self.as_of)


class ClockedScan:
    """Scan at the start and then every ``every_seconds``, whether or not anything was committed.

    Every scan reads all tables anew. Scans are numbered on from those that ``out`` holds. ``as_of`` may be a function, for a
    clock other than the wall's.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, Source],
        rules: Sequence[Rule],
        out: str,
        every_seconds: float = SCAN_SECONDS,
        as_of: Callable[[], Column | datetime | str | None] | None = None,
    ):
        self.spark, self.tables, self.rules, self.out = spark, dict(tables), rules, out
        self.every_seconds, self.as_of = every_seconds, as_of
        self.error: Exception | None = None
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def start(self) -> ClockedScan:
        self._thread.start()
        return self

    def stop(self) -> None:
        """Let a scan that runs end, and scan no more; raises what made a scan fail."""
        self._stop.set()
        self._thread.join()
        if self.error:
            raise self.error

    def _run(self) -> None:
        taken = [int(p.rsplit("=", 1)[1]) for p in files.glob(self.spark, f"{self.out}/scan=*")]
        number = max(taken, default=-1)
        due = time.monotonic()
        try:
            while not self._stop.wait(max(0.0, due - time.monotonic())):
                number += 1
                scan_tables(self.spark, self.tables, self.rules, self.out, number, self.as_of() if self.as_of else None)
                due += self.every_seconds
        except Exception as e:  # kept for stop(), which the caller sees
            self.error = e


def start_quality_scan(
    changes: DataFrame,
    table: LogTable,
    rules: Sequence[Rule],
    out: str,
    checkpoint: str,
    trigger: Mapping[str, Any] = EVERY_MINUTE,
    every_seconds: float = SCAN_SECONDS,
    others: Mapping[str, Source] | None = None,
    as_of: Column | datetime | str | None = None,
) -> StreamingQuery:
    """Ingest ``changes`` and scan the growing table by ``rules``."""
    scan = PeriodicScan(rules, out, every_seconds, others, as_of)
    return start_ingest(changes, table, checkpoint, trigger, after_batch=scan)


def read_scans(spark: SparkSession, out: str) -> DataFrame:
    """All scan results with the number of the batch they followed in ``scan``."""
    schema = T.StructType(SCAN_SCHEMA.fields + [T.StructField("scan", T.LongType())])
    return spark.read.schema(schema).parquet(out)


def last_scan(spark: SparkSession, out: str) -> DataFrame:
    """Results of the newest scan."""
    newest = F.row_number().over(Window.partitionBy("table", "check_name").orderBy(F.desc("scan")))
    return read_scans(spark, out).withColumn("__rn", newest).where("__rn = 1").drop("__rn")
