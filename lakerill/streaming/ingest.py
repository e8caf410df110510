"""Continuous ingest of change streams into lake tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.lake import LogTable
from ..sources import files, good_changes
from ..specs import BIGINT, DELETE, STRING, TIMESTAMP, schema_of

#: Commit rhythm of a continuous job.
EVERY_MINUTE = {"processingTime": "60 seconds"}

AfterBatch = Callable[[LogTable, int], None]

METRICS_SCHEMA = schema_of(
    n_changes=BIGINT,
    n_deletes=BIGINT,
    missing_keys=BIGINT,
    min_seq=BIGINT,
    max_seq=BIGINT,
    first_ts=TIMESTAMP,
    last_ts=TIMESTAMP,
    ingested_at=TIMESTAMP,
)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint: the same after a restart, another for a new checkpoint."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


def _metrics(table: LogTable) -> list:
    missing = F.lit(False)
    for k in table.spec.key:
        missing = missing | F.col(k).isNull()
    return [
        F.count(F.lit(1)).alias("n_changes"),
        F.count_if(F.col("op") == DELETE).alias("n_deletes"),
        F.count_if(missing).alias("missing_keys"),
        F.min("seq").alias("min_seq"),
        F.max("seq").alias("max_seq"),
        F.min("ts").cast("string").alias("first_ts"),
        F.max("ts").cast("string").alias("last_ts"),
    ]


def _record_metrics(table: LogTable, seen: Mapping[str, Any], writer: str, batch_id: int) -> None:
    noted = [F.lit(seen[f.name]).cast(f.dataType).alias(f.name) for f in METRICS_SCHEMA if f.name in seen]
    row = table.spark.range(1).select(*noted, F.localtimestamp().alias("ingested_at"))
    row.write.mode("overwrite").parquet(f"{table.root}/metrics/writer={writer}/batch_id={batch_id}")


def read_metrics(table: LogTable) -> DataFrame:
    """What :func:`start_ingest` noted per batch, with ``writer`` and ``batch_id``."""
    parts = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    schema = T.StructType(METRICS_SCHEMA.fields + parts)
    return table.spark.read.schema(schema).parquet(f"{table.root}/metrics")


def ingest_latency(table: LogTable) -> DataFrame:
    """Seconds from the newest event of every batch to its commit."""
    behind = F.unix_micros(F.col("ingested_at").cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))
    return read_metrics(table).select("writer", "batch_id", "n_changes", (behind / 1_000_000).alias("latency_seconds"))


def start_ingest(
    changes: DataFrame,
    table: LogTable,
    checkpoint: str,
    trigger: Mapping[str, Any],
    metrics: bool = False,
    after_batch: AfterBatch | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream of change records into ``table``, one commit per micro-batch.

    A batch that is run again after a failure replaces its own folder, so each change is in the log
    once per stream. With ``metrics`` the batch is measured while it is written, without another pass.
    ``after_batch`` is called with the table and the batch number after every commit. Compaction is no
    part of the stream: call ``LogTable.compact`` from a maintenance job now and then, so that reads stay short.
    """
    table.create()
    writer: list[str] = []

    def commit(batch: DataFrame, batch_id: int) -> None:
        if not writer:
            writer.append(stream_id(table.spark, checkpoint))
        if metrics:
            seen = Observation()
            table.append_batch(batch.observe(seen, *_metrics(table)), batch_id, writer[0])
            _record_metrics(table, seen.get, writer[0], batch_id)
        else:
            table.append_batch(batch, batch_id, writer[0])
        if after_batch is not None:
            after_batch(table, batch_id)

    stream = changes.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (stream.queryName(name) if name else stream).start()


_BROKEN = schema_of(value=STRING, reason=STRING)


def start_image_ingest(
    records: DataFrame, table: LogTable, checkpoint: str, trigger: Mapping[str, Any], name: str | None = None
) -> StreamingQuery:
    """Write a stream of records with images (``read_images``) into ``table``; broken ones go to a folder beside it.

    A record that changes its row's key deletes the old key and inserts the new one in the same commit. Broken records keep their
    text and the reason (``read_broken``); a batch that runs again replaces both its changes and its broken records.
    """
    table.create()

    def commit(batch: DataFrame, batch_id: int) -> None:
        writer = stream_id(table.spark, checkpoint)
        broken = batch.where("reason is not null").select("value", "reason")
        broken.write.mode("overwrite").parquet(f"{table.root}/broken/writer={writer}/batch_id={batch_id}")
        table.append_batch(good_changes(batch, table.spec), batch_id, writer)

    stream = records.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (stream.queryName(name) if name else stream).start()


def read_broken(table: LogTable) -> DataFrame:
    """The records that :func:`start_image_ingest` put aside, with ``reason``, ``writer`` and ``batch_id``."""
    parts = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    return table.spark.read.schema(T.StructType(_BROKEN.fields + parts)).parquet(f"{table.root}/broken")
