"""Records per time window, as a batch, as a stream, and as a table kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lake import LogTable
from ..specs import BIGINT, TIMESTAMP, TableSpec, schema_of
from .ingest import stream_id

#: Table a throughput stream keeps: the newest count of every window wins.
THROUGHPUT = TableSpec(
    "throughput", schema_of(window_start=TIMESTAMP, window_end=TIMESTAMP, n_records=BIGINT), ("window_start",)
)


def throughput(
    events: DataFrame, ts: str = "ts", window: str = "5 minutes", lateness: str | None = None
) -> DataFrame:
    """Records per window of event time.

    A stream with a ``lateness`` closes each window that long after its end and forgets it; without
    one it keeps a counter per window and counts every record, however late.
    """
    timed = events.select(F.col(ts).alias("event_ts"))
    if events.isStreaming and lateness:
        # watermarks only exist on timestamps with a zone
        timed = timed.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", lateness)
    counts = timed.groupBy(F.window("event_ts", window).alias("w")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "n_records",
    )


def start_throughput(
    events: DataFrame,
    table: LogTable,
    checkpoint: str,
    trigger: Mapping[str, Any],
    ts: str = "ts",
    window: str = "5 minutes",
    lateness: str | None = None,
) -> StreamingQuery:
    """Keep ``table`` (of spec THROUGHPUT) at the counts so far, the unfinished windows included.

    The stream emits the windows a micro-batch has changed; each is a change record at the batch's
    position, so the table is right after every batch and a re-run batch replaces itself. A new
    checkpoint counts from nothing and needs a table of its own; a table that another one wrote is refused.
    """
    table.create()
    counts = throughput(events, ts, window, lateness)

    def commit(batch: DataFrame, batch_id: int) -> None:
        writer = stream_id(table.spark, checkpoint)
        if others := {b.writer for b in table.batches()} - {writer}:
            raise ValueError(f"{table.root} is kept by another stream: {sorted(others)}")
        changed = batch.withColumns(
            {"op": F.lit("u"), "seq": F.lit(batch_id).cast("bigint"), "ts": F.col("window_end")}
        )
        table.append_batch(changed, batch_id, writer)

    stream = counts.writeStream.outputMode("update").foreachBatch(commit)
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()


#: Event time of a record that ends a feed: later than all others.
END_OF_FEED = "9999-01-01 00:00:00"
_MARKERS = schema_of(event_ts=TIMESTAMP)


def end_feed(spark: SparkSession, markers: str) -> None:
    """Say that a feed has ended: the next run of :func:`start_closed_throughput` closes every window."""
    end = spark.range(1).select(F.lit(END_OF_FEED).cast("timestamp_ntz").alias("event_ts"))
    end.coalesce(1).write.mode("overwrite").parquet(markers)


def start_closed_throughput(
    events: DataFrame,
    table: LogTable,
    checkpoint: str,
    markers: str,
    trigger: Mapping[str, Any],
    lateness: str,
    ts: str = "ts",
    window: str = "5 minutes",
) -> StreamingQuery:
    """Write each window of event time to ``table`` (of spec THROUGHPUT) once, when no more records can change it.

    A window is closed when the newest event time is ``lateness`` past its end; then its state is forgotten, and what still comes for
    it is left out and counted (``dropped_late``). The windows of a feed's last stretch stay open until ``end_feed`` puts a
    record into the folder ``markers`` whose time is past them all; it is in no count. The folder has to exist.
    """
    table.create()
    spark = events.sparkSession
    marks = spark.readStream.schema(_MARKERS).parquet(markers).select("event_ts", F.lit(True).alias("mark"))
    both = events.select(F.col(ts).cast("timestamp_ntz").alias("event_ts"), F.lit(False).alias("mark")).unionAll(marks)
    timed = both.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark("event_ts", lateness)
    counts = timed.groupBy(F.window("event_ts", window).alias("w")).agg(F.count_if(~F.col("mark")).alias("n_records"))
    closed = counts.where("n_records > 0").select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_records"
    )

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"op": F.lit("c"), "seq": F.lit(batch_id).cast("bigint"), "ts": F.col("window_end")})
        table.append_batch(rows, batch_id, stream_id(table.spark, checkpoint))

    stream = closed.writeStream.outputMode("append").foreachBatch(commit)
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start()
