"""Latency from event to commit, per batch, as histograms that can be added up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_of_column
from ..operators.lake import LogTable
from ..specs import BIGINT, schema_of
from .ingest import start_ingest, stream_id

#: Leading binary digits that a histogram keeps of a latency: a bucket is at most an eighth of its value wide.
DIGITS = 4
_HISTOGRAM = schema_of(bucket_ms=BIGINT, n_changes=BIGINT)


def bucket(ms: Column) -> Column:
    """The lower edge of the bucket of a latency: its leading binary digits. A latency below zero counts as zero."""
    ms = F.greatest(ms, F.lit(0).cast("bigint"))
    rest = F.greatest(F.length(F.bin(ms)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", ms, rest), rest)


def start_timed_ingest(
    changes: DataFrame,
    table: LogTable,
    checkpoint: str,
    trigger: Mapping[str, Any],
    clock: Callable[[int], datetime | str] | None = None,
) -> StreamingQuery:
    """Write a stream of change records into ``table`` and note for each batch how long its changes took to be committed.

    The histogram is made from the event times of the committed batch, one column read back, against the time of its commit:
    ``clock`` of the batch number, or the wall clock. A batch that runs again replaces its histogram.
    """

    def note(done: LogTable, batch_id: int) -> None:
        writer = stream_id(done.spark, checkpoint)
        moment = F.unix_millis(as_of_column(clock(batch_id) if clock else None).cast("timestamp"))
        mine = done.log().where((F.col("writer") == writer) & (F.col("batch_id") == batch_id) & F.col("ts").isNotNull())
        late = (moment - F.unix_millis(F.col("ts").cast("timestamp"))).alias("ms")
        counts = mine.select(late).groupBy(bucket(F.col("ms")).alias("bucket_ms")).agg(F.count(F.lit(1)).alias("n_changes"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{done.root}/latency/writer={writer}/batch_id={batch_id}")

    return start_ingest(changes, table, checkpoint, trigger, after_batch=note)


def read_latency(table: LogTable) -> DataFrame:
    """Histograms of all batches: ``writer``, ``batch_id``, ``bucket_ms``, ``n_changes``."""
    parts = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
    return table.spark.read.schema(T.StructType(_HISTOGRAM.fields + parts)).parquet(f"{table.root}/latency")


def latency_quantiles(histograms: DataFrame, by: Sequence[str] = ("batch_id",), quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``n_changes`` and quantiles (``p50_ms`` and so on) per ``by``, or of all histograms together if that is empty.

    Histograms are added up bucket by bucket; a quantile is the lower edge of the bucket in which it falls.
    """
    sums = histograms.groupBy(*by, "bucket_ms").agg(F.sum("n_changes").alias("n"))
    # some hundred buckets to a group at most, since they grow with the value
    own = Window.partitionBy(*by)
    so_far = own.orderBy("bucket_ms").rowsBetween(Window.unboundedPreceding, 0)
    placed = sums.select(*by, "bucket_ms", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(own).alias("all"))
    picks = [
        F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * q), F.col("bucket_ms"))).alias(f"p{round(100 * q)}_ms") for q in quantiles
    ]
    return placed.groupBy(*by).agg(F.max("all").alias("n_changes"), *picks)
