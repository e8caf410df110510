"""Surrogate keys for a stream: numbers that go on from batch to batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import assign_ids, files
from ..specs import BIGINT, schema_of

_RANGE = schema_of(last_id=BIGINT)


class IdLedger:
    """Numbers the rows of each micro-batch after those of the batch before, without gaps, and keeps them under ``root``.

    Batch *n* goes on after the last id that the ledger notes for batch *n* - 1, and its rows are numbered in ``order`` (ties by the
    other columns), so a batch that runs again gives every row the id it had, replaces its rows and notes the same. An empty
    batch notes the last id again. Use it as the function of ``foreachBatch``.
    """

    def __init__(self, root: str, order: Sequence[str], name: str = "id"):
        self.root, self.order, self.name = root.rstrip("/"), list(order), name

    def _note(self, batch_id: int) -> str:
        return f"{self.root}/ledger/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, last = batch.sparkSession, 0
        if batch_id:
            last = spark.read.schema(_RANGE).parquet(self._note(batch_id - 1)).first()["last_id"]
        folder = f"{self.root}/rows/batch_id={batch_id}"
        assign_ids(batch, last, self.order, self.name).write.mode("overwrite").parquet(folder)
        written = spark.read.parquet(folder).agg((F.count(F.lit(1)) + last).cast("bigint").alias("last_id"))
        written.write.mode("overwrite").parquet(self._note(batch_id))

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Numbered rows of the batches that the ledger has; ``schema`` is that of the stream's rows."""
        numbered = T.StructType([T.StructField(self.name, T.LongType()), *schema.fields])
        noted = [int(p.rsplit("=", 1)[1]) for p in files.glob(spark, f"{self.root}/ledger/batch_id=*")]
        if not noted:
            return spark.createDataFrame([], numbered)
        # batches run one after the other, so all up to the newest noted one are there
        return spark.read.schema(T.StructType([*numbered.fields, T.StructField("batch_id", T.LongType())])).parquet(
            f"{self.root}/rows"
        ).where(F.col("batch_id") <= max(noted))


def start_numbering(rows: DataFrame, ledger: IdLedger, checkpoint: str, trigger: Mapping[str, Any]) -> StreamingQuery:
    """Number the rows of a stream (see :class:`IdLedger`)."""
    return rows.writeStream.foreachBatch(ledger).option("checkpointLocation", checkpoint).trigger(**trigger).start()
