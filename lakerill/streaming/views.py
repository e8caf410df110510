"""Views over a live table: sums and counts per group, kept by what each change takes back and adds."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.lake import LogTable
from ..specs import BIGINT, DELETE, INT, TableSpec, schema_of
from .ingest import stream_id
from .retract import held_before, row_changes, row_state, running_sums

#: Sales by product and day; money in cents.
SALES_VIEW = TableSpec(
    "sales_view",
    schema_of(product_id=INT, sale_date=T.DateType(), sales_count=BIGINT, units=BIGINT, price=BIGINT, revenue=BIGINT),
    ("product_id", "sale_date"),
)
_SUMS = ("sales_count", "units", "price", "revenue")


#: What of a sale the view depends on.
_ROW = ("product_id", "qty", "price", "sale_ts")


def sales_deltas(changes: DataFrame, batch_id: int, state: LogTable, spec: TableSpec) -> DataFrame:
    """What a batch of sales changes takes from and adds to each product and day; ``state`` holds the sales (``row_state``)."""
    rows = row_changes(changes, batch_id, state, spec.key, _ROW)
    weight, qty, cents = F.col("weight").cast("bigint"), F.col("qty"), (F.col("price") * 100).cast("bigint")
    return rows.select(
        "product_id",
        F.to_date("sale_ts").alias("sale_date"),
        weight.alias("sales_count"),
        (weight * qty).alias("units"),
        (weight * cents).alias("price"),
        (weight * qty * cents).alias("revenue"),
    )


def start_sales_view(
    changes: DataFrame, spec: TableSpec, view: LogTable, checkpoint: str, trigger: Mapping[str, Any]
) -> StreamingQuery:
    """Keep ``view`` (of spec SALES_VIEW) in step with a stream of sales changes.

    An update takes the row it replaces out of its product and day and adds the new one to its own, a delete only takes. A
    micro-batch commits the groups it has changed, those that are empty now as deletes. The rows that changes replace are
    kept beside the view, by stream; the sales are not read. A batch that runs again replaces itself. A new checkpoint starts
    from nothing and needs a view of its own; one that another stream wrote is refused.
    """
    view.create()

    def commit(batch: DataFrame, batch_id: int) -> None:
        writer = stream_id(view.spark, checkpoint)
        if others := {b.writer for b in view.batches()} - {writer}:
            raise ValueError(f"{view.root} is kept by another stream: {sorted(others)}")
        state = row_state(view.spark, f"{view.root}/_rows/{writer}", changes.schema, spec.key, _ROW)
        deltas = sales_deltas(batch, batch_id, state, spec)
        changed = running_sums(deltas, SALES_VIEW.key, _SUMS, held_before(view, batch_id, writer))
        rows = changed.select(
            F.when(F.col("sales_count_after") == 0, DELETE).otherwise("u").alias("op"),
            F.lit(batch_id).cast("bigint").alias("seq"),
            F.lit(None).cast("timestamp_ntz").alias("ts"),
            "product_id",
            "sale_date",
            *[F.col(f"{c}_after").alias(c) for c in _SUMS],
        )
        view.append_batch(rows, batch_id, writer)

    return changes.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _money(cents: str) -> Column:
    return (F.sum(cents).cast("decimal(30,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("double")


def view_tiles(view: DataFrame) -> DataFrame:
    """The dashboard's tiles from a sales view: count, units and price per product id, and the totals in the row without one.

    A missing amount counts as none; an empty view has no tiles.
    """
    tiles = view.groupingSets([["product_id"], []], "product_id").agg(
        F.grouping("product_id").cast("int").alias("is_total"),
        F.coalesce(F.sum("sales_count"), F.lit(0)).alias("sales_count"),
        F.sum("units").alias("total_units"),
        _money("price").alias("total_price"),
    )
    return tiles.select("product_id", "is_total", "sales_count", "total_units", "total_price")


def view_daily(view: DataFrame) -> DataFrame:
    """Sales, revenue and average order value per day from a sales view."""
    days = view.groupBy("sale_date").agg(F.sum("sales_count").alias("daily_sales"), _money("revenue").alias("revenue"))
    return days.withColumn("average_order_value", F.col("revenue") / F.col("daily_sales")).orderBy(F.asc_nulls_last("sale_date"))
