"""Surrogate keys without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def assign_ids(
    df: DataFrame, start: int | Column = 0, order: Sequence[str] = (), name: str = "id"
) -> DataFrame:
    """Number the rows ``start`` + 1, + 2, … without gaps, in ``order`` where one is given.

    With an order the rows are range-partitioned and sorted; ties go by the remaining columns, and
    the row's place in the input splits even identical rows over partitions. Each row's place in its
    partition is written down once, so a lost executor cannot renumber what was numbered, and adding
    the sizes of the earlier partitions makes the numbers run through. Without an order there is no
    shuffle at all.
    """
    placed = df
    if order:
        rest = [c for c in df.columns if c not in order]
        ranges = [F.col(c).asc_nulls_last() for c in [*order, *rest, "__place"]]
        placed = (
            df.withColumn("__place", F.monotonically_increasing_id())
            .repartitionByRange(*ranges)
            .sortWithinPartitions(*ranges)
            .drop("__place")
        )
    place = F.monotonically_increasing_id()
    stored = materialise(
        placed.withColumns(
            {"__part": F.shiftright(place, _ROW_BITS), "__row": place.bitwiseAND((1 << _ROW_BITS) - 1)}
        ),
        "ids",
    )
    # one row per partition of the write, so this window and the broadcast stay small
    sizes = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = sizes.select("__part", before.alias("__before"))
    base = F.lit(start) if isinstance(start, int) else start
    number = (base + F.col("__before") + F.col("__row") + 1).cast("bigint")
    return stored.join(F.broadcast(offsets), "__part").select(number.alias(name), *df.columns)
