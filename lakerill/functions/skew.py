"""Finding hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No table can have more hot keys than this: a hot key holds at least 1/MAX_HOT_KEYS of all rows.
MAX_HOT_KEYS = 100_000


def hot_keys(df: DataFrame, key: Sequence[str], min_rows: int) -> DataFrame:
    """Keys too large for one task, with their number of rows ``n``.

    A hot key has ``min_rows`` rows or more and at least one in MAX_HOT_KEYS of all rows, so the
    result has at most MAX_HOT_KEYS rows whatever the size of ``df``. Only the key columns are read, and the
    counts are combined before the shuffle.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()  # reads no column
    floor = F.greatest(F.lit(min_rows), F.ceil(total / F.lit(MAX_HOT_KEYS)))
    return counts.where(F.col("n") >= floor)
