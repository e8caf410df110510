"""Pseudo-random numbers that are a function of the row.

``rand()`` would give a retried task other values than the lost one; these stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(key: Column, salt: str, bound: int) -> Column:
    """A number from 0 to ``bound`` - 1 that depends on ``key`` and ``salt`` alone."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":" + salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(bound)
