"""Joins of facts with dimensions that hold up when one key has a large share of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_by_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    by: list[str],
    sums: Sequence[Column],
    again: Sequence[Column],
) -> DataFrame:
    """Aggregates of the facts per attribute ``by`` of their dimension row (inner join).

    ``sums`` aggregate facts, ``again`` aggregate the results of ``sums``. Facts are added up per key
    before the join: map tasks combine the rows of a hot key, and what is shuffled and joined is one row
    per key. A dimension key that occurs twice counts its facts twice, as the plain join does.
    """
    per_key = facts.groupBy(fact_key).agg(*sums)
    attributes = dimension.select(F.col(dimension_key).alias("__key"), *by)
    return per_key.join(attributes, F.col(fact_key) == F.col("__key")).groupBy(*by).agg(*again)


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows per key value that the parent table lacks. NULL refers to nothing and is left out."""
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias("__key"))
    return used.join(known, F.col(child_key) == F.col("__key"), "left_anti")
