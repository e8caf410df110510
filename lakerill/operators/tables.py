"""Creating tables and views from queries, inserting rows, and reading evolved schemas as one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_rows(target: DataFrame, rows: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """``target`` with ``rows`` added, matched by column name.

    Columns the new rows lack, and their NULLs, take the default if the column has one. Rows may not
    bring columns of their own.
    """
    extra = [c for c in rows.columns if c not in target.columns]
    if extra:
        raise ValueError(f"no such column in the target: {', '.join(extra)}")
    filled = {}
    for field in target.schema.fields:
        given = F.col(field.name) if field.name in rows.columns else F.lit(None)
        default = (defaults or {}).get(field.name)
        value = given if default is None else F.coalesce(given, default)
        filled[field.name] = value.cast(field.dataType)
    return target.unionByName(rows.select(*[v.alias(c) for c, v in filled.items()]))


def evolve(*frames: DataFrame) -> DataFrame:
    """Tables of different schema versions as one; columns a version lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ctas(df: DataFrame, path: str) -> DataFrame:
    """Create the table at ``path`` from ``df`` (an error if it exists) and return a scan of it."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cvas(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the view ``name`` and return it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def memory_table(df: DataFrame, name: str) -> DataFrame:
    """A view whose rows stay in executor memory, spilling to disk, until ``unpersist()``."""
    return cvas(df.persist(), name)
