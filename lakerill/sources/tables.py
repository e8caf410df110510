"""Named tables of a catalog folder and plain scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession

#: Tables of the benchmark catalog.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of a catalog folder, with the columns its files have now."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stream_table(spark: SparkSession, folder: str, table: str, max_files: int = 1000) -> DataFrame:
    """The files of a table as a stream, at most ``max_files`` per micro-batch."""
    schema = read_table(spark, folder, table).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    # as a pattern, because a stream takes a table of one file only that way
    return reader.parquet(f"{folder}/{table}.parque[t]")


def register_tables(spark: SparkSession, folder: str, tables: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    """Expose the tables of ``folder`` to SQL as views and return them by name."""
    found = {t: read_table(spark, folder, t) for t in tables}
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return found


def scan(df: DataFrame, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Filtered, pruned scan. ``where`` should use bare columns so the files can skip row groups."""
    out = df if where is None else df.where(where)
    return out if columns is None else out.select(*columns)
