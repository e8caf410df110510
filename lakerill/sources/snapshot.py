"""Initial snapshot of a source table, read in parallel by key ranges of about equal counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def key_range(df: DataFrame, key: str) -> tuple[int, int] | None:
    """Smallest and largest key, or None for a table without keys (two numbers reach the driver)."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return None if low is None else (low, high)


#: Rows of a chunk, about, and the most chunks of a snapshot.
CHUNK_ROWS = 1_000_000
MAX_CHUNKS = 10_000


def chunk_bounds(df: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS) -> list[int]:
    """Where chunks of about ``chunk_rows`` rows begin, but the first: approximate percentiles of the key.

    The number of chunks follows from the number of rows, so sparse and clustered keys make even chunks.
    """
    n = df.where(F.col(key).isNotNull()).count()
    parts = min(MAX_CHUNKS, -(-n // chunk_rows))
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, F.array(*map(F.lit, cuts)), F.lit(10 * parts))).first()[0]
    return sorted({int(x) for x in found})


def snapshot_options(
    url: str, table: str, key: str, bounds: tuple[int, int], parts: int, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC read of ``table`` in ``parts`` key ranges, one task each."""
    low, high = bounds
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        # Spark's upper bound only sets the stride; one past the end keeps the last range even
        "upperBound": str(high + 1),
        "numPartitions": str(parts),
        "fetchsize": str(fetch_rows),
    }


def snapshot_read(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], parts: int, **properties: str
) -> DataFrame:
    """Rows of a database table, read over JDBC in key ranges."""
    options = snapshot_options(url, table, key, bounds, parts) | properties
    return spark.read.format("jdbc").options(**options).load()


def chunk_predicates(key: str, bounds: Sequence[int]) -> list[str]:
    """A condition per chunk, NULL keys in the first: for reads that take one query per partition."""
    lows, highs = [None, *bounds], [*bounds, None]
    out = []
    for low, high in zip(lows, highs):
        parts = [f"{key} >= {low}"] * (low is not None) + [f"{key} < {high}"] * (high is not None)
        test = " and ".join(parts) or "1 = 1"
        out.append(test if low is not None else f"({test}) or {key} is null")
    return out


def snapshot_by_chunks(spark: SparkSession, url: str, table: str, key: str, bounds: Sequence[int], **properties: str) -> DataFrame:
    """Rows of a database table, read over JDBC with one query per chunk."""
    return spark.read.jdbc(url, table, predicates=chunk_predicates(key, bounds), properties=properties)


def snapshot_chunks(df: DataFrame, key: str, bounds: Sequence[int]) -> DataFrame:
    """Number the chunk of every row in ``chunk``, from 0; NULL keys are in the first.

    The sorted bounds are searched by halving: some 14 comparisons per row for the most bounds there are.
    """
    if not bounds:
        return df.withColumn("chunk", F.lit(0))
    # one constant, not an expression per bound
    edges = F.from_json(F.lit(str([int(b) for b in bounds])), "array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def forward(at: Column, step: Column) -> Column:
        # a place beyond the bounds is null there, and stays
        return F.when(F.get(edges, at + step - 1) <= F.col(key), at + step).otherwise(at)

    chunk = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), forward)
    return df.withColumn("chunk", F.when(F.col(key).isNull(), 0).otherwise(chunk))


def chunk_counts(df: DataFrame, key: str, bounds: Sequence[int]) -> DataFrame:
    """Rows and key span of every snapshot chunk, to see that the ranges are even and complete."""
    return (
        snapshot_chunks(df, key, bounds)
        .groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
    )
