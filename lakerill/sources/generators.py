"""Rows for trying things out: the seed tables and the change generator.

All of them are narrow transforms of a spine of numbers or batches, so they scale with it, and a
re-run task produces the rows it produced before.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_of_column, draw
from ..specs import PRODUCTS

# Seed products, price by product id, shape of the seeded sales.
SEED_PRODUCTS = (
    ("P-001", "Widget Mini"),
    ("P-002", "Widget Standard"),
    ("P-003", "Widget Pro"),
    ("P-004", "Widget Ultra"),
)
SEED_PRICES = ("9.99", "19.99", "29.99", "49.99")
SEED_SALES = 900
SEED_FIRST_DAY = 1095
SEED_MAX_QTY = 4
SECONDS_PER_DAY = 86_400
BATCH_PRODUCTS = 5
BATCH_MAX_CENTS = 100_000
BATCH_SECONDS = 120

#: Rhythm of the change generator.
EVERY_TWO_MINUTES = {"processingTime": f"{BATCH_SECONDS} seconds"}


def number_spine(spark: SparkSession, n: int = SEED_SALES) -> DataFrame:
    """Numbers 1 to ``n`` in column ``n``."""
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


def digit_spine(digits: DataFrame, limit: int = SEED_SALES) -> DataFrame:
    """Numbers ``a + 10 b + 100 c + 1`` up to ``limit`` with a, b and c out of ``digits.d`` (0 to 9).

    The result of crossing the ten-row set with itself twice, made by three semi joins on the digit.
    """
    if limit > 1000:
        raise ValueError("three digits make 1000 numbers; use number_spine for more")
    ten = digits.where(F.col("d").between(0, 9)).select(F.col("d").cast("bigint")).distinct()
    spine = digits.sparkSession.range(1000)
    for place in (1, 10, 100):
        digit = F.floor(F.col("id") / place) % 10
        spine = spine.withColumn("d", digit).join(ten, "d", "left_semi").drop("d")
    return spine.select((F.col("id") + 1).alias("n")).where(F.col("n") <= limit)


def seed_products(spark: SparkSession) -> DataFrame:
    rows = [(i, sku, name) for i, (sku, name) in enumerate(SEED_PRODUCTS, start=1)]
    return spark.createDataFrame(rows, PRODUCTS.schema)


def seed_sales(spine: DataFrame, as_of: Column | datetime | str | None = None, seed: int = 0) -> DataFrame:
    """One sale per number ``n`` of the spine, one per day; later rounds of 900 repeat the days."""
    n = F.col("n")
    product = (n % len(SEED_PRICES) + 1).cast("int")
    price = F.when(product == 1, SEED_PRICES[0])
    for i, p in enumerate(SEED_PRICES[1:-1], start=2):
        price = price.when(product == i, p)
    price = price.otherwise(SEED_PRICES[-1]).cast("decimal(10,2)")
    days_back = SEED_FIRST_DAY - ((n - 1) % SEED_SALES + 1)
    second = draw(n, f"second{seed}", SECONDS_PER_DAY)
    back = F.make_dt_interval(days=-days_back, secs=second)
    return spine.select(
        n.cast("bigint").alias("id"),
        product.alias("product_id"),
        (1 + draw(n, f"qty{seed}", SEED_MAX_QTY)).cast("int").alias("qty"),
        price.alias("price"),
        (as_of_column(as_of) + back).alias("sale_ts"),
    )


def products_batch(batches: DataFrame, seed: int = 0) -> DataFrame:
    """Five new products for every row ``(batch_no, ts)`` of ``batches``, a batch or a stream."""
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    rows = batches.select(
        "batch_no", "ts", F.explode(F.sequence(F.lit(1), F.lit(BATCH_PRODUCTS))).alias("i")
    ).withColumn("sku", F.format_string("AUTO-%s-%03d", stamp, F.col("i")))
    cents = draw(F.col("sku"), f"price{seed}", BATCH_MAX_CENTS + 1)
    return rows.select(
        "sku",
        F.format_string("Auto Generated Product %d.%d", F.col("batch_no"), F.col("i")).alias("name"),
        (cents / 100).cast("decimal(10,2)").alias("price"),
        F.col("ts").alias("created_at"),
    )


def products_stream(spark: SparkSession, start: datetime, seed: int = 0) -> DataFrame:
    """The change generator as a stream: a batch of new products per micro-batch, two minutes apart from
    ``start`` (UTC) on. A restarted stream makes the same products again."""
    ticks = spark.readStream.format("rate-micro-batch").options(
        rowsPerBatch=1,
        numPartitions=1,
        startTimestamp=int(start.replace(tzinfo=timezone.utc).timestamp() * 1000),
        advanceMillisPerBatch=BATCH_SECONDS * 1000,
    )
    stamp = F.timestamp_micros(F.unix_micros("timestamp")).cast("timestamp_ntz")
    return products_batch(ticks.load().select((F.col("value") + 1).alias("batch_no"), stamp.alias("ts")), seed)
