"""Sales analytics: counts, revenue, days, dashboard tiles.

``sales`` and ``products`` have the columns of :mod:`lakerill.specs`. Money is added up
exactly and turned into doubles at the end, so results do not depend on the order of the tasks. Two revenues exist
and are kept apart: ``sum(qty * price)`` and the dashboard's ``sum(price)``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_of_column, money_again, money_sums, money_total
from ..operators.joins import totals_by_dimension

def _count() -> Column:
    return F.count(F.lit(1)).alias("sales_count")


def _revenue(name: str = "total_revenue") -> list[Column]:
    return money_sums(name, F.col("price"), F.col("qty"))


def sales_count_by_product_id(sales: DataFrame, row_limit: int | None = None) -> DataFrame:
    """Sales per product id, most first; ``row_limit`` is for charts that show so many groups at most."""
    counts = sales.groupBy("product_id").agg(_count()).orderBy(F.desc("sales_count"), F.asc_nulls_last("product_id"))
    return counts if row_limit is None else counts.limit(row_limit)


def _by_name(
    sales: DataFrame, products: DataFrame, sums: list[Column], again: list[Column], measures: dict[str, Column]
) -> DataFrame:
    """Measures per product name, the last one from high to low."""
    totals = totals_by_dimension(sales, products, "product_id", "id", ["name"], sums, again)
    named = totals.select(F.col("name").alias("product_name"), *[m.alias(n) for n, m in measures.items()])
    return named.orderBy(F.desc_nulls_last(list(measures)[-1]), F.asc_nulls_last("product_name"))


def sales_and_revenue_by_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales count and revenue per product name, highest revenue first."""
    again = [F.sum("sales_count").alias("sales_count"), *money_again("total_revenue")]
    measures = {
        "sales_count": F.col("sales_count"),
        "total_revenue": money_total("total_revenue").cast("double"),
    }
    return _by_name(sales, products, [_count(), *_revenue()], again, measures)


def sales_count_by_product_name(sales: DataFrame, products: DataFrame) -> DataFrame:
    again = [F.sum("sales_count").alias("sales_count")]
    return _by_name(sales, products, [_count()], again, {"sales_count": F.col("sales_count")})


def revenue_by_product_name(sales: DataFrame, products: DataFrame) -> DataFrame:
    measures = {"total_revenue": money_total("total_revenue").cast("double")}
    return _by_name(sales, products, _revenue(), money_again("total_revenue"), measures)


def top_products(sales: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` product names of the highest revenue."""
    return sales_and_revenue_by_product(sales, products).limit(k)


def daily_sales(sales: DataFrame) -> DataFrame:
    days = sales.groupBy(F.to_date("sale_ts").alias("sale_date"))
    return days.agg(F.count(F.lit(1)).alias("daily_sales")).orderBy(F.asc_nulls_last("sale_date"))


def daily_revenue_trend(sales: DataFrame) -> DataFrame:
    """Revenue per day and up to that day.

    The running total goes over one row per day, and a calendar of four-digit years has few days.
    """
    days = sales.groupBy(F.to_date("sale_ts").alias("sale_date")).agg(*_revenue("revenue"))
    days = days.select("sale_date", money_total("revenue").alias("revenue"))
    so_far = Window.orderBy(F.asc_nulls_last("sale_date")).rowsBetween(Window.unboundedPreceding, 0)
    return days.select(
        "sale_date",
        F.col("revenue").cast("double").alias("revenue"),
        F.sum("revenue").over(so_far).cast("double").alias("running_revenue"),
    ).orderBy(F.asc_nulls_last("sale_date"))


def total_units(sales: DataFrame) -> DataFrame:
    return sales.agg(F.sum("qty").alias("total_units"))


def total_price(sales: DataFrame) -> DataFrame:
    """The dashboard's revenue tile: the sum of the prices."""
    parts = sales.agg(*money_sums("total_price", F.col("price")))
    return parts.select(money_total("total_price").cast("double").alias("total_price"))


def average_order_value(sales: DataFrame) -> DataFrame:
    parts = sales.agg(*_revenue("value"), F.count(F.col("qty") * F.col("price")).alias("n"))
    return parts.select((money_total("value").cast("double") / F.col("n")).alias("average_order_value"))


def max_sale_ts(sales: DataFrame) -> DataFrame:
    return sales.agg(F.max("sale_ts").alias("max_sale_ts"))


def total_counts(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Row counts of both tables."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")

    return count(products, "products").unionAll(count(sales, "sales"))


def recent_sales(sales: DataFrame, k: int = 10) -> DataFrame:
    """The latest ``k`` sales, ties broken down to the whole row."""
    newest = [F.desc_nulls_last("sale_ts"), *[F.asc_nulls_last(c) for c in ("id", "product_id", "qty", "price")]]
    return sales.orderBy(*newest).limit(k).select("product_id", "qty", "price", "sale_ts")


def first_products(products: DataFrame, k: int = 10) -> DataFrame:
    return products.orderBy(*[F.asc_nulls_last(c) for c in products.columns]).limit(k)


def lookup_sku(products: DataFrame, sku: str) -> DataFrame:
    return products.where(F.col("sku") == sku)


def dashboard_tiles(sales: DataFrame) -> DataFrame:
    """All tiles at once: count, units and price per product id, and the totals in the row without one.

    Grouping sets expand the per-product sums instead of the sales, so sales are read and shuffled once.
    """
    per_product = sales.groupBy("product_id").agg(
        _count(), F.sum("qty").alias("total_units"), *money_sums("total_price", F.col("price"))
    )
    tiles = per_product.groupingSets([["product_id"], []], "product_id").agg(
        F.grouping("product_id").cast("int").alias("is_total"),
        F.coalesce(F.sum("sales_count"), F.lit(0)).alias("sales_count"),
        F.sum("total_units").alias("total_units"),
        *money_again("total_price"),
    )
    price = money_total("total_price").cast("double").alias("total_price")
    return tiles.select("product_id", "is_total", "sales_count", "total_units", price)


def data_latency(
    events: DataFrame, ts: str = "ts", as_of: Column | datetime | str | None = None, by: str | None = None
) -> DataFrame:
    """Seconds from the newest event to ``as_of``, overall or per value of ``by``."""
    newest = events.groupBy(*([by] if by else [])).agg(F.max(ts).alias("newest"))
    moment = as_of_column(as_of).cast("timestamp")
    behind = F.unix_micros(moment) - F.unix_micros(F.col("newest").cast("timestamp"))
    return newest.withColumn("latency_seconds", behind / 1_000_000)
