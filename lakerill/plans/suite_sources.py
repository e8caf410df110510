"""Suite: change feeds, snapshots, catalogs, generators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import LogTable, memory_table
from ..session import new_folder
from ..sources import (
    TABLES,
    assign_ids,
    chunk_bounds,
    chunk_counts,
    digit_spine,
    products_batch,
    read_changes,
    read_table,
    register_tables,
    seed_sales,
)
from ..specs import SALES
from .relations import ACCOUNTS, SALES_BY_TIME, changes, products, sales, sales_changes, with_relations

SNAPSHOT_ROWS = 5000
SEED_AS_OF = "2024-01-01 12:00:00"


def _read_changes(spark, folder):
    feed = new_folder(spark, "feed")
    changes(spark, folder).write.parquet(feed)
    return read_changes(spark, feed, ACCOUNTS)


def _snapshot(spark, folder):
    """The snapshot's chunks: how many, whether they are even, and that they hold every row once."""
    rows = sales(spark, folder)
    chunks = chunk_counts(rows, "id", chunk_bounds(rows, "id", SNAPSHOT_ROWS))
    return chunks.agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n_rows").alias("n_rows"),
        (F.max("n_rows") <= 2 * SNAPSHOT_ROWS).alias("even"),
        F.min("min_key").alias("min_key"),
        F.max("max_key").alias("max_key"),
    )


def _sink(spark, folder):
    table = LogTable(spark, new_folder(spark, "sink"), SALES_BY_TIME).create()
    table.append_batch(sales_changes(sales(spark, folder)), 0)
    return table.log().select(*SALES.columns).withColumn("price", F.col("price").cast("double"))


def _federated(spark, folder):
    """Products of the operational side with what the lake has sold of each."""
    sold = sales(spark, folder).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    stock = products(spark, folder)
    return stock.join(sold, stock.id == sold.product_id, "left").select(
        "id", "sku", F.col("price").cast("double").alias("price"), F.coalesce("n", F.lit(0)).alias("sales_count")
    )


def _catalog_counts(spark, folder):
    register_tables(spark, folder)
    counts = [spark.sql(f"select '{t}' as table_name, count(*) as n_rows from {t}") for t in TABLES]
    return reduce(lambda a, b: a.unionAll(b), counts)


def _memory(spark, folder):
    memory_table(products(spark, folder).select("id", "name"), "products_in_memory")
    return spark.sql("select name, count(*) as n_products, max(id) as last_id from products_in_memory group by name")


def _seed(spark, folder):
    """As many seeded sales as there are orders."""
    spine = read_table(spark, folder, "orders").select((F.col("o_orderkey") + 1).alias("n"))
    return seed_sales(spine, SEED_AS_OF).withColumn("price", F.col("price").cast("double"))


def _spine(spark, folder):
    """The number spine of the last digits found among the sale ids."""
    return digit_spine(sales(spark, folder).select((F.col("id") % 10).alias("d")))


def _ids(spark, folder):
    rows = products(spark, folder)
    last = rows.agg(F.max("id")).scalar()
    return assign_ids(rows.select("sku", "name"), last, ["sku"], "new_id")


def _generated(spark, folder):
    """A batch of new products for every day with orders."""
    day = F.date_trunc("DAY", "o_orderdate").cast("timestamp_ntz")
    days = read_table(spark, folder, "orders").select(day.alias("ts")).distinct()
    numbered = days.withColumn("batch_no", F.datediff("ts", F.lit("1990-01-01")))
    return products_batch(numbered).withColumn("price", F.col("price").cast("double"))


QUERIES = {
    "cdc_read_changes": _read_changes,
    "snapshot_partitioned_read": _snapshot,
    "lake_sink_roundtrip": _sink,
    "federated_join": _federated,
    "tpch_catalog_counts": _catalog_counts,
    "memory_table": _memory,
    "seed_sales": _seed,
    "seed_spine_crossjoin": _spine,
    "assign_ids": _ids,
    "gen_products_batch": _generated,
}


def _draw(key: str, salt: str, bound: int) -> str:
    return f"(cast(cast('0x' || substr(md5({key} || ':{salt}'), 1, 8) as ubigint) as bigint) % {bound})"


_PLACES = " cross join ".join(f"digits as place{p}" for p in (1, 10, 100))

ORACLE = {
    "cdc_read_changes": with_relations("select op, seq, ts, k, value, props from chg", "chg"),
    "snapshot_partitioned_read": with_relations(
        f"""select cast(ceil(count(*) / {SNAPSHOT_ROWS}) as bigint) as n_chunks, count(*) as n_rows, true as even,
            min(id) as min_key, max(id) as max_key from sales""",
        "sales",
    ),
    "lake_sink_roundtrip": with_relations(
        "select id, product_id, qty, cast(price as double) as price, sale_ts from sales", "sales"
    ),
    "federated_join": with_relations(
        """select p.id, p.sku, cast(p.price as double) as price, count(s.product_id) as sales_count
        from products p left join sales s on s.product_id = p.id group by 1, 2, 3""",
        "products", "sales",
    ),
    "tpch_catalog_counts": "\nunion all\n".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in TABLES),
    "memory_table": with_relations(
        "select name, count(*) as n_products, max(id) as last_id from products group by name", "products"
    ),
    "seed_sales": f"""select n as id, cast(n % 4 + 1 as integer) as product_id,
            cast(1 + {_draw("n", "qty0", 4)} as integer) as qty,
            case n % 4 + 1 when 1 then 9.99e0 when 2 then 19.99e0 when 3 then 29.99e0 else 49.99e0 end as price,
            timestamp '{SEED_AS_OF}' - to_days(cast(1095 - ((n - 1) % 900 + 1) as integer))
                + to_seconds({_draw("n", "second0", 86400)}) as sale_ts
        from (select o_orderkey + 1 as n from orders) spine""",
    "seed_spine_crossjoin": with_relations(
        f"""with digits as (select distinct id % 10 as d from sales)
        select place1.d + place10.d * 10 + place100.d * 100 + 1 as n from {_PLACES}
        where place1.d + place10.d * 10 + place100.d * 100 + 1 <= 900""",
        "sales",
    ),
    "assign_ids": with_relations(
        "select (select max(id) from products) + row_number() over (order by sku) as new_id, sku, name from products",
        "products",
    ),
    "gen_products_batch": f"""with batches as (select distinct cast(date_trunc('day', o_orderdate) as timestamp) as ts
            from orders),
        rows as (select ts, i, 'AUTO-' || strftime(ts, '%Y%m%d%H%M%S') || printf('-%03d', i) as sku
            from batches cross join range(1, 6) five(i))
        select sku, 'Auto Generated Product ' || date_diff('day', date '1990-01-01', cast(ts as date)) || '.' || i as name,
            cast(cast({_draw("sku", "price0", 100001)} / 100 as decimal(10,2)) as double) as price, ts as created_at
        from rows""",
}
