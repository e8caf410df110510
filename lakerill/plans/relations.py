"""The library's relations on the benchmark tables, as DataFrames and as SQL.

``products`` is ``part``, ``sales`` is ``lineitem``, ``accounts`` changes are ``events``, ``docs`` are the
documents with their labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import read_table, stream_table
from ..specs import BIGINT, DOUBLE, PRODUCTS, SALES, STRING, TableSpec, schema_of

ACCOUNTS = TableSpec("accounts", schema_of(k=BIGINT, value=DOUBLE, props=STRING), ("k",))
#: Sales without a change position: the later sale of an id wins, ties go by the row.
SALES_BY_TIME = TableSpec("sales", SALES.schema, ("id",), ("sale_ts", "product_id", "qty", "price"))

# The operation each kind of event stands for.
EVENT_OPS = {"signup": "c", "error": "d"}


def as_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.format_string("P-%03d", "p_partkey").alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def as_sales(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_shipdate").alias("sale_ts"),
    )


def as_changes(events: DataFrame) -> DataFrame:
    op = F.lit("u")
    for kind, code in EVENT_OPS.items():
        op = F.when(F.col("event_type") == kind, code).otherwise(op)
    return events.select(
        op.alias("op"), F.col("event_id").alias("seq"), "ts", F.col("user_id").alias("k"), "value", "props"
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return as_products(read_table(spark, folder, "part"))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return as_sales(read_table(spark, folder, "lineitem"))


def changes(spark: SparkSession, folder: str) -> DataFrame:
    return as_changes(read_table(spark, folder, "events"))


def change_stream(spark: SparkSession, folder: str) -> DataFrame:
    return as_changes(stream_table(spark, folder, "events"))


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").join(read_table(spark, folder, "labels"), "doc_id", "left")


def product_changes(rows: DataFrame) -> DataFrame:
    """Products as the inserts a snapshot delivers."""
    return rows.select(
        F.lit("c").alias("op"),
        F.col("id").cast("bigint").alias("seq"),
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        *PRODUCTS.columns,
    )


def sales_changes(rows: DataFrame) -> DataFrame:
    """Sales as the inserts a snapshot delivers."""
    return rows.select(
        F.lit("c").alias("op"),
        F.unix_micros(F.col("sale_ts").cast("timestamp")).alias("seq"),
        F.col("sale_ts").alias("ts"),
        *SALES.columns,
    )


SQL = {
    "products": """select cast(p_partkey as integer) as id, printf('P-%03d', p_partkey) as sku, p_name as name,
        cast(p_retailprice as decimal(10,2)) as price from part""",
    "sales": """select l_orderkey * 10 + l_linenumber as id, cast(l_partkey as integer) as product_id,
        cast(l_quantity as integer) as qty, cast(l_extendedprice as decimal(10,2)) as price,
        l_shipdate as sale_ts from lineitem""",
    "chg": """select case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
        event_id as seq, ts, user_id as k, value, props from events""",
    "accounts": """select * from (select *, row_number() over (partition by k order by seq desc) as rn from chg) ranked
        where rn = 1 and op <> 'd'""",
    "docs": "select * from documents left join labels using (doc_id)",
}


def with_relations(query: str, *names: str) -> str:
    """``query`` with the named relations defined in front of it."""
    head = ",\n".join(f"{n} as ({SQL[n]})" for n in names)
    extra = query.lstrip()
    if not names:
        return extra
    if extra.lower().startswith("with "):
        return f"with {head},\n{extra[5:]}"
    return f"with {head}\n{extra}"
