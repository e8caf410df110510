"""Suite: scans, filters and sales analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..quality import SKU_FORMAT
from ..functions import end_anchored
from ..sources import read_table, scan
from . import analytics
from .relations import products, sales, with_relations


def _money(df, *columns):
    """Decimals as doubles, for comparison with other engines."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


QUERIES = {
    "sales_and_revenue_by_product": lambda s, d: analytics.sales_and_revenue_by_product(sales(s, d), products(s, d)),
    "scan_products": lambda s, d: scan(products(s, d), ["id", "sku", "name"]),
    "scan_sales": lambda s, d: _money(scan(sales(s, d)), "price"),
    "lookup_sku": lambda s, d: _money(analytics.lookup_sku(products(s, d), "P-042"), "price"),
    "filter_nonpositive_price": lambda s, d: _money(scan(sales(s, d), where=F.col("price") <= 0), "price"),
    "filter_nonpositive_balance": lambda s, d: scan(
        read_table(s, d, "customer"), ["c_custkey", "c_acctbal"], F.col("c_acctbal") <= 0
    ),
    "invalid_sku_rows": lambda s, d: scan(
        products(s, d), ["sku", "name"], ~F.col("sku").rlike(end_anchored(SKU_FORMAT))
    ),
    "first_products": lambda s, d: _money(analytics.first_products(products(s, d)), "price"),
    "recent_sales_topk": lambda s, d: _money(analytics.recent_sales(sales(s, d)), "price"),
    "total_counts": lambda s, d: analytics.total_counts(sales(s, d), products(s, d)),
    "sales_count_by_product_id": lambda s, d: analytics.sales_count_by_product_id(sales(s, d)),
    "sales_count_by_product_name": lambda s, d: analytics.sales_count_by_product_name(sales(s, d), products(s, d)),
    "revenue_by_product_name": lambda s, d: analytics.revenue_by_product_name(sales(s, d), products(s, d)),
    "top_products": lambda s, d: analytics.top_products(sales(s, d), products(s, d)),
    "daily_sales": lambda s, d: analytics.daily_sales(sales(s, d)),
    "daily_revenue_trend": lambda s, d: analytics.daily_revenue_trend(sales(s, d)),
    "total_units": lambda s, d: analytics.total_units(sales(s, d)),
    "total_price": lambda s, d: analytics.total_price(sales(s, d)),
    "average_order_value": lambda s, d: analytics.average_order_value(sales(s, d)),
    "max_sale_ts": lambda s, d: analytics.max_sale_ts(sales(s, d)),
    "dashboard_tiles": lambda s, d: analytics.dashboard_tiles(sales(s, d)),
}

ORACLE = {
    "sales_and_revenue_by_product": with_relations(
        """select p.name as product_name, count(*) as sales_count, cast(sum(s.qty * s.price) as double) as total_revenue
        from sales s join products p on s.product_id = p.id group by p.name""",
        "products", "sales",
    ),
    "scan_products": with_relations("select id, sku, name from products", "products"),
    "scan_sales": with_relations(
        "select id, product_id, qty, cast(price as double) as price, sale_ts from sales", "sales"
    ),
    "lookup_sku": with_relations(
        "select id, sku, name, cast(price as double) as price from products where sku = 'P-042'", "products"
    ),
    "filter_nonpositive_price": with_relations(
        "select id, product_id, qty, cast(price as double) as price, sale_ts from sales where price <= 0", "sales"
    ),
    "filter_nonpositive_balance": "select c_custkey, c_acctbal from customer where c_acctbal <= 0",
    "invalid_sku_rows": with_relations(
        "select sku, name from products where not regexp_matches(sku, '^P-[0-9]{3}$')", "products"
    ),
    "first_products": with_relations(
        "select id, sku, name, cast(price as double) as price from products order by id, sku, name, price limit 10",
        "products",
    ),
    "recent_sales_topk": with_relations(
        """select product_id, qty, cast(price as double) as price, sale_ts from
        (select * from sales order by sale_ts desc, id, product_id, qty, price limit 10) newest""",
        "sales",
    ),
    "total_counts": with_relations(
        """select 'products' as table_name, count(*) as n_rows from products
        union all select 'sales', count(*) from sales""",
        "products", "sales",
    ),
    "sales_count_by_product_id": with_relations(
        """select product_id, count(*) as sales_count from sales group by product_id
        order by sales_count desc, product_id""",
        "sales",
    ),
    "sales_count_by_product_name": with_relations(
        """select p.name as product_name, count(*) as sales_count
        from sales s join products p on s.product_id = p.id group by p.name""",
        "products", "sales",
    ),
    "revenue_by_product_name": with_relations(
        """select p.name as product_name, cast(sum(s.qty * s.price) as double) as total_revenue
        from sales s join products p on s.product_id = p.id group by p.name""",
        "products", "sales",
    ),
    "top_products": with_relations(
        """select p.name as product_name, count(*) as sales_count, cast(sum(s.qty * s.price) as double) as total_revenue
        from sales s join products p on s.product_id = p.id group by p.name
        order by sum(s.qty * s.price) desc, p.name limit 5""",
        "products", "sales",
    ),
    "daily_sales": with_relations(
        "select cast(sale_ts as date) as sale_date, count(*) as daily_sales from sales group by 1", "sales"
    ),
    "daily_revenue_trend": with_relations(
        """with days as (select cast(sale_ts as date) as sale_date, sum(qty * price) as revenue from sales group by 1)
        select sale_date, cast(revenue as double) as revenue,
            cast(sum(cast(revenue as decimal(38,2))) over (order by sale_date) as double) as running_revenue
        from days""",
        "sales",
    ),
    "total_units": with_relations("select cast(sum(qty) as bigint) as total_units from sales", "sales"),
    "total_price": with_relations("select cast(sum(price) as double) as total_price from sales", "sales"),
    "average_order_value": with_relations(
        "select cast(sum(price * qty) as double) / count(price * qty) as average_order_value from sales", "sales"
    ),
    "max_sale_ts": with_relations("select max(sale_ts) as max_sale_ts from sales", "sales"),
    "dashboard_tiles": with_relations(
        """select product_id, cast(grouping(product_id) as integer) as is_total, count(*) as sales_count,
            cast(sum(qty) as bigint) as total_units, cast(sum(price) as double) as total_price
        from sales group by grouping sets ((product_id), ())""",
        "sales",
    ),
}
