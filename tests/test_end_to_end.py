"""The whole way: seed, snapshot, change stream, lake, quality scan, analytics."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lakerill import PRODUCTS, SALES, LogTable
from lakerill.plans import analytics
from lakerill.quality import MONITOR_RULES, failing_rows, gate, report, summary
from lakerill.sources import number_spine, read_changes, seed_products, seed_sales
from lakerill.streaming import start_ingest

NOW = datetime(2024, 6, 1, 12)
ONCE = {"availableNow": True}


class Source:
    """An operational table: what happens to it is written to its change feed."""

    def __init__(self, spark, folder, spec):
        self.spark, self.path, self.spec = spark, f"{folder}/{spec.name}-feed", spec
        self.table = LogTable(spark, f"{folder}/{spec.name}", spec)
        self.checkpoint = f"{folder}/{spec.name}-checkpoint"
        self.seq = 0

    def change(self, op, rows):
        self.seq += 1
        if not hasattr(rows, "write"):
            rows = self.spark.createDataFrame(rows, self.spec.schema)
        meta = {"op": F.lit(op), "seq": F.lit(self.seq).cast("bigint"), "ts": F.lit(str(NOW)).cast("timestamp_ntz")}
        changes = rows.withColumns(meta).select(*self.spec.change_schema.fieldNames())
        changes.coalesce(1).write.mode("append").parquet(self.path)

    def ingest(self):
        stream = read_changes(self.spark, self.path, self.spec, streaming=True, max_files=1)
        return start_ingest(stream, self.table, self.checkpoint, ONCE)


def test_demo(spark, folder):
    products, sales = Source(spark, folder, PRODUCTS), Source(spark, folder, SALES)
    products.change("c", seed_products(spark))
    sales.change("c", seed_sales(number_spine(spark), NOW))

    def sync():
        for job in [products.ingest(), sales.ingest()]:  # two jobs side by side
            job.awaitTermination()
        return {"products": products.table.read(), "sales": sales.table.read()}

    def failed(tables):
        return {r.check_name for r in report(tables, MONITOR_RULES, NOW).where("not passed").collect()}

    lake = sync()
    assert [r.n_rows for r in analytics.total_counts(lake["sales"], lake["products"]).collect()] == [4, 900]
    assert failed(lake) == {"Recent sales (24h)"}

    # new rows arrive and everything passes
    products.change("c", [(999, "P-999", "Test Product")])
    sales.change("c", [(901, 999, 10, Decimal("99.99"), NOW)])
    lake = sync()
    gate(report(lake, MONITOR_RULES, NOW))
    by_name = {r.product_name: r for r in analytics.sales_and_revenue_by_product(lake["sales"], lake["products"]).collect()}
    assert (by_name["Test Product"].sales_count, by_name["Test Product"].total_revenue) == (1, 999.9)
    assert by_name["Widget Mini"].sales_count == 225

    # bad rows are found, listed and traced
    products.change("c", [(1000, "P-TEST", "Test Product")])
    sales.change("c", [(902, 2, 3, Decimal("-15.00"), NOW)])
    lake = sync()
    assert analytics.lookup_sku(lake["products"], "P-TEST").first().id == 1000
    verdict = summary(report(lake, MONITOR_RULES, NOW)).first()
    assert verdict.failed_checks == "products: Invalid SKU format; sales: Non-positive prices"
    rules = [r for r in MONITOR_RULES if r.table == "sales"]
    assert [(r.id, r.failed_rules) for r in failing_rows(lake["sales"], rules).collect()] == [(902, ["Non-positive prices"])]

    # the price is corrected, the product removed
    sales.change("u", [(902, 2, 3, Decimal("15.00"), NOW)])
    products.change("d", [(1000, None, None)])
    assert failed(sync()) == set()
    assert products.table.read(as_of_batch=2).count() == 6 and products.table.read().count() == 5
