"""The physical plans are the ones meant: pruned scans, few shuffles, no single-task detours."""

import re

import pytest
from compare import library_queries
from conftest import SMALL
from pyspark.sql import functions as F
from test_state import frame, random_log

import __spark_entry__ as entry
from lakerill.operators import LogTable, before_after, latest_by_window, latest_state
from lakerill.plans import analytics
from lakerill.plans.relations import ACCOUNTS, products, sales
from lakerill.quality import MONITOR_RULES, report


def plan_of(df, run=False):
    """The physical plan; after a run, the one adaptive execution settled on."""
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name", sorted(n for n in library_queries() if not n.startswith("stream_")))
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas", "DeserializeToObject"):
        assert bad not in plan


def test_revenue_reads_needed_columns_and_adds_up_before_joining(spark):
    plan = plan_of(analytics.sales_and_revenue_by_product(sales(spark, SMALL), products(spark, SMALL)))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    join = plan.index("Join")
    below = plan[join:]
    assert "partial_sum" in below and "Exchange hashpartitioning(product_id" in below


def test_products_beyond_the_broadcast_limit_are_joined_by_shuffle(spark):
    """The join size is Spark's to check; with no broadcasting the answer is the same."""
    want = analytics.sales_and_revenue_by_product(sales(spark, SMALL), products(spark, SMALL)).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = analytics.sales_and_revenue_by_product(sales(spark, SMALL), products(spark, SMALL))
        assert "SortMergeJoin" in plan_of(df) and df.collect() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_topk_sorts_no_table(spark):
    for df in (analytics.recent_sales(sales(spark, SMALL)), analytics.first_products(products(spark, SMALL))):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "Exchange range" not in plan


def test_dashboard_scans_sales_once(spark):
    plan = plan_of(analytics.dashboard_tiles(sales(spark, SMALL)))
    assert plan.count("FileScan") == 1
    assert "FileScan" not in plan[: plan.index("Expand")] and "partial_sum" in plan[plan.index("Expand") :]


def test_report_scans_each_table_once_and_once_per_duplicate_check(spark):
    tables = {"products": products(spark, SMALL), "sales": sales(spark, SMALL)}
    plan = plan_of(report(tables, MONITOR_RULES, "2024-01-01"))
    assert plan.count("FileScan") == 3 and exchanges(plan) == 1
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_latest_state_combines_before_its_only_shuffle(spark):
    log = frame(spark, random_log(50, 5, 1))
    plan = plan_of(latest_state(log, ["k"]))
    assert exchanges(plan) == 1 and "partial_max_by" in plan
    plan = plan_of(latest_by_window(log, ["k"], [F.desc("seq")]))
    assert exchanges(plan) == 1 and plan.count("WindowGroupLimit") == 2


def test_before_images_cost_one_shuffle_where_no_key_is_hot(spark, folder):
    t = LogTable(spark, f"{folder}/t", ACCOUNTS).create()
    t.append_batch(frame(spark, random_log(200, 5, 1)), 0)
    plan = plan_of(before_after(t.log(), ["k"], ["value"]), run=True)
    assert exchanges(plan) == 1 and "Join" not in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("buckets", [5, 8, 20])
def test_base_is_read_without_a_shuffle(spark, folder, buckets):
    t = LogTable(spark, f"{folder}/t", ACCOUNTS).create()
    t.append_batch(frame(spark, random_log(500, 50, 1)), 0)
    t.compact(buckets=buckets)
    t.append_batch(frame(spark, [("u", 1000, random_log(1, 1, 1)[0][2], 3, 1.0, "x")]), 1)
    tree = plan_of(t.read()).splitlines()
    assert any("SortMergeJoin" in line for line in tree)
    for i, line in enumerate(tree):
        if "FileScan" in line and "version=0" in line and "isnull(k" not in line:
            above, depth = [], line.index("FileScan")
            for up in reversed(tree[:i]):  # the operators between this scan and the root
                at = len(up) - len(up.lstrip(" :+-*()0123456789"))
                if at < depth:
                    above.append(up)
                    depth = at
            assert not any("Exchange hashpartitioning" in up for up in above)


def test_time_travel_prunes_batches(spark, folder):
    t = LogTable(spark, f"{folder}/t", ACCOUNTS).create()
    for b in range(4):
        t.append_batch(frame(spark, random_log(20, 5, b)), b)
    assert len(t.log(as_of_batch=1).inputFiles()) * 2 == len(t.log().inputFiles())
    assert "PushedFilters: [Or(IsNull(ts),LessThanOrEqual(ts" in plan_of(
        t.log(as_of_ts=F.lit("2024-01-01 00:00:10").cast("timestamp_ntz"))
    )


def test_filters_on_lake_columns_reach_the_files(spark, folder):
    t = LogTable(spark, f"{folder}/t", ACCOUNTS).create()
    t.append_batch(frame(spark, random_log(20, 5, 1)), 0)
    assert "EqualTo(k,3)" in plan_of(t.read().where("k = 3"))
