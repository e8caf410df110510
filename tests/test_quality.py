"""Quality rules on small tables with one bad row per check."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from lakerill.functions import end_anchored
from lakerill.quality import (
    MONITOR_RULES,
    TABLE_RULES,
    QualityGateError,
    Rule,
    failing_rows,
    gate,
    load_rules,
    missing_profile,
    report,
    score_of_scans,
    score_over_time,
    split,
    summary,
)
from lakerill.sources import number_spine, seed_products, seed_sales
from lakerill.specs import PRODUCTS, SALES

NOW = datetime(2024, 6, 1, 12)


def sale(i, product_id=1, qty=5, price="29.99", ts=NOW):
    return (i, product_id, qty, None if price is None else Decimal(price), ts)


@pytest.fixture(scope="module")
def seeded(spark):
    return {
        "products": seed_products(spark).cache(),
        "sales": seed_sales(number_spine(spark), NOW).cache(),
    }


def plus(spark, tables, products=(), sales=()):
    out = dict(tables)
    if products:
        out["products"] = out["products"].unionByName(spark.createDataFrame(list(products), PRODUCTS.schema))
    if sales:
        out["sales"] = out["sales"].unionByName(spark.createDataFrame(list(sales), SALES.schema))
    return out


def failed(df):
    return sorted(r.check_name for r in df.where("not passed").collect())


def test_seed_alone_is_not_fresh(seeded):
    found = report(seeded, MONITOR_RULES, NOW)
    assert found.count() == 12
    assert failed(found) == ["Recent sales (24h)"]
    one = summary(found).first()
    assert (one.total, one.passed, one.failed, one.failed_checks) == (12, 11, 1, "sales: Recent sales (24h)")
    assert one.verdict == "1 checks FAILED"


def test_valid_rows_make_everything_pass(spark, seeded):
    tables = plus(spark, seeded, [(999, "P-999", "Test Product")], [sale(1001, 1, 10, "99.99")])
    found = report(tables, MONITOR_RULES, NOW)
    assert failed(found) == []
    assert summary(found).first().verdict == "All data quality checks PASSED"
    gate(found)


@pytest.mark.parametrize(
    "products,sales,check",
    [
        ([], [sale(1, 2, 3, "-15.00")], "Non-positive prices"),
        ([], [sale(1, 2, 3, "0.00")], "Non-positive prices"),
        ([], [sale(1, 2, 0)], "Non-positive quantities"),
        ([], [sale(1, 2, 101)], "Excessive quantities"),
        ([], [sale(1, 2, None)], "Null quantities"),
        ([], [sale(1, 2, 2, None)], "Null prices"),
        ([(50, "INVALID-SKU", "Test Product")], [], "Invalid SKU format"),
        ([(50, "P-TEST", "Test Product")], [], "Invalid SKU format"),
        ([(50, "AUTO-20240101000000-001", "x")], [], "Invalid SKU format"),
        ([(50, "P-001\n", "x")], [], "Invalid SKU format"),
        ([(None, "P-050", "x")], [], "Null IDs"),
        ([(50, "P-001", "x")], [], "Duplicate SKUs"),
    ],
)
def test_each_check_finds_its_row(spark, seeded, products, sales, check):
    tables = plus(spark, seeded, products, [*sales, sale(5000)])
    assert failed(report(tables, MONITOR_RULES, NOW)) == [check]


def test_null_sku_is_missing_and_surplus_but_not_invalid(spark, seeded):
    tables = plus(spark, seeded, [(50, None, "x")], [sale(1)])
    assert failed(report(tables, MONITOR_RULES, NOW)) == ["Duplicate SKUs", "Null SKUs"]


def test_two_meanings_of_duplicates(spark):
    skus = [(i, s, "x") for i, s in enumerate(["a", "a", "a", "b", "b", "c", None, None])]
    rules = [Rule("p", "surplus", "surplus_count", "sku"), Rule("p", "repeated", "duplicate_count", "sku")]
    got = report({"p": spark.createDataFrame(skus, PRODUCTS.schema)}, rules)
    assert {r.check_name: r.value for r in got.collect()} == {"surplus": 5.0, "repeated": 2.0}


def test_table_rules(spark, seeded):
    tables = plus(spark, seeded, sales=[sale(1001)])
    found = report(tables, TABLE_RULES, NOW)
    assert found.count() == 20 and failed(found) == []
    tables = plus(
        spark,
        seeded,
        [(5, "P-005", None)],
        [sale(1, 5, 0, "10000.01", None), sale(2, None, 1, "0.00", NOW), sale(None, 1, 101, "1.00")],
    )
    assert failed(report(tables, TABLE_RULES, NOW)) == sorted(
        [
            "Product name cannot be null",
            "Sale ID cannot be null",
            "Product ID reference cannot be null",
            "Sale timestamp cannot be null",
            "Quantity must be positive",
            "Price must be positive",
            "Quantity should be reasonable (max 100)",
            "Price should be reasonable (max $10,000)",
            "Sale ID must be unique",
            "Product ID must reference valid product",
        ]
    )


def test_references_to_the_parent_table(spark, seeded):
    """A fifth product is no orphan, though it is outside the fixed list of valid values."""
    rule = Rule("sales", "product exists", "orphan_count", "product_id", {"parent": "products", "parent_column": "id"})
    sales = [sale(1, 5), sale(2, None), sale(3, 6), sale(4, 6)]
    tables = plus(spark, seeded, [(5, "P-005", "x")], sales)
    assert report(tables, [rule]).first().value == 2.0


def test_empty_tables(spark):
    tables = {s.name: spark.createDataFrame([], s.schema) for s in (PRODUCTS, SALES)}
    found = report(tables, MONITOR_RULES, NOW)
    assert failed(found) == ["Recent sales (24h)", "Row count", "Row count"]
    average = Rule("sales", "average", "custom", args={"expr": "avg(price * qty)"}, comparison=">", threshold=10.0)
    row = report(tables, [average]).first()
    assert (row.value, row.passed, row.status) == (None, False, "FAIL")


def test_what_cannot_be_answered_is_an_error_and_counts(spark, seeded):
    rules = [
        Rule("sales", "good", "row_count", comparison=">"),
        Rule("sales", "no column", "missing_count", "colour"),
        Rule("sales", "no invalid column", "invalid_count", "colour", {"min": 1}),
        Rule("sales", "bad filter", "row_count", filter="price >> 'x", comparison=">"),
        Rule("sales", "no parent", "orphan_count", "product_id", {"parent": "none", "parent_column": "id"}),
        Rule("nowhere", "no table", "row_count", comparison=">"),
    ]
    found = {r.check_name: r for r in report(seeded, rules, NOW).collect()}
    assert found["good"].status == "PASS"
    assert {n for n, r in found.items() if r.status == "ERROR"} == {r.name for r in rules} - {"good"}
    assert all(not r.passed and r.value is None for r in found.values() if r.status == "ERROR")
    with pytest.raises(QualityGateError) as stopped:
        gate(report(seeded, rules, NOW))
    assert "nowhere: no table" in stopped.value.failed and len(stopped.value.failed) == 5


def test_names_with_quotes(spark, seeded):
    rule = Rule("sales", "it's a \\ \"check\"", "row_count", comparison=">")
    assert report(seeded, [rule]).first().check_name == rule.name


def test_rules_from_yaml(spark, seeded):
    rules = load_rules(
        r"""
checks for products:
  - row_count > 0
  - invalid_count(sku) = 0:
      valid regex: ^P-\d{3}$
      name: sku format
checks for sales:
  - invalid_count(price) = 0:
      valid min: 0.01
      valid max: 40
      name: price range
  - row_count > 0:
      filter: sale_ts >= current_timestamp - interval '24' hour
      name: fresh
  - invalid_count(product_id) = 0:
      valid values: [1, 2]
"""
    )
    assert [r.name for r in rules] == ["row_count > 0", "sku format", "price range", "fresh", "invalid_count(product_id) = 0"]
    values = {r.check_name: r.value for r in report(seeded, rules, NOW).collect()}
    assert values == {
        "row_count > 0": 4.0, "sku format": 0.0, "price range": 225.0, "fresh": 0.0, "invalid_count(product_id) = 0": 450.0,
    }
    with pytest.raises(ValueError):
        load_rules("checks for x:\n  - what is this")


def test_freshness_window_and_boundary(spark, seeded):
    day_old, hour_old = NOW - timedelta(hours=24), NOW - timedelta(hours=1)
    tables = plus(spark, seeded, sales=[sale(1, ts=day_old), sale(2, ts=hour_old), sale(3, ts=day_old - timedelta(seconds=1))])

    def fresh(hours):
        text = f"sale_ts >= current_timestamp - interval '{hours}' hour"
        return report(tables, [Rule("sales", "fresh", "row_count", filter=text, comparison=">")], NOW).first().value

    assert (fresh(24), fresh(1)) == (2.0, 1.0)


def test_custom_metric_with_filter(seeded):
    rule = Rule("sales", "dear", "custom", args={"expr": "min(price)"}, filter="product_id = 4", comparison=">=", threshold=49.99)
    row = report(seeded, [rule]).first()
    assert row.passed and row.value == 49.99


def test_failing_rows_and_split(spark):
    rows = [sale(1, qty=0, price="-1.00"), sale(2), sale(3, qty=None), sale(4, price=None), sale(5, qty=500)]
    df = spark.createDataFrame(rows, SALES.schema)
    got = {r.id: r.failed_rules for r in failing_rows(df, [r for r in MONITOR_RULES if r.table == "sales"]).collect()}
    assert got == {
        1: ["Non-positive quantities", "Non-positive prices"],
        3: ["Null quantities"],
        4: ["Null prices"],
        5: ["Excessive quantities"],
    }
    good, bad = split(df, [r for r in MONITOR_RULES if r.table == "sales"])
    assert sorted(r.id for r in good.collect()) == [2] and sorted(r.id for r in bad.collect()) == [1, 3, 4, 5]


def test_errors_stay_with_their_rule(spark, seeded):
    rules = [
        Rule("sales", "good", "row_count", comparison=">"),
        Rule("products", "good too", "invalid_count", "sku", {"regex": "^P-[0-9]{3}$"}),
        Rule("products", "bad pattern", "invalid_count", "sku", {"regex": "^P-[0-9"}),
        Rule("sales", "no limits", "invalid_count", "qty"),
        Rule("sales", "by zero", "custom", args={"expr": "sum(qty) / (count(id) - count(id))"}),
        Rule("sales", "good custom", "custom", args={"expr": "max(qty) * 1.0"}, comparison=">"),
        Rule("sales", "bad cast", "row_count", filter="cast('x' || id as int) > 0", comparison=">"),
    ]
    found = {r.check_name: r.status for r in report(seeded, rules, NOW).collect()}
    good = {"good", "good too", "good custom"}
    assert found == {r.name: "PASS" if r.name in good else "ERROR" for r in rules}


def test_now_in_literals_and_names(spark):
    df = spark.createDataFrame([("now", 1, NOW), ("current_timestamp", 2, NOW), ("x", 3, NOW)], "text string, now int, t timestamp_ntz")
    cases = {
        "text = 'now'": 1, "text = 'now()'": 0, 'text = "current_timestamp"': 1, "now >= 2": 2, "`now` = 3": 1,
        "t <= now() and text = 'it''s now() '": 0, "t = current_timestamp": 3, "t < CURRENT_TIMESTAMP()": 0, "t = Now ( )": 3,
    }
    rules = [Rule("t", text, "row_count", filter=text) for text in cases]
    assert {r.check_name: r.value for r in report({"t": df}, rules, NOW).collect()} == cases


def test_unknown_details_are_refused():
    with pytest.raises(ValueError, match="valid mim"):
        load_rules("checks for t:\n  - invalid_count(x) = 0:\n      valid mim: 3")


def test_failing_duplicates_orphans_and_times(spark, seeded):
    rows = [sale(1), sale(1, 2), sale(2, 9), sale(None, 1, ts=NOW - timedelta(days=2)), sale(None, 1), sale(3, None)]
    df = spark.createDataFrame(rows, SALES.schema)
    rules = [
        Rule("sales", "unique", "duplicate_count", "id"),
        Rule("sales", "no surplus", "surplus_count", "id"),
        Rule("sales", "product", "orphan_count", "product_id", {"parent": "products", "parent_column": "id"}),
        Rule("sales", "recent product", "missing_count", "product_id", filter="sale_ts >= now() - interval '1' hour"),
        Rule("products", "other table", "missing_count", "sku"),
        Rule("sales", "rows", "row_count", comparison=">"),
    ]
    with pytest.raises(ValueError, match="table"):
        failing_rows(df, rules)
    got = failing_rows(df, rules, "sales", seeded, NOW)
    assert got.columns == [*df.columns, "failed_rules"]
    found = sorted((str(r.id), r.product_id or 0, r.failed_rules) for r in got.collect())
    assert found == [
        ("1", 1, ["unique", "no surplus"]), ("1", 2, ["unique", "no surplus"]), ("2", 9, ["product"]),
        ("3", 0, ["recent product"]), ("None", 1, ["no surplus"]), ("None", 1, ["no surplus"]),
    ]
    good, bad = split(df, rules[:1], tables=seeded)
    assert good.count() == 4 and bad.count() == 2 and good.columns == df.columns
    later = failing_rows(df, rules[3:4], as_of=NOW + timedelta(days=1))
    assert later.count() == 0
    assert failing_rows(df.limit(0), rules, "sales", seeded, NOW).count() == 0
    assert failing_rows(seeded["sales"], MONITOR_RULES, "sales").count() == 0


def test_score_of_scans(spark):
    rows = [(NOW, True), (NOW, False), (NOW + timedelta(hours=1), True), (NOW + timedelta(days=1), False)]
    scans = spark.createDataFrame(rows, "scan_ts timestamp_ntz, passed boolean")
    got = [(r.n_passed, r.n_checks, round(r.score, 3)) for r in score_of_scans(scans).orderBy("period").collect()]
    assert got == [(2, 3, 0.667), (0, 1, 0.0)]


def test_score_over_time(spark):
    rows = [sale(1, ts=NOW), sale(2, qty=0, ts=NOW), sale(3, qty=None, ts=NOW + timedelta(days=1))]
    rules = [r for r in MONITOR_RULES if r.name == "Non-positive quantities"]
    got = score_over_time(spark.createDataFrame(rows, SALES.schema), rules, "sale_ts").orderBy("period").collect()
    assert [(r.ok_rows, r.n_rows, r.score) for r in got] == [(1, 2, 0.5), (1, 1, 1.0)]


def test_missing_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {r.column_name: r.missing for r in missing_profile(df).collect()} == {"a": 1, "b": 2}


def test_end_anchor():
    assert end_anchored("^P$") == r"^P\z"
    assert end_anchored(r"^P\$") == r"^P\$"
    assert end_anchored(r"^P\\$") == r"^P\\\z"
    assert end_anchored("P") == "P"


def test_rule_arguments_are_checked():
    with pytest.raises(ValueError):
        Rule("t", "n", "guess")
    with pytest.raises(ValueError):
        Rule("t", "n", "row_count", comparison="~")
