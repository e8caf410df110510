"""State of a stream's batches in lake tables: large and small batches, folding, batches that run again, odd keys."""

import datetime as dt

import pytest
from test_increments import ONCE, RULES, SPEC, changes, feed, full, put, sale, sales

from lakerill import LogTable
from lakerill.specs import SALES
from lakerill.streaming import SALES_VIEW, read_scans, retract, row_changes, start_incremental_scan, start_sales_view, view_daily, view_tiles

SOLD = [
    [sale("c", 1, 1, 7, 2, 1.10), sale("c", 2, 2, 7, 1, 3.00, 2), sale("c", 3, None, None, 5, 2.00), sale("c", 9, 4, 8, 1, 0.01)],
    [sale("u", 4, 1, 8, 3, 1.10), sale("d", 5, 2), sale("u", 6, 4, 9, 9, 9.99), sale("c", 7, 5, 7, None, None)],
    [sale("c", 1, 1, 7, 2, 1.10), sale("d", 8, None), sale("c", 10, 6, 8, -2, 1.00, 3)],
    [sale("u", 11, 6, 8, 1, 1.00, 3), sale("c", 12, 2, 7, 4, 1.00, 2)],
]


def plan_of(query):
    return query._jsq.explainInternal(True)


def view_after(spark, folder, batches):
    view = LogTable(spark, f"{folder}/view", SALES_VIEW)
    for rows in batches:
        put(sales(spark, rows), folder)
    query = start_sales_view(feed(spark, folder, SALES), SALES, view, f"{folder}/cp", ONCE)
    query.awaitTermination()
    return view, query


@pytest.mark.parametrize("few, fold_after", [(0, 32), (100_000, 1), (0, 1)])
def test_daily_revenue_of_large_batches_and_folded_states(spark, folder, monkeypatch, few, fold_after):
    monkeypatch.setattr(retract, "FEW", few)
    monkeypatch.setattr(retract, "FOLD_AFTER", fold_after)
    view, query = view_after(spark, folder, SOLD)
    # no row and no group of the feed goes through a Python function
    assert not [w for w in ("InPandas", "InArrow", "Python") if w in plan_of(query)]
    day = lambda n: dt.date(2024, 1, n)
    want = [(day(1), 3, 3.31), (day(2), 1, 4.0), (day(3), 1, 1.0)]
    assert [(r.sale_date, r.daily_sales, r.revenue) for r in view_daily(view.read()).collect()] == want
    assert [r["count"] for r in view.log().groupBy("batch_id").count().orderBy("batch_id").collect()] == [4, 3, 2, 2]


def test_a_batch_that_runs_again_shows_the_same(spark, folder):
    schema = changes(spark, []).schema
    state = retract.row_state(spark, f"{folder}/rows", schema, ["k"], ["value"])
    first = changes(spark, [("c", 1, 1, "a", 1.0), ("c", 2, None, "a", 2.0), ("d", 3, 9, None, None)])
    second = changes(spark, [("u", 5, 1, "a", 3.0), ("u", 4, None, "b", 2.0), ("c", 1, 9, "late", 5.0), ("u", 4, 1, "a", 9.0)])
    steps = lambda df, n: sorted((r.weight, r.value) for r in row_changes(df, n, state, ["k"], ["value"]).collect())
    assert steps(first, 0) == [(1, 1.0), (1, 2.0)]
    for _ in range(2):
        assert steps(second, 1) == [(-1, 1.0), (1, 3.0)]
    state.compact()
    assert steps(second, 1) == [(-1, 1.0), (1, 3.0)]
    assert steps(second, 2) == []
    with pytest.raises(ValueError, match="does not hold"):
        steps(second, 4)


def test_keys_are_told_apart_by_microseconds(spark, folder):
    log = spark.range(2).selectExpr("'c' as op", "1L as seq", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.000001) as k", "id as v")
    state = retract.row_state(spark, f"{folder}/rows", log.schema, ["k"], ["v"])
    assert sorted(r.v for r in row_changes(log, 0, state, ["k"], ["v"]).collect()) == [0, 1]
    assert row_changes(log, 1, state, ["k"], ["v"]).collect() == []


def test_tiles_of_folded_states(spark, folder, monkeypatch):
    monkeypatch.setattr(retract, "FOLD_AFTER", 1)
    view, query = view_after(spark, folder, SOLD[:2])
    assert "InPandas" not in plan_of(query)
    view.compact()
    view, _ = view_after(spark, folder, SOLD[2:])  # goes on from its checkpoint, on a view with a base
    tiles = {r.product_id: (r.sales_count, r.total_units, r.total_price) for r in view_tiles(view.read()).collect()}
    assert tiles == {7: (2, 4, 1.0), 8: (3, 5, 2.11), None: (5, 9, 3.11)}


def test_scans_of_large_batches_and_folded_states(spark, folder, monkeypatch):
    monkeypatch.setattr(retract, "FEW", 1)
    monkeypatch.setattr(retract, "FOLD_AFTER", 1)
    batches = [
        [("c", 10, 1, "a", 1.0), ("c", 11, None, "a", 9.0), ("c", 12, 3, None, 9.0), ("c", 13, 4, "b", None)],
        [("u", 14, None, "b", 9.0), ("d", 15, 3, None, 9.0), ("c", 1, 1, "old", 7.0), ("c", 16, 5, None, 3.0)],
        [("u", 20, 1, "b", 1.0), ("c", 19, 3, "c", 3.0), ("c", None, 8, "n", 1.0)],
        [("d", 30, None, None, None), ("u", 31, 8, None, 3.0)],
    ]
    for rows in batches:
        put(changes(spark, rows), folder)
    query = start_incremental_scan(feed(spark, folder), SPEC, RULES, f"{folder}/scans", f"{folder}/cp", ONCE)
    query.awaitTermination()
    assert not [w for w in ("InPandas", "InArrow", "Python") if w in plan_of(query)]
    found = read_scans(spark, f"{folder}/scans").collect()
    for n in range(4):
        got = {r.check_name: (r.value, r.passed, r.status) for r in found if r.scan == n}
        assert got == full(spark, [r for rows in batches[: n + 1] for r in rows]), n


def test_zeros_of_either_sign_are_one_value(spark, folder):
    rows = [("c", 1, 3, "a", 0.0), ("c", 2, 4, "b", -0.0), ("c", 3, 5, "c", 1.0)]
    put(changes(spark, rows), folder)
    start_incremental_scan(feed(spark, folder), SPEC, RULES, f"{folder}/scans", f"{folder}/cp", ONCE).awaitTermination()
    got = {r.check_name: (r.value, r.passed, r.status) for r in read_scans(spark, f"{folder}/scans").collect()}
    assert got == full(spark, rows) and got["values differ"][0] == 1
