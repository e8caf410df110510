"""State kept by increments: images with key changes, quality scans, views, replay removal, closed windows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakerill import LogTable
from lakerill.operators import latest_state
from lakerill.quality import Rule, failing_rows, report
from lakerill.sources import good_changes, parse_images, read_changes, read_images, snapshot_chunks
from lakerill.specs import BIGINT, DOUBLE, PRODUCTS, PRODUCTS_GROWN, SALES, STRING, TableSpec, schema_of
from lakerill.streaming import (
    SALES_VIEW,
    THROUGHPUT,
    IdLedger,
    LateRecords,
    dropped_late,
    end_feed,
    latency_quantiles,
    read_broken,
    read_latency,
    read_scans,
    start_closed_throughput,
    start_image_ingest,
    start_incremental_scan,
    start_ingest,
    start_numbering,
    start_once_ingest,
    start_sales_view,
    start_timed_ingest,
    view_daily,
    view_tiles,
)

SPEC = TableSpec("people", schema_of(k=BIGINT, name=STRING, value=DOUBLE), ("k",))
ONCE = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1)


def record(op, seq, before=None, after=None):
    image = lambda x: None if x is None else dict(zip(("k", "name", "value"), x))
    return json.dumps({"op": op, "seq": seq, "ts": "2024-01-01T00:00:00", "before": image(before), "after": image(after)})


def changes(spark, rows):
    """Rows of op, seq, k, name, value, a minute apart."""
    rows = [(op, seq, T0 + dt.timedelta(minutes=seq or 0), k, name, value) for op, seq, k, name, value in rows]
    return spark.createDataFrame(rows, "op string, seq long, ts timestamp_ntz, k long, name string, value double")


def put(df, folder):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/feed")


def feed(spark, folder, spec=SPEC):
    return read_changes(spark, f"{folder}/feed", spec, streaming=True, max_files=1)


# -- records with images ----------------------------------------------------------------------------


def test_broken_records_have_reasons_and_stop_nothing(spark):
    good = [record("c", 1, None, (1, "a", 1.0)), record("u", 2, (1, "a", 1.0), (1, "b", None)), record("d", 3, (1, "b", None))]
    lines = {
        "not a record": ["{", "", "[1, 2", '{"op": "c", "seq": "x1", "after": {"k": 1}}'],
        "unknown operation": [record("x", 4, None, (1, "a", 1.0)), json.dumps({"seq": 1})],
        "no position": [record("c", None, None, (1, "a", 1.0))],
        "no image": [record("c", 5), record("d", 6, None, (1, "a", 1.0)), record("u", 7, (1, "a", 1.0))],
        "no key": [record("c", 8, None, (None, "a", 1.0)), record("u", 9, (None, "a", 1.0), (1, "a", 1.0))],
        None: [*good, record("r", 10, None, (2, "c", 2.0))],
    }
    rows = [(line, reason) for reason, some in lines.items() for line in some] + [(None, "not a record")]
    parsed = parse_images(spark.createDataFrame(rows, "value string, want string").select("value"), SPEC)
    got = sorted(((r.value, r.reason) for r in parsed.collect()), key=repr)
    assert got == sorted(rows, key=repr)
    assert {r.op for r in parsed.where("reason is null").collect()} == {"c", "u", "d"}


def test_a_changed_key_is_a_delete_and_an_insert(spark, folder):
    lines = [
        [record("c", 1, None, (1, "a", 1.0)), record("c", 2, None, (2, "b", 2.0)), "{"],
        [record("u", 3, (1, "a", 1.0), (7, "a", 1.5)), record("d", 5, (2, "b", 2.0))],
        [record("u", 4, (7, "a", 1.5), (7, "z", 9.0)), "{", "nonsense"],
    ]
    table = LogTable(spark, f"{folder}/table", SPEC)

    def run():
        records = read_images(spark, f"{folder}/feed", SPEC, streaming=True, max_files=1)
        start_image_ingest(records, table, f"{folder}/checkpoint", ONCE).awaitTermination()

    for some in lines[:2]:
        spark.createDataFrame([(x,) for x in some], "value string").coalesce(1).write.mode("append").text(f"{folder}/feed")
    run()
    assert [tuple(r) for r in table.read().collect()] == [(7, "a", 1.5)]
    spark.createDataFrame([(x,) for x in lines[2]], "value string").coalesce(1).write.mode("append").text(f"{folder}/feed")
    run()  # goes on from the checkpoint
    assert [tuple(r) for r in table.read().collect()] == [(7, "z", 9.0)]
    assert [(r.op, r.k) for r in table.log().where("seq = 3").orderBy("op").collect()] == [("c", 7), ("d", 1)]
    broken = read_broken(table)
    assert sorted(r.value for r in broken.collect()) == ["nonsense", "{", "{"]
    assert broken.where("reason <> 'not a record'").count() == 0 and broken.select("batch_id").distinct().count() == 2


def test_good_changes_of_nothing(spark):
    parsed = parse_images(spark.createDataFrame([], "value string"), SPEC)
    assert good_changes(parsed, SPEC).collect() == []


# -- quality by increments ----------------------------------------------------------------------------

RULES = (
    Rule("people", "some", "row_count", comparison=">"),
    Rule("people", "named", "missing_count", "name"),
    Rule("people", "small", "invalid_count", "value", {"max": 5}),
    Rule("people", "small if named", "invalid_count", "value", {"max": 5}, filter="name is not null"),
    Rule("people", "names differ", "duplicate_count", "name"),
    Rule("people", "no surplus", "surplus_count", "name"),
    Rule("people", "values differ", "duplicate_count", "value", filter="k > 2"),
)
BATCHES = [
    [("c", 10, 1, "a", 1.0), ("c", 11, 2, "a", 9.0), ("c", 12, 3, None, 9.0), ("c", 13, 4, "b", None), ("u", 13, 4, "b", None)],
    [("c", 1, 1, "old", 7.0), ("u", 14, 2, "b", 9.0), ("d", 15, 3, None, 9.0), ("c", 16, 5, None, 3.0), ("c", 16, 6, None, 3.0)],
    [("u", 20, 1, "b", 1.0), ("d", 18, 1, None, None), ("c", 19, 3, "c", 3.0), ("d", 2, 9, None, None), ("c", None, 8, "n", 1.0)],
    [("u", 21, 3, "c", 3.0), ("d", 30, 1, None, None), ("d", 30, 2, None, None), ("u", 31, 8, None, 3.0), ("u", 3, 4, "late", 9.0)],
]


def full(spark, rows):
    state = latest_state(changes(spark, rows), ["k"], columns=SPEC.columns)
    return {r.check_name: (r.value, r.passed, r.status) for r in report({"people": state}, RULES).collect()}


def test_every_scan_equals_the_full_report(spark, folder):
    def run():
        start_incremental_scan(feed(spark, folder), SPEC, RULES, f"{folder}/scans", f"{folder}/cp", ONCE).awaitTermination()

    for rows in BATCHES[:2]:
        put(changes(spark, rows), folder)
    run()
    for rows in BATCHES[2:]:  # after a restart
        put(changes(spark, rows), folder)
    run()
    for n in range(len(BATCHES)):
        got = {r.check_name: (r.value, r.passed, r.status) for r in read_scans(spark, f"{folder}/scans").where(f"scan = {n}").collect()}
        assert got == full(spark, [r for rows in BATCHES[: n + 1] for r in rows]), n


def test_rules_that_need_the_whole_table_are_refused(spark, folder):
    put(changes(spark, BATCHES[0]), folder)
    for rule in (
        Rule("people", "sum", "custom", args={"expr": "sum(value)"}),
        Rule("people", "fresh", "row_count", filter="value > 1 and now() > now()"),
        Rule("people", "parent", "orphan_count", "k", {"parent": "x", "parent_column": "k"}),
        Rule("others", "some", "row_count"),
    ):
        with pytest.raises(ValueError):
            start_incremental_scan(feed(spark, folder), SPEC, [rule], f"{folder}/scans", f"{folder}/cp", ONCE)


# -- views ------------------------------------------------------------------------------------------


def sale(op, seq, key, product=None, qty=None, price=None, day=1):
    return op, seq, T0, key, product, qty, price, dt.datetime(2024, 1, day, 12)


def sales(spark, rows):
    schema = "op string, seq long, ts timestamp_ntz, id long, product_id int, qty int, price double, sale_ts timestamp_ntz"
    return spark.createDataFrame(rows, schema).withColumn("price", F.col("price").cast("decimal(10,2)"))


def test_a_view_follows_updates_deletes_and_late_changes(spark, folder):
    view = LogTable(spark, f"{folder}/view", SALES_VIEW)
    batches = [
        [sale("c", 1, 1, 7, 2, 1.10), sale("c", 2, 2, 7, 1, 3.00, 2), sale("c", 3, 3, None, 5, 2.00), sale("c", 9, 4, 8, 1, 0.01)],
        [sale("u", 4, 1, 8, 3, 1.10), sale("d", 5, 2), sale("u", 6, 4, 9, 9, 9.99), sale("c", 7, 5, 7, None, None)],
        [sale("c", 1, 1, 7, 2, 1.10), sale("d", 8, 3), sale("c", 10, 6, 8, -2, 1.00, 3)],
    ]
    for rows in batches:
        put(sales(spark, rows), folder)
    start_sales_view(feed(spark, folder, SALES), SALES, view, f"{folder}/cp", ONCE).awaitTermination()
    day = dt.date(2024, 1, 1)
    want = [(7, day, 1, 0, 0, 0), (8, day, 2, 4, 111, 331), (8, dt.date(2024, 1, 3), 1, -2, 100, -200)]
    assert sorted(tuple(r) for r in view.read().collect()) == want
    tiles = {r.product_id: (r.sales_count, r.total_units, r.total_price) for r in view_tiles(view.read()).collect()}
    assert tiles == {7: (1, 0, 0.0), 8: (3, 2, 2.11), None: (4, 2, 2.11)}
    days = [tuple(r) for r in view_daily(view.read()).collect()]
    assert days == [(day, 3, 3.31, pytest.approx(3.31 / 3)), (dt.date(2024, 1, 3), 1, -2.0, -2.0)]
    # a micro-batch commits the groups it changed, and nothing else
    sizes = view.log().groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [4, 3, 2]
    with pytest.raises(Exception, match="kept by another stream"):
        start_sales_view(feed(spark, folder, SALES), SALES, view, f"{folder}/cp2", ONCE).awaitTermination()


def test_an_empty_feed_makes_an_empty_view(spark, folder):
    view = LogTable(spark, f"{folder}/view", SALES_VIEW)
    put(sales(spark, []), folder)
    start_sales_view(feed(spark, folder, SALES), SALES, view, f"{folder}/cp", ONCE).awaitTermination()
    assert [tuple(r) for r in view_tiles(view.read()).collect()] == []


# -- once, and closed windows -------------------------------------------------------------------------


def test_copies_go_and_what_comes_too_late_is_counted(spark, folder):
    table = LogTable(spark, f"{folder}/table", SPEC)
    seen = LateRecords()
    spark.streams.addListener(seen)
    row = lambda seq: ("c", seq, 1, "a", 1.0)
    batches = [[row(0), row(10), row(10)], [row(10), row(100)], [row(101), row(100)], [row(95), row(0), row(10), row(102)]]
    for rows in batches:
        put(changes(spark, rows), folder)
    query = start_once_ingest(feed(spark, folder), table, f"{folder}/cp", "30 minutes", ONCE)
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.streams.removeListener(seen)
    assert sorted(r.seq for r in table.log().collect()) == [0, 10, 95, 100, 101, 102]
    assert dropped_late(query) == 2 == seen.by_query[str(query.id)]


def test_each_window_is_written_once_and_the_rest_at_the_end(spark, folder):
    table = LogTable(spark, f"{folder}/table", THROUGHPUT)
    spark.createDataFrame([], "event_ts timestamp_ntz").write.parquet(f"{folder}/markers")

    def run():
        stream = start_closed_throughput(feed(spark, folder), table, f"{folder}/cp", f"{folder}/markers", ONCE, "5 minutes")
        stream.awaitTermination()
        return stream

    def windows():
        return sorted((int((r.window_start - T0).total_seconds() // 60), r.n_records) for r in table.log().collect())

    row = lambda seq: ("c", seq, seq, "a", 1.0)
    for minutes in ([0, 1, 6], [4, 7, 21], [22]):
        put(changes(spark, [row(m) for m in minutes]), folder)
    run()
    assert windows() == [(0, 3), (5, 2)]
    put(changes(spark, [row(2), row(23)]), folder)
    late = dropped_late(run())
    assert windows() == [(0, 3), (5, 2)] and late == 1
    end_feed(spark, f"{folder}/markers")
    run()
    assert windows() == [(0, 3), (5, 2), (20, 3)]


# -- columns that come later, ids that go on, latencies ------------------------------------------------


def test_older_batches_have_defaults_and_written_nulls_stay(spark, folder):
    def run(spec):
        table = LogTable(spark, f"{folder}/table", spec)
        start_ingest(feed(spark, folder, spec), table, f"{folder}/cp", ONCE).awaitTermination()
        return table

    narrow = "op string, seq long, ts timestamp_ntz, id int, sku string, name string"
    put(spark.createDataFrame([("c", 1, T0, 1, "P-1", "one"), ("c", 2, T0, 2, "P-2", "two")], narrow), folder)
    assert run(PRODUCTS).read().columns == ["id", "sku", "name"]
    wide = spark.createDataFrame([("u", 3, T0, 2, "P-2", "two", None, T0), ("c", 4, T0, 3, "P-3", "three", 1.5, None)],
                                 narrow + ", price double, created_at timestamp_ntz")
    put(wide.withColumn("price", F.col("price").cast("decimal(10,2)")), folder)
    put(spark.createDataFrame([("c", 5, T0, 4, "P-4", "late and narrow")], narrow), folder)
    table = run(PRODUCTS_GROWN)
    got = {r.id: (r.price if r.price is None else float(r.price), r.created_at) for r in table.read().collect()}
    default = (0.0, dt.datetime(2024, 1, 1))
    assert got == {1: default, 2: (None, T0), 3: (1.5, None), 4: default}
    assert table.log().count() == 5  # the stream went on from its checkpoint


def test_ids_go_on_and_a_batch_run_again_keeps_its_own(spark, folder):
    schema = "v string, w int"
    ledger = IdLedger(f"{folder}/ids", ["w"])
    batches = [[("b", 2), ("a", 1), ("a", 1)], [], [("c", 9), ("d", None)], [("e", 0)]]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]

    def ids():
        return sorted((r.id, r.v) for r in ledger.read(spark, frames[0].schema).collect())

    assert ids() == []
    for i, df in enumerate(frames):
        ledger(df, i)
    want = ids()
    assert [i for i, _ in want] == list(range(1, 7)) and [v for _, v in want[:3]] == ["a", "a", "b"] and want[5] == (6, "e")
    ledger(frames[2], 2)
    ledger(frames[0], 0)
    assert ids() == want


def test_numbering_goes_on_after_a_restart(spark, folder):
    ledger = IdLedger(f"{folder}/ids", ["seq"])

    def run():
        rows = feed(spark, folder).select("seq", "k")
        start_numbering(rows, ledger, f"{folder}/cp", ONCE).awaitTermination()
        return sorted((r.id, r.seq) for r in ledger.read(spark, rows.schema).collect())

    put(changes(spark, [("c", 5, 1, "a", 1.0), ("c", 4, 1, "a", 1.0)]), folder)
    assert run() == [(1, 4), (2, 5)]
    put(changes(spark, [("c", 1, 1, "a", 1.0)]), folder)
    assert run() == [(1, 4), (2, 5), (3, 1)]


def test_latency_quantiles_are_within_a_bucket(spark, folder):
    table = LogTable(spark, f"{folder}/table", SPEC)
    batches = [list(range(0, 100)), list(range(100, 130))]
    for seqs in batches:
        put(changes(spark, [("c", s, s, "a", 1.0) for s in seqs] + [("c", 10_000 + seqs[0], 1, None, None)]), folder)
    clock = lambda n: T0 + dt.timedelta(hours=2 + n)
    start_timed_ingest(feed(spark, folder), table, f"{folder}/cp", ONCE, clock).awaitTermination()
    notes = read_latency(table)
    got = {r.batch_id: r for r in latency_quantiles(notes).collect()}
    for n, seqs in enumerate(batches):
        late = sorted([max(0, (120 + 60 * n - s) * 60_000) for s in seqs] + [0])  # the one from the future counts as none
        assert got[n].n_changes == len(late)
        for q, found in ((0.5, got[n].p50_ms), (0.95, got[n].p95_ms)):
            exact = late[-(-int(len(late) * q * 100) // 100) - 1]
            assert found <= exact * 1.01 and found >= exact * 0.87
    assert latency_quantiles(notes, []).first().n_changes == 132


def test_values_of_a_table(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "v int")
    listed = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    rule = Rule("rows", "listed", "invalid_count", "v", {"values_table": "listed", "values_column": "x"})
    found = report({"rows": rows, "listed": listed}, [rule]).first()
    assert (found.value, found.status) == (1.0, "FAIL")
    assert [r.v for r in failing_rows(rows, [rule], tables={"listed": listed}).collect()] == [9]
    mixed = Rule("rows", "both", "invalid_count", "v", {"values_table": "listed", "values_column": "x", "min": 0})
    with pytest.raises(ValueError):
        report({"rows": rows, "listed": listed}, [mixed])


def test_ten_thousand_chunks_are_searched_by_halving(spark):
    bounds = [i * i for i in range(1, 10_001)]
    df = spark.range(0, 100_010_000, 9973).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,), (1,), (0,), (100_000_000,)], "k long"))
    got = {r.k: r.chunk for r in snapshot_chunks(df, "k", bounds).collect()}
    assert got[None] == 0 and all(c == int(k**0.5 + 1e-9) for k, c in got.items() if k is not None)
    plan = snapshot_chunks(df, "k", bounds)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction") < 10  # one constant, not an expression per bound
    for few in ([], [5], [5, 7]):
        assert sorted((r.k, r.chunk) for r in snapshot_chunks(spark.range(10).toDF("k"), "k", few).collect()) == [
            (k, sum(b <= k for b in few)) for k in range(10)
        ]


def test_rows_are_marked_by_one_join(spark):
    wide = spark.range(2000).selectExpr("id", "id % 700 as a", "id % 90 as b", "if(id % 5 = 0, null, id % 11) as c", "repeat('x', 50) as payload")
    parents = spark.createDataFrame([(i,) for i in range(9)], "p long")
    rules = [
        Rule("t", "a once", "duplicate_count", "a", filter="b < 50"),
        Rule("t", "b once", "surplus_count", "b", filter="a = 3"),
        Rule("t", "c once", "surplus_count", "c", filter="id < 40"),
        Rule("t", "c known", "orphan_count", "c", {"parent": "p", "parent_column": "p"}),
        Rule("t", "a small", "invalid_count", "a", {"max": 650}),
    ]
    found = failing_rows(wide, rules, "t", {"p": parents})
    rows = wide.collect()
    chosen = {"a once": ("a", lambda r: r.b < 50), "b once": ("b", lambda r: r.a == 3), "c once": ("c", lambda r: r.id < 40)}
    counts = {name: [getattr(r, c) for r in rows if test(r)] for name, (c, test) in chosen.items()}
    want = {}
    for r in rows:
        names = [n for n, (c, test) in chosen.items() if test(r) and counts[n].count(getattr(r, c)) > 1]
        names += ["c known"] * (r.c is not None and r.c > 8) + ["a small"] * (r.a > 650)
        if names:
            want[r.id] = names
    assert {r.id: r.failed_rules for r in found.collect()} == want
    # the wide column is joined once
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join" in line]
    assert len(joins) == 5 and sum("payload" in line and "Join" not in line and "Aggregate" not in line for line in plan[joins[1] :]) <= 1
