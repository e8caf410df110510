"""The lake table: commits, retries, time travel, compaction, deletes, schema versions."""

import os
import random
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from test_state import START, as_dict, frame, random_log, replay

from lakerill.operators import LogTable, ctas, cvas, evolve, insert_rows, memory_table
from lakerill.plans.relations import ACCOUNTS
from lakerill.sources import files
from lakerill.specs import BIGINT, PRODUCTS, PRODUCTS_WIDE, STRING, TableSpec, schema_of


def table(spark, folder, **kw):
    return LogTable(spark, f"{folder}/t", ACCOUNTS, **kw).create()


def in_batches(rows, n, seed):
    """Random batches of rows in random order."""
    rng = random.Random(seed)
    parts = [[] for _ in range(n)]
    for r in rows:
        rng.choice(parts).append(r)
    return parts


def test_empty_table(spark, folder):
    t = table(spark, folder)
    assert t.read().count() == 0 and t.read().columns == ["k", "value", "props"]
    assert t.compact() is None
    assert table(spark, folder).read().count() == 0


def test_create_refuses_another_key(spark, folder):
    table(spark, folder)
    with pytest.raises(ValueError):
        LogTable(spark, f"{folder}/t", TableSpec("accounts", ACCOUNTS.schema, ("props",))).create()


def test_out_of_order_batches_and_compaction(spark, folder):
    """Shuffled batches, compacted after every second one, give the state of a replay."""
    rows = random_log(400, 40, 31)
    t = table(spark, folder)
    seen = []
    for i, part in enumerate(in_batches(rows, 6, 31)):
        t.append_batch(frame(spark, part, i), i)
        seen += part
        if i % 2:
            assert t.compact() is not None
        if i in (2, 5):
            assert as_dict(t.read()) == replay(seen)
    assert as_dict(t.read(as_of_batch=3)) == replay(r for p in in_batches(rows, 6, 31)[:4] for r in p)


def test_null_keys_are_keys_like_others(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, [("c", 1, START, None, 1.0, "a"), ("c", 2, START, 5, 1.0, "b")]), 0)
    t.compact()
    t.append_batch(frame(spark, [("u", 3, START, None, 2.0, "c"), ("c", 4, START, 6, 2.0, "d")]), 1)
    want = {None: (2.0, "c"), 5: (1.0, "b"), 6: (2.0, "d")}
    assert as_dict(t.read()) == want and t.read().count() == 3
    t.compact()
    assert as_dict(t.read()) == want and t.read().count() == 3


def test_base_is_one_file_per_bucket_and_opens_in_any_session(spark, folder):
    rows = random_log(500, 100, 47)
    t = table(spark, folder)
    t.append_batch(frame(spark, rows[:300]), 0)
    t.compact(buckets=6)
    t.append_batch(frame(spark, rows[300:]), 1)
    t.compact()
    for version in (0, 1):
        names = os.listdir(f"{folder}/t/base/version={version}")
        assert len([n for n in names if n.endswith(".parquet")]) == 6
    other = LogTable(spark.newSession(), f"{folder}/t", ACCOUNTS)
    assert as_dict(other.read()) == replay(rows)
    spark.sql(f"drop table {t._table_name(t._note(t._versions()[0]).path)}")  # as in a session that has not seen it
    assert as_dict(t.read()) == replay(rows)


def test_late_change_does_not_revive_a_deleted_row(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, [("d", 9, START, 1, None, None), ("c", 8, START, 2, 2.0, "b")]), 0)
    t.compact()
    t.append_batch(frame(spark, [("u", 5, START, 1, 1.0, "late")]), 1)
    assert as_dict(t.read()) == {2: (2.0, "b")}
    # once nothing older can arrive, tombstones may go
    t.compact(drop_deletes_before=F.lit("2030-01-01").cast("timestamp_ntz"))
    assert t.read(keep_deletes=True).count() == 1


def test_retried_batch_replaces_itself(spark, folder):
    t = table(spark, folder)
    rows = random_log(50, 10, 37)
    t.append_batch(frame(spark, rows[:20]), 0)
    t.append_batch(frame(spark, rows), 0)
    assert t.log().count() == 50


def test_writers_do_not_overwrite_each_other(spark, folder):
    t = table(spark, folder)
    rows = random_log(60, 10, 41)
    t.append_batch(frame(spark, rows[:40]), 0, "a")
    t.append_batch(frame(spark, rows[20:]), 0, "b")
    assert t.log().count() == 80 and t.log(once=True).count() == 60
    assert as_dict(t.read()) == replay(rows)
    t.compact()
    t.append_batch(frame(spark, [("u", 99, START, 3, 3.0, "new")]), 0, "c")  # a number the base has seen
    assert as_dict(t.read()) == replay([*rows, ("u", 99, START, 3, 3.0, "new")])


def test_unfinished_batch_is_invisible(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, random_log(10, 3, 1)), 0)
    t.append_batch(frame(spark, random_log(30, 3, 2)), 1)
    (commit,) = files.glob(spark, f"{folder}/t/log/_commits/batch.1@*")
    files.delete(spark, commit)  # as while batch 1 is being written
    assert t.log().count() == 10 and t.read().count() <= 3
    t.append_batch(frame(spark, random_log(20, 3, 2)), 1)
    assert t.log().count() == 30


def test_time_travel(spark, folder):
    rows = random_log(120, 15, 43)
    t = table(spark, folder)
    for b in range(3):
        t.append_batch(frame(spark, rows[b * 40 : b * 40 + 40]), b)
    for b in range(3):
        assert as_dict(t.read(as_of_batch=b)) == replay(rows[: b * 40 + 40])
    t.compact(upto=1)
    for b in range(3):
        assert as_dict(t.read(as_of_batch=b)) == replay(rows[: b * 40 + 40])
    moment = F.lit(str(rows[70][2])).cast("timestamp_ntz")
    assert as_dict(t.read(as_of_ts=moment)) == replay(rows[:71])


def test_delete_by_key_and_predicate(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, [("c", i, START, i, float(i), "x") for i in range(10)]), 0)
    t.delete(spark.createDataFrame([(3,), (4,)], "k bigint"), 100)
    t.delete_where(F.col("value") >= 8, 101)
    assert sorted(as_dict(t.read())) == [0, 1, 2, 5, 6, 7]
    t.append(spark.createDataFrame([(3, 1.5, "back")], ACCOUNTS.schema), "c", 102)
    assert as_dict(t.read())[3] == (1.5, "back")


def test_columns_are_pruned_to_the_files(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, random_log(50, 10, 3)), 0)
    plan = t.read(columns=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan.split("ReadSchema:")[1]


def test_older_schema_reads_as_nulls(spark, folder):
    """Batches written before a column was added are part of the wider table."""
    narrow = LogTable(spark, f"{folder}/p", PRODUCTS).create()
    narrow.append(spark.createDataFrame([(1, "P-001", "Mini")], PRODUCTS.schema), "c", 1)
    wide = LogTable(spark, f"{folder}/p", PRODUCTS_WIDE).create()
    wide.append(
        spark.createDataFrame([(2, "P-002", "Pro")], PRODUCTS.schema).withColumn("price", F.lit("5.00")), "c", 2
    )
    assert {(r.id, None if r.price is None else str(r.price)) for r in wide.read().collect()} == {(1, None), (2, "5.00")}


def test_insert_rows_defaults_and_unknown_columns(spark):
    target = spark.createDataFrame([(1, "a", 1.0)], "id int, name string, price double")
    rows = spark.createDataFrame([("b", 2), (None, 3)], "name string, id int")
    got = insert_rows(target, rows, {"price": F.lit(0.0), "name": F.lit("unnamed")})
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 1.0), (2, "b", 0.0), (3, "unnamed", 0.0)]
    with pytest.raises(ValueError):
        insert_rows(target, rows.withColumn("colour", F.lit("red")))


def test_ctas_cvas_memory_and_evolution(spark, folder):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    assert ctas(df, f"{folder}/c").count() == 5
    with pytest.raises(Exception, match="exist"):
        ctas(df, f"{folder}/c")
    assert cvas(df.where("id > 2"), "few").count() == 2
    cached = memory_table(df, "in_memory")
    assert cached.count() == 5 and spark.catalog.isCached("in_memory")
    df.unpersist()
    both = evolve(df.drop("v"), df)
    assert both.count() == 10 and both.where("v is null").count() == 5


def test_replacing_a_compacted_batch_shows(spark, folder):
    a, b = random_log(80, 10, 71), random_log(80, 10, 72)
    t = table(spark, folder)
    t.append_batch(frame(spark, a), 0)
    t.append_batch(frame(spark, [("u", 900, START, 99, 1.0, "z")]), 1)
    t.compact()
    t.append_batch(frame(spark, b), 0)
    want = replay([*b, ("u", 900, START, 99, 1.0, "z")])
    assert as_dict(t.read()) == want
    t.compact()
    assert as_dict(t.read()) == want


def test_time_travel_with_two_writers(spark, folder):
    """A stream's commits and a delete in between, read as of each of them."""
    rows = random_log(150, 12, 73)
    t = table(spark, folder)
    seen = []
    for i in range(5):
        part = rows[i * 30 : i * 30 + 30]
        t.append_batch(frame(spark, part), i, "feed")
        seen += part
        if i == 3:
            time.sleep(0.02)
            victim = next(k for k in replay(seen) if k != rows[119][3])
            t.delete_where(F.col("k") == victim, 119)
            gone = seen + [("d", 119.5, START, victim, None, None)]
            time.sleep(0.02)
    with pytest.raises(ValueError, match="writer"):
        t.read(as_of_batch=3)
    for compacted in (False, True):
        for i in range(4):
            assert as_dict(t.read(as_of_batch=i, writer="feed")) == replay(rows[: i * 30 + 30])
        assert as_dict(t.read(as_of_batch=0, writer="batch")) == replay(gone)
        commits = {(b.writer, b.batch_id): b.committed for b in t.batches()}
        at = datetime.fromtimestamp(commits["batch", 0] / 1000, timezone.utc)
        assert as_dict(t.read(as_of_commit=at)) == replay(gone)
        at = datetime.fromtimestamp(commits["feed", 3] / 1000, timezone.utc)
        assert as_dict(t.read(as_of_commit=at)) == replay(rows[:120])
        if not compacted:
            t.compact(upto=1)


def test_changes_without_event_time_are_not_lost(spark, folder):
    t = table(spark, folder)
    t.append_batch(frame(spark, [("c", 1, None, 1, 1.0, "a"), ("c", 2, START, 2, 2.0, "b")]), 0)
    assert sorted(as_dict(t.read(as_of_ts=F.lit(str(START)).cast("timestamp_ntz")))) == [1, 2]


def test_orders_that_are_null(spark, folder):
    """A row whose order is NULL is the oldest of its key, in the log, in a base and in what comes after one."""
    spec = TableSpec("pairs", schema_of(k=BIGINT, v=STRING, a=BIGINT, b=BIGINT), ("k",), ("a", "b"))
    t = LogTable(spark, f"{folder}/n", spec).create()
    schema = "op string, seq long, ts timestamp_ntz, k long, v string, a long, b long"
    new = lambda *rows: spark.createDataFrame(rows, schema)
    t.append_batch(new(("c", 1, START, 1, "old", None, None), ("c", 1, START, 2, "old", 1, 1)), 0)
    t.compact()
    t.append_batch(new(("c", 2, START, 3, "new", None, None), ("c", 2, START, 1, "new", 0, None), ("c", 2, START, 2, "new", None, 5)), 1)
    want = {1: "new", 2: "old", 3: "new"}
    for _ in range(2):
        assert {r.k: r.v for r in t.read().collect()} == want
        t.compact()


def test_planning_a_read_of_many_batches(spark, folder):
    """One listing, whatever the number of batches; no job."""
    t = table(spark, folder)
    t.append_batch(frame(spark, random_log(10, 3, 1)), 0)
    for i in range(1, 1000):
        files.write_text(spark, f"{folder}/t/log/_commits/batch.{i}@100", "")
    started = time.perf_counter()
    assert len(t.batches()) == 1000
    t._parts(t._listed(), t.batches())
    assert time.perf_counter() - started < 2
