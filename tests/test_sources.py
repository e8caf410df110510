"""Feeds, snapshots, generators, surrogate keys."""

import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lakerill import session
from lakerill.functions import align, draw, to_millis
from lakerill.plans.relations import ACCOUNTS
from lakerill.sources import (
    assign_ids,
    chunk_bounds,
    chunk_counts,
    chunk_predicates,
    digit_spine,
    key_range,
    number_spine,
    products_batch,
    products_stream,
    read_changes,
    read_table,
    register_tables,
    scan,
    seed_products,
    seed_sales,
    snapshot_options,
    stream_table,
)
from lakerill.specs import PRODUCTS_WIDE, SALES

NOW = datetime(2024, 6, 1, 12)


def test_seed_sales(spark):
    sales = seed_sales(number_spine(spark), NOW)
    rows = {r.id: r for r in sales.collect()}
    assert len(rows) == 900 and sales.schema.fieldNames() == SALES.columns
    assert [f.dataType for f in sales.schema] == [f.dataType for f in SALES.schema]
    prices = {1: "9.99", 2: "19.99", 3: "29.99", 4: "49.99"}
    for n, r in rows.items():
        assert r.product_id == n % 4 + 1 and r.price == Decimal(prices[r.product_id]) and 1 <= r.qty <= 4
    assert {r.qty for r in rows.values()} == {1, 2, 3, 4}
    age = {n: (NOW - r.sale_ts).total_seconds() / 86400 for n, r in rows.items()}
    assert all(1095 - n - 1 < age[n] <= 1095 - n for n in rows)  # day n plus less than a day
    assert [r.sku for r in seed_products(spark).orderBy("id").collect()] == ["P-001", "P-002", "P-003", "P-004"]


def test_generated_rows_do_not_depend_on_partitions(spark):
    a = seed_sales(number_spine(spark).repartition(7), NOW, seed=3)
    b = seed_sales(number_spine(spark).coalesce(1), NOW, seed=3)
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(seed_sales(number_spine(spark), NOW, seed=4)).count() > 0


def test_draws_cover_their_range(spark):
    got = [r[0] for r in spark.range(2000).select(draw(F.col("id"), "x", 10)).collect()]
    assert set(got) == set(range(10)) and max(got.count(i) for i in range(10)) < 300


def test_digit_spine(spark):
    all_digits = spark.range(40).select((F.col("id") % 10).alias("d"))
    assert sorted(r.n for r in digit_spine(all_digits).collect()) == list(range(1, 901))
    some = spark.createDataFrame([(0,), (2,)], "d int")
    assert sorted(r.n for r in digit_spine(some).collect()) == [1, 3, 21, 23, 201, 203, 221, 223]


def test_products_batch(spark):
    batches = spark.createDataFrame([(7, NOW)], "batch_no int, ts timestamp_ntz")
    rows = products_batch(batches).orderBy("sku").collect()
    assert [r.sku for r in rows] == [f"AUTO-20240601120000-00{i}" for i in range(1, 6)]
    assert rows[0].name == "Auto Generated Product 7.1" and rows[0].created_at == NOW
    assert all(0 <= r.price <= 1000 for r in rows)


def test_products_stream(spark, folder):
    """Five products per micro-batch, two minutes apart, the same after a restart from nothing."""
    seen = []
    for run in ("a", "b"):
        rows = {}

        def keep(batch, batch_id):
            rows[batch_id] = sorted(tuple(r) for r in batch.collect())

        stream = products_stream(spark, NOW).writeStream.foreachBatch(keep)
        q = stream.option("checkpointLocation", f"{folder}/{run}").trigger(processingTime="0 seconds").start()
        while len(rows) < 3:
            assert q.exception() is None
            q.awaitTermination(0.2)
        q.stop()
        seen.append([rows[i] for i in range(3)])
    first = [[(r[0], r[1]) for r in batch] for batch in seen[0]]
    assert all(len(batch) == 5 for batch in first)
    assert first[0][0] == ("AUTO-20240601120000-001", "Auto Generated Product 1.1")
    assert first[1][4] == ("AUTO-20240601120200-005", "Auto Generated Product 2.5")
    assert seen[0] == seen[1]


@pytest.mark.parametrize("order", [[], ["v"], ["v", "w"]])
def test_assign_ids_without_gaps(spark, order):
    """Dense, unique, in order; two thirds of the rows are identical."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"), F.lit("x").alias("w")
    ).repartition(5)
    got = assign_ids(df, 100, order).collect()
    assert sorted(r.id for r in got) == list(range(101, 3101))
    if order:
        by_id = [r.v for r in sorted(got, key=lambda r: r.id)]
        assert by_id == sorted(by_id)


def test_assign_ids_splits_a_hot_value(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("v"))
    parts = (
        df.withColumn("p", F.monotonically_increasing_id())
        .repartitionByRange(8, "v", "p")
        .groupBy(F.spark_partition_id())
        .count()
    )
    assert parts.count() > 1
    assert assign_ids(df, 0, ["v"]).agg(F.max("id")).first()[0] == 200_000


def test_snapshot_chunks_cover_every_row_once(spark):
    df = spark.range(10, 107).unionAll(spark.createDataFrame([(None,), (5000,)], "id long"))
    bounds = chunk_bounds(df, "id", 13)
    chunks = chunk_counts(df, "id", bounds).orderBy("chunk").collect()
    assert [r.chunk for r in chunks] == list(range(len(bounds) + 1)) and sum(r.n_rows for r in chunks) == 99
    parts = [df.where(p).count() for p in chunk_predicates("id", bounds)]
    assert parts == [r.n_rows for r in chunks]
    assert chunk_bounds(df, "id") == [] and chunk_predicates("id", []) == ["(1 = 1) or id is null"]
    assert key_range(df, "id") == (10, 5000)
    assert key_range(df.where("id < 0"), "id") is None


def test_chunks_of_clustered_keys_are_even(spark):
    df = spark.range(1000).unionAll(spark.range(10**9, 10**9 + 9000))
    counts = [r.n_rows for r in chunk_counts(df, "id", chunk_bounds(df, "id", 1000)).collect()]
    assert len(counts) == 10 and max(counts) < 1500


def test_a_spine_of_three_digits_is_no_longer(spark):
    with pytest.raises(ValueError):
        digit_spine(spark.range(10).toDF("d"), 5000)


def test_a_new_column_shows(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t.parquet")
    assert read_table(spark, folder, "t").columns == ["id"]
    spark.range(3).withColumn("v", F.lit(1)).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert read_table(spark, folder, "t").columns == ["id", "v"]


def test_snapshot_options():
    options = snapshot_options("jdbc:x", "sales", "id", (1, 900), 4)
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("id", "1", "901")
    assert options["numPartitions"] == "4" and options["dbtable"] == "sales"


def test_json_change_feed(spark, folder):
    records = [
        {"op": "c", "seq": 1, "ts": "2024-01-01 00:00:00.123456", "k": 1, "value": 2.5, "props": "{}"},
        {"op": "d", "seq": 2, "ts": "2024-01-01 00:00:01", "k": 1},
    ]
    with open(f"{folder}/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in records))
    got = read_changes(spark, folder, ACCOUNTS, fmt="json").orderBy("seq").collect()
    assert [(r.op, r.k, r.value) for r in got] == [("c", 1, 2.5), ("d", 1, None)]
    assert got[0].ts == datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_align_types(spark):
    raw = spark.createDataFrame(
        [("1", "P-001", "Mini", 12.5, datetime(2024, 1, 1, 0, 0, 0, 999_999))],
        "id string, sku string, name string, price double, created_at timestamp_ntz",
    )
    got = align(raw, PRODUCTS_WIDE)
    assert [f.dataType for f in got.schema] == [f.dataType for f in PRODUCTS_WIDE.schema]
    row = got.first()
    assert row.price == Decimal("12.50") and row.created_at == datetime(2024, 1, 1, 0, 0, 0, 999_000)
    assert align(raw.drop("price"), PRODUCTS_WIDE).first().price is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_milliseconds_in_any_time_zone(spark, zone):
    """Also at an hour that a change of clocks leaves out."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = ["2024-03-10 02:30:00.123999", "2024-01-01 00:00:59.999999", "1960-05-05 05:05:05.000001"]
        df = spark.createDataFrame([(t,) for t in text], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        got = df.select(to_millis(F.col("t")).cast("string")).collect()
        assert [r[0] for r in got] == ["2024-03-10 02:30:00.123", "2024-01-01 00:00:59.999", "1960-05-05 05:05:05"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_register_tables_and_scan(spark):
    tables = register_tables(spark, SMALL)
    assert spark.sql("select count(*) from nation join region on n_regionkey = r_regionkey").first()[0] == 25
    got = scan(tables["customer"], ["c_custkey"], F.col("c_acctbal") > 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(c_acctbal,0.0)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan


def test_stream_takes_a_table_of_one_file(spark):
    assert stream_table(spark, SMALL, "events").isStreaming


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.new_folder(spark, "x"), session.new_folder(spark, "x")
    assert a.startswith(root) and a != b


def test_folders_are_cleared(spark, monkeypatch):
    from lakerill import session

    monkeypatch.setattr(session, "_made", [])
    df = session.materialise(spark.range(5), "gone")
    assert df.count() == 5
    path = session._made[0].removeprefix("file:")
    assert os.path.exists(path)
    assert session.clear_folders(spark) == 1 and not os.path.exists(path) and session._made == []
