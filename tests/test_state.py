"""Change log operators against a replay in plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerill.operators import (
    before_after,
    changelog_kinds,
    dedup,
    latest_by_window,
    latest_state,
    merge,
    net_changes,
    op_counts,
    reconcile,
)
from lakerill.functions import hot_keys
from lakerill.plans.relations import ACCOUNTS
from lakerill.sources import flatten_images
from lakerill.sources.changes import image_schema
from lakerill.specs import PRODUCTS

START = datetime(2024, 1, 1)


def random_log(n, keys, seed, hot_share=0.0):
    """``n`` changes; a third of them or so may belong to key 0."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        k = 0 if rng.random() < hot_share else rng.randrange(keys)
        op = rng.choice("cuud")
        rows.append((op, seq, START + timedelta(seconds=seq), k, float(rng.randrange(100)), f"p{seq}"))
    return rows


def frame(spark, rows, shuffle_seed=None):
    rows = list(rows)
    if shuffle_seed is not None:
        random.Random(shuffle_seed).shuffle(rows)
    return spark.createDataFrame(rows, ACCOUNTS.change_schema)


def replay(rows):
    state = {}
    for op, seq, ts, k, value, props in sorted(rows, key=lambda r: r[1]):
        if op == "d":
            state.pop(k, None)
        else:
            state[k] = (value, props)
    return state


def as_dict(df):
    return {r.k: (r.value, r.props) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_state_equals_replay(spark, seed):
    rows = random_log(400, 30, seed)
    log = frame(spark, rows, seed)
    want = replay(rows)
    assert as_dict(latest_state(log, ["k"])) == want
    assert as_dict(latest_by_window(log, ["k"], [F.desc("seq")])) == want


def test_latest_state_of_fixed_width_rows_hashes(spark):
    rows = random_log(300, 20, 5)
    log = frame(spark, rows, 5).drop("props")
    want = {k: v[0] for k, v in replay(rows).items()}
    state = latest_state(log, ["k"])
    assert {r.k: r.value for r in state.collect()} == want
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_latest_state_carries_null_values(spark):
    log = spark.createDataFrame(
        [("c", 1, START, 1, 5.0, "a"), ("u", 2, START, 1, None, None)], ACCOUNTS.change_schema
    )
    assert as_dict(latest_state(log, ["k"])) == {1: (None, None)}
    assert [r.value for r in latest_state(log.drop("props"), ["k"]).collect()] == [None]


def test_latest_state_keeps_deletes_on_request(spark):
    rows = [("c", 1, START, 1, 1.0, "a"), ("d", 2, START, 1, None, None), ("c", 1, START, 2, 2.0, "b")]
    state = latest_state(frame(spark, rows), ["k"], keep_deletes=True)
    assert {(r.k, r.op) for r in state.collect()} == {(1, "d"), (2, "c")}


def test_replayed_changes_count_once(spark):
    rows = random_log(200, 10, 7)
    twice = frame(spark, rows + rows, 7)
    assert dedup(twice, ["k"]).count() == 200
    assert as_dict(latest_state(twice, ["k"])) == replay(rows)


@pytest.mark.parametrize("at", [0, 57, 199])
def test_reconcile_snapshot_and_log(spark, at):
    rows = random_log(200, 25, 11)
    snapshot = [(k, *v) for k, v in replay(r for r in rows if r[1] <= at).items()]
    snap = spark.createDataFrame(snapshot, "k bigint, value double, props string")
    overlapping = frame(spark, [r for r in rows if r[1] >= at // 2], 3)
    assert as_dict(reconcile(snap, overlapping, ["k"], at)) == replay(rows)


def images_by_hand(rows):
    out, state = {}, {}
    for op, seq, ts, k, value, props in sorted(rows, key=lambda r: r[1]):
        before = state.get(k)
        after = None if op == "d" else (value, props)
        out[seq] = (k, op, before, after)
        if after is None:
            state.pop(k, None)
        else:
            state[k] = after
    return out


def pair(row):
    return None if row is None else (row.value, row.props)


@pytest.mark.parametrize("hot_rows", [1_000_000, 40, 3, 1])
def test_before_after_in_slices(spark, hot_rows):
    """Cutting hot keys into slices changes nothing, however small the slices."""
    rows = random_log(600, 15, 13, hot_share=0.4)
    got = before_after(frame(spark, rows, 13), ["k"], ["value", "props"], hot_rows=hot_rows)
    found = {r.seq: (r.k, r.op, pair(r.before), pair(r.after)) for r in got.collect()}
    assert found == images_by_hand(rows)


def test_before_after_with_gaps_and_null_keys(spark):
    """Slices follow the span of a key's positions, which may be sparse; NULL is a key like others."""
    rows = [("c", 10 ** (i % 9) + i, START, None, float(i), "x") for i in range(60)]
    got = before_after(frame(spark, rows), ["k"], ["value", "props"], hot_rows=5)
    found = {r.seq: pair(r.before) for r in got.collect()}
    assert found == {seq: v[2] for seq, v in images_by_hand(rows).items()}


def test_hot_keys_are_few(spark):
    log = frame(spark, random_log(1000, 50, 17, hot_share=0.34))
    hot = hot_keys(log, ["k"], 100).collect()
    assert [r.k for r in hot] == [0] and hot[0].n > 300


def test_a_burst_is_cut_into_even_slices(spark, monkeypatch):
    """One early change and then a burst: slices go by counts, not by the span of seq."""
    from lakerill.operators import images

    rows = [("c", 0, START, 1, 0.0, "x")] + [("u", 10**12 + i, START, 1, float(i), "x") for i in range(3000)]
    cut = []
    kept = images.materialise
    monkeypatch.setattr(images, "materialise", lambda df, purpose: cut.append(kept(df, purpose)) or cut[-1])
    got = before_after(frame(spark, rows, 3), ["k"], ["value", "props"], hot_rows=300)
    assert {r.seq: pair(r.before) for r in got.collect()} == {s: v[2] for s, v in images_by_hand(rows).items()}
    slices = [r["count"] for r in cut[-1].groupBy("__slice").count().collect()]
    assert len(slices) > 5 and max(slices) <= 600


def test_a_null_order_is_the_oldest(spark):
    rows = [("c", None, START, 1, 1.0, "a"), ("c", None, START, 2, 1.0, "a"), ("u", 5, START, 2, 2.0, "b")]
    log = frame(spark, rows)
    assert as_dict(latest_state(log, ["k"])) == {1: (1.0, "a"), 2: (2.0, "b")}
    assert {r.k: r.value for r in latest_state(log.drop("props"), ["k"]).collect()} == {1: 1.0, 2: 2.0}


def test_merge_keeps_new_keys_without_order(spark):
    schema = "op string, k long, v string, a long, b long"
    base = spark.createDataFrame([("c", 1, "base", 1, 1)], schema)
    tail = spark.createDataFrame([("c", 1, "tail", None, None), ("c", 2, "tail", None, None)], schema)
    assert {r.k: r.v for r in merge(base, tail, ["k"], ["a", "b"]).collect()} == {1: "base", 2: "tail"}


def test_reconcile_with_a_position_per_chunk(spark):
    """Chunks read at different positions: of the log only what came after a key's own chunk counts."""
    rows = random_log(300, 30, 19)
    log = frame(spark, rows).withColumn("position", F.when(F.col("k") < 15, 100).otherwise(200))
    snapshot = latest_state(log.where("seq <= position"), ["k"]).drop("seq")
    assert as_dict(reconcile(snapshot, log.where("seq > position - 50"), ["k"], F.col("position"))) == replay(rows)


@pytest.mark.parametrize("hot_rows", [1_000_000, 10])
def test_changelog_kinds(spark, hot_rows):
    rows = random_log(300, 12, 19, hot_share=0.3)
    got = changelog_kinds(frame(spark, rows, 1), ["k"], ["value"], hot_rows=hot_rows)
    want = []
    for seq, (k, op, before, after) in images_by_hand(rows).items():
        if before and after:
            want += [(k, seq, "-U", before[0]), (k, seq, "+U", after[0])]
        elif after:
            want.append((k, seq, "+I", after[0]))
        elif before:
            want.append((k, seq, "-D", before[0]))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_key_change_is_delete_and_insert(spark):
    old, new = (1, "P-001", "Mini"), (9, "P-001", "Mini")
    records = [
        ("c", 1, START, None, old),
        ("u", 2, START, old, (1, "P-001", "Midi")),
        ("u", 3, START, (1, "P-001", "Midi"), new),
        ("c", 4, START, None, (2, "P-002", "Pro")),
        ("d", 5, START, (2, "P-002", "Pro"), None),
    ]
    flat = flatten_images(spark.createDataFrame(records, image_schema(PRODUCTS)), PRODUCTS)
    assert sorted((r.seq, r.op, r.id) for r in flat.collect()) == [
        (1, "c", 1), (2, "u", 1), (3, "c", 9), (3, "d", 1), (4, "c", 2), (5, "d", 2),
    ]
    assert [(r.id, r.name) for r in latest_state(flat, ["id"]).collect()] == [(9, "Mini")]
    kinds = changelog_kinds(flat, ["id"], ["name"])
    assert sorted((r.seq, r.kind, r.id) for r in kinds.collect() if r.seq == 3) == [(3, "+I", 9), (3, "-D", 1)]


@pytest.mark.parametrize("old,new", [(0, 150), (100, 299), (299, 299)])
def test_net_changes(spark, old, new):
    rows = random_log(300, 40, 23)
    log = frame(spark, rows, 2)
    a, b = (
        {r[3]: r[1] for r in sorted(rows, key=lambda r: r[1]) if r[1] <= upto} for upto in (old, new)
    )
    alive = [{k for k, v in replay(r for r in rows if r[1] <= upto).items()} for upto in (old, new)]
    want = {}
    for k in alive[0] | alive[1]:
        if k not in alive[0]:
            want[k] = "insert"
        elif k not in alive[1]:
            want[k] = "delete"
        elif a[k] != b[k]:
            want[k] = "update"
    got = net_changes(log, ["k"], F.col("seq") <= old, F.col("seq") <= new)
    assert {r.k: r.change for r in got.collect()} == want


def test_op_counts(spark):
    rows = random_log(100, 5, 29)
    got = {r.op: r.n_changes for r in op_counts(frame(spark, rows)).collect()}
    assert got == {op: sum(r[0] == op for r in rows) for op in {r[0] for r in rows}}


def test_composite_key_and_order(spark):
    schema = T.StructType.fromDDL("a int, b int, at int, tie int, v string")
    log = spark.createDataFrame([(1, 1, 5, 1, "old"), (1, 1, 5, 2, "new"), (1, 2, 1, 1, "other")], schema)
    got = latest_state(log, ["a", "b"], ("at", "tie"), op=None)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 5, 2, "new"), (1, 2, 1, 1, "other")]
    assert got.columns == ["a", "b", "at", "tie", "v"]
