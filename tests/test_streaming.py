"""Streams give what the batch gives, also in pieces, restarted, replayed and out of order."""

import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_state import START, as_dict, frame, random_log, replay

from lakerill.operators import LogTable
from lakerill.plans.relations import ACCOUNTS
from lakerill.quality import Rule
from lakerill.sources import read_changes
from lakerill.streaming import (
    THROUGHPUT,
    ClockedScan,
    PeriodicScan,
    ingest_latency,
    last_scan,
    read_metrics,
    read_scans,
    start_ingest,
    start_quality_scan,
    start_throughput,
    stream_id,
    throughput,
)

ONCE = {"availableNow": True}


def write_feed(spark, folder, rows, files, seed=0):
    """The rows, shuffled, in this many files."""
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    for i in range(files):
        frame(spark, rows[i::files]).coalesce(1).write.mode("append").parquet(f"{folder}/feed")


def feed(spark, folder, max_files=1):
    return read_changes(spark, f"{folder}/feed", ACCOUNTS, streaming=True, max_files=max_files)


def run(spark, folder, table, checkpoint="cp", **kw):
    start_ingest(feed(spark, folder), table, f"{folder}/{checkpoint}", ONCE, **kw).awaitTermination()


def test_shuffled_micro_batches_equal_the_replay(spark, folder):
    rows = random_log(300, 20, 51, hot_share=0.3)
    write_feed(spark, folder, rows, 4)
    t = LogTable(spark, f"{folder}/t", ACCOUNTS)
    run(spark, folder, t, metrics=True)
    assert sorted(b.batch_id for b in t.batches()) == [0, 1, 2, 3]
    assert as_dict(t.read()) == replay(rows)
    m = read_metrics(t).agg(F.count("batch_id"), F.sum("n_changes"), F.sum("n_deletes"), F.max("max_seq")).first()
    assert tuple(m) == (4, 300, sum(r[0] == "d" for r in rows), 299)
    waits = ingest_latency(t).collect()
    assert len(waits) == 4 and all(w.latency_seconds > 0 for w in waits)  # events of long ago


def test_restart_goes_on_and_replay_changes_nothing(spark, folder):
    rows = random_log(200, 20, 53)
    write_feed(spark, folder, rows[:100], 2)
    t = LogTable(spark, f"{folder}/t", ACCOUNTS)
    run(spark, folder, t)
    first = stream_id(spark, f"{folder}/cp")
    write_feed(spark, folder, rows[100:], 2)
    run(spark, folder, t)  # same checkpoint: only the new files
    assert t.log().count() == 200 and {b.writer for b in t.batches()} == {first}
    assert as_dict(t.read()) == replay(rows)
    run(spark, folder, t, "another")  # an empty checkpoint: everything once more, under another name
    assert t.log().count() == 400 and t.log(once=True).count() == 200
    assert as_dict(t.read()) == replay(rows)


def test_failed_batch_is_run_again(spark, folder):
    """A job that dies after writing a batch but before its checkpoint commit writes it again."""
    rows = random_log(100, 10, 57)
    write_feed(spark, folder, rows, 2)
    t = LogTable(spark, f"{folder}/t", ACCOUNTS)

    def die(table, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, folder, t, after_batch=die)
    assert t.log().count() == 100
    run(spark, folder, t)
    assert t.log().count() == 100 and as_dict(t.read()) == replay(rows)


def test_quality_scan_follows_the_growing_table(spark, folder):
    good = [("c", i, START, i, 50.0, "x") for i in range(10)]
    write_feed(spark, folder, good, 1)
    rules = [
        Rule("accounts", "rows", "row_count", comparison=">", threshold=5),
        Rule("accounts", "positive", "invalid_count", "value", {"above": 0}),
    ]
    t, out = LogTable(spark, f"{folder}/t", ACCOUNTS), f"{folder}/scans"

    def go():
        start_quality_scan(feed(spark, folder), t, rules, out, f"{folder}/cp", ONCE, every_seconds=0).awaitTermination()

    go()
    assert {(r.check_name, r.value, r.passed) for r in last_scan(spark, out).collect()} == {
        ("rows", 10.0, True), ("positive", 0.0, True),
    }
    write_feed(spark, folder, [("u", 20, START, 3, -15.0, "bad"), ("d", 21, START, 4, None, None)], 1)
    go()
    assert {(r.check_name, r.value, r.passed) for r in last_scan(spark, out).collect()} == {
        ("rows", 9.0, True), ("positive", 1.0, False),
    }
    assert read_scans(spark, out).count() == 4
    assert read_scans(spark, out).where("scan_ts is null").count() == 0


def test_scans_keep_their_distance(spark, folder):
    write_feed(spark, folder, random_log(40, 5, 59), 3)
    t, out = LogTable(spark, f"{folder}/t", ACCOUNTS), f"{folder}/scans"
    rules = [Rule("accounts", "rows", "row_count", comparison=">")]
    scan = PeriodicScan(rules, out, every_seconds=3600)
    run(spark, folder, t, after_batch=scan)
    assert [r.scan for r in read_scans(spark, out).collect()] == [0]
    scan.finish(t)
    assert sorted(r.scan for r in read_scans(spark, out).collect()) == [0, 2]
    assert last_scan(spark, out).first().value == t.read().count()


def test_compaction_while_ingesting(spark, folder):
    rows = random_log(300, 30, 67)
    write_feed(spark, folder, rows, 5)
    t = LogTable(spark, f"{folder}/t", ACCOUNTS)
    run(spark, folder, t, after_batch=lambda table, n: table.compact() if n % 2 else None)  # as a job beside it would
    everything = t._listed()
    base, rest = t._parts(everything, everything)
    assert base.version == 1 and len(rest) == 1
    assert as_dict(t.read()) == replay(rows)


def windows(rows):
    counts = {}
    for r in rows:
        start = r[2] - timedelta(minutes=r[2].minute % 5, seconds=r[2].second)
        counts[start] = counts.get(start, 0) + 1
    return counts


def test_throughput_table_is_right_after_shuffled_batches(spark, folder):
    rows = [("c", i, START + timedelta(seconds=37 * i), i, 1.0, "x") for i in range(200)]
    write_feed(spark, folder, rows, 3)
    t = LogTable(spark, f"{folder}/t", THROUGHPUT)
    start_throughput(feed(spark, folder), t, f"{folder}/cp", ONCE).awaitTermination()
    assert {r.window_start: r.n_records for r in t.read().collect()} == windows(rows)
    assert {r.window_start: r.n_records for r in throughput(frame(spark, rows)).collect()} == windows(rows)


def test_throughput_in_append_mode_holds_open_windows_back(spark, folder):
    rows = [("c", i, START + timedelta(seconds=60 * i), i, 1.0, "x") for i in range(60)]
    write_feed(spark, folder, rows, 1)
    counts = throughput(feed(spark, folder), lateness="10 minutes")
    q = counts.writeStream.format("memory").queryName("closed").trigger(**ONCE).start()
    q.awaitTermination()
    got = {r.window_start: r.n_records for r in spark.table("closed").collect()}
    want = windows(rows)
    assert got and all(want[w] == n for w, n in got.items()) and len(got) < len(want)


def test_stream_dedup(spark, folder):
    from lakerill.operators import dedup

    rows = random_log(50, 5, 61)
    write_feed(spark, folder, rows + rows, 1)
    q = dedup(feed(spark, folder), ["k"]).writeStream.format("memory").queryName("once").trigger(**ONCE).start()
    q.awaitTermination()
    assert spark.table("once").count() == 50


def test_stream_dedup_keeps_late_changes(spark, folder):
    from lakerill.operators import dedup

    late = [("c", 1, START + timedelta(days=2), 1, 1.0, "x")], [("c", 2, START, 2, 1.0, "y"), ("c", 1, START + timedelta(days=2), 1, 1.0, "x")]
    for i, rows in enumerate(late):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/feed")
        q = dedup(feed(spark, folder), ["k"]).writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp")
        q.trigger(**ONCE).start(f"{folder}/out").awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2]


def test_a_feed_that_stops_is_scanned_on_and_side_tables_grow(spark, folder):
    """The clock goes on without commits; every scan reads all tables anew."""
    t = LogTable(spark, f"{folder}/t", ACCOUNTS).create()
    side = LogTable(spark, f"{folder}/side", ACCOUNTS).create()
    t.append_batch(frame(spark, [("c", 1, START, 1, 1.0, "x")]), 0)
    side.append_batch(frame(spark, [("c", 1, START, 1, 1.0, "x")]), 0)
    rules = [
        Rule("accounts", "fresh", "row_count", comparison=">", filter="ts >= now() - interval '1' hour"),
        Rule("side", "rows", "row_count", comparison=">", threshold=1),
    ]
    clock = iter([START, START + timedelta(hours=2), START + timedelta(hours=3)])
    out = f"{folder}/scans"

    def scans():
        try:
            return {r.scan for r in read_scans(spark, out).collect()}
        except Exception:
            return set()

    tables = {"accounts": lambda: t.log(), "side": side}
    scan = ClockedScan(spark, tables, rules, out, every_seconds=4, as_of=lambda: next(clock, START + timedelta(days=1))).start()
    for n in (1, 2):
        deadline = time.monotonic() + 60
        while len(scans()) < n and time.monotonic() < deadline:
            time.sleep(0.2)
        side.append_batch(frame(spark, [("c", 1, START, 2, 1.0, "x")]), 1)
    scan.stop()
    got = {(r.scan, r.check_name): (r.value, r.passed) for r in read_scans(spark, out).collect()}
    assert got[0, "fresh"] == (1.0, True) and got[1, "fresh"] == (0.0, False)
    assert got[0, "rows"] == (1.0, False) and got[max(s for s, _ in got), "rows"] == (2.0, True)


def test_a_throughput_table_has_one_stream(spark, folder):
    rows = [("c", i, START + timedelta(seconds=37 * i), i, 1.0, "x") for i in range(20)]
    write_feed(spark, folder, rows, 1)
    t = LogTable(spark, f"{folder}/t", THROUGHPUT)
    start_throughput(feed(spark, folder), t, f"{folder}/cp", ONCE).awaitTermination()
    with pytest.raises(Exception, match="another stream"):
        start_throughput(feed(spark, folder), t, f"{folder}/cp2", ONCE).awaitTermination()
    assert {r.window_start: r.n_records for r in t.read().collect()} == windows(rows)
