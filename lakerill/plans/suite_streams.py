"""Suite: streaming ingest, scans and throughput.

Every stream here takes what the table's folder holds and stops; a continuous job differs by its trigger.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import LogTable, changelog_kinds
from ..quality import Rule
from ..session import new_folder
from ..sources import good_changes, image_schema, read_changes, read_images, read_table, stream_table
from ..specs import BIGINT, DOUBLE, PRODUCTS, PRODUCTS_GROWN, SALES, STRING, TIMESTAMP, TableSpec, schema_of
from ..streaming import (
    SALES_VIEW,
    THROUGHPUT,
    IdLedger,
    PeriodicScan,
    dropped_late,
    end_feed,
    last_scan,
    latency_quantiles,
    read_broken,
    read_latency,
    read_metrics,
    read_scans,
    start_closed_throughput,
    start_image_ingest,
    start_incremental_scan,
    start_ingest,
    start_numbering,
    start_once_ingest,
    start_sales_view,
    start_throughput,
    start_timed_ingest,
    throughput,
    view_daily,
    view_tiles,
)
from .analytics import data_latency
from .relations import (
    ACCOUNTS,
    SALES_BY_TIME,
    as_changes,
    as_products,
    as_sales,
    change_stream,
    changes,
    product_changes,
    sales_changes,
    with_relations,
)
from .suite_quality import _count, _repeated, _result_sql

ONCE = {"availableNow": True}

ACCOUNT_RULES = (
    Rule("accounts", "has accounts", "row_count", comparison=">"),
    Rule("accounts", "key is known", "missing_count", "k"),
    Rule("accounts", "key is unique", "duplicate_count", "k"),
    Rule("accounts", "value above 10", "invalid_count", "value", {"above": 10}),
)


#: Micro-batches a suite's stream takes its feed in.
BATCHES = 4


def _feed(spark, folder, root):
    """The changes as a stream of several files, one to a micro-batch, dealt out of order."""
    rows = as_changes(read_table(spark, folder, "events"))
    rows.repartition(BATCHES, "seq").write.option("maxRecordsPerFile", 0).parquet(f"{root}/feed")
    return read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1)


def _upsert(spark, folder):
    root = new_folder(spark, "upsert")
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    start_ingest(_feed(spark, folder, root), table, f"{root}/checkpoint", ONCE).awaitTermination()
    return table.read()


def _replay(spark, folder):
    """The whole feed ingested by two jobs: every change is in the log twice and counts once."""
    root = new_folder(spark, "replay")
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    feed = _feed(spark, folder, root)
    for job in ("first", "second"):
        start_ingest(feed, table, f"{root}/{job}", ONCE).awaitTermination()
    counted = table.log(once=True).groupBy("k").agg(F.count(F.lit(1)).alias("n_changes"))
    return table.read(columns=["k", "value"]).join(counted, "k")


def _quality(spark, folder):
    root = new_folder(spark, "scan")
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    out = f"{root}/scans"
    scan = PeriodicScan(ACCOUNT_RULES, out)
    stream = _feed(spark, folder, root)
    start_ingest(stream, table, f"{root}/checkpoint", ONCE, after_batch=scan).awaitTermination()
    scan.finish(table)
    return last_scan(spark, out).drop("scan_ts", "scan")


def _observed(spark, folder):
    root = new_folder(spark, "observed")
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    start_ingest(change_stream(spark, folder), table, f"{root}/checkpoint", ONCE, metrics=True).awaitTermination()
    return read_metrics(table).agg(
        F.sum("n_changes").alias("n_changes"),
        F.sum("n_deletes").alias("n_deletes"),
        F.sum("missing_keys").alias("missing_keys"),
        F.min("min_seq").alias("min_seq"),
        F.max("max_seq").alias("max_seq"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def _throughput_stream(spark, folder):
    root = new_folder(spark, "throughput")
    table = LogTable(spark, f"{root}/table", THROUGHPUT)
    start_throughput(stream_table(spark, folder, "events"), table, f"{root}/checkpoint", ONCE).awaitTermination()
    return table.read()


def _two_tables(spark, folder):
    """Products and sales side by side: two jobs of one session, each with its own checkpoint."""
    root = new_folder(spark, "two")
    stock = LogTable(spark, f"{root}/products", PRODUCTS)
    sold = LogTable(spark, f"{root}/sales", SALES_BY_TIME)
    jobs = [
        start_ingest(
            product_changes(as_products(stream_table(spark, folder, "part"))), stock, f"{root}/products-cp", ONCE
        ),
        start_ingest(sales_changes(as_sales(stream_table(spark, folder, "lineitem"))), sold, f"{root}/sales-cp", ONCE),
    ]
    for job in jobs:
        job.awaitTermination()

    def measured(df, name, amount):
        totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).cast("bigint").alias("total"))
        return totals.select(F.lit(name).alias("table_name"), "n_rows", "total")

    by_name = measured(stock.read(columns=["id"]), "products", "id")
    return by_name.unionAll(measured(sold.read(columns=["id", "qty"]), "sales", "qty"))


def _latency(spark, folder):
    log = changes(spark, folder)
    return data_latency(log, as_of=log.agg(F.max("ts")).scalar(), by="op")


#: Users whose account changes its key now and then, in the feed with images.
PEOPLE = TableSpec("people", schema_of(k=BIGINT, value=DOUBLE, props=STRING, at=TIMESTAMP), ("k",))
_MOVE = 100_000


def _image_lines(spark, folder):
    """The events as JSON records with the images before and after, some of them broken.

    Every seventh purchase moves its user to another key. A delete of an absent row leaves no record. Besides the good records
    there are torn ones, some without a position, without an image, with an unknown operation and without a key.
    """
    log = as_changes(read_table(spark, folder, "events"))
    moves = ((F.col("op") == "u") & (F.col("seq") % 7 == 0)).cast("bigint")
    of_user = Window.partitionBy("k").orderBy("seq")
    moved = F.sum(moves).over(of_user)
    rows = log.withColumn("own", F.col("k") + _MOVE * moved)
    image = F.struct(F.col("own").alias("k"), "value", "props", F.col("ts").alias("at"))
    rows = rows.withColumn("after", F.when(F.col("op") != "d", image))
    rows = rows.withColumn("before", F.lag("after").over(of_user)).where("before is not null or after is not null")
    record = F.struct("op", "seq", "ts", "before", "after")
    kept = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    line = F.to_json(record, kept)
    torn = rows.where("seq % 11 = 3").select(F.substring(line, F.lit(1), F.length(line) - 9).alias("value"))
    blank = lambda **changed: F.to_json(F.struct(*(changed.get(c, F.col(c)).alias(c) for c in ("op", "seq", "ts", "before", "after"))), kept)
    unplaced = rows.where("seq % 13 = 5").select(blank(seq=F.lit(None).cast("bigint")).alias("value"))
    unknown = rows.where("seq % 17 = 4").select(blank(op=F.lit("x")).alias("value"))
    gone = F.lit(None).cast(image_schema(PEOPLE)["after"].dataType)
    bare = rows.where("seq % 19 = 1").select(blank(before=gone, after=gone).alias("value"))
    keyless = rows.where("seq % 23 = 2 and op <> 'd'").select(blank(after=F.col("after").withField("k", F.lit(None).cast("bigint"))).alias("value"))
    return rows.select("seq", line.alias("value")), [torn, unplaced, unknown, bare, keyless]


def _image_feed(spark, folder, root):
    good, broken = _image_lines(spark, folder)
    lines = good.select("value")
    for more in broken:
        lines = lines.unionAll(more)
    # a file to a micro-batch, dealt by the text
    lines.repartition(BATCHES, "value").write.text(f"{root}/feed")
    return f"{root}/feed"


def _image_kinds(spark, folder):
    """Row kinds of a feed with images, read as a batch."""
    records = read_images(spark, _image_feed(spark, folder, new_folder(spark, "images")), PEOPLE)
    return changelog_kinds(good_changes(records, PEOPLE), ["k"], ["value", "props", "at"])


def _image_table(spark, folder):
    root = new_folder(spark, "image-feed")
    table = LogTable(spark, f"{root}/table", PEOPLE)
    records = read_images(spark, _image_feed(spark, folder, root), PEOPLE, streaming=True, max_files=1)
    start_image_ingest(records, table, f"{root}/checkpoint", ONCE).awaitTermination()
    return table


def _broken(spark, folder):
    """The broken records that the ingest of a feed with images has put aside."""
    return read_broken(_image_table(spark, folder)).groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"))


#: Rules whose values are kept by increments.
KEPT_RULES = (
    *ACCOUNT_RULES,
    Rule("accounts", "value is spread", "duplicate_count", "value", threshold=10, comparison="<="),
    Rule("accounts", "props differ", "surplus_count", "props", filter="value > 50"),
    Rule("accounts", "few large", "row_count", threshold=100, comparison="<", filter="value > 100"),
)


def _dealt(rows, root, batches):
    """Write rows as files that a stream takes one after the other; ``batches`` are conditions."""
    for condition in batches:
        rows.where(condition).coalesce(1).write.mode("append").parquet(f"{root}/feed")


def _incremental(spark, folder):
    """A report after each of four micro-batches, whose changes are dealt by their position's remainder: all out of order."""
    root = new_folder(spark, "increments")
    _dealt(as_changes(read_table(spark, folder, "events")), root, [F.col("seq") % BATCHES == i for i in range(BATCHES)])
    feed = read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1)
    start_incremental_scan(feed, ACCOUNTS, KEPT_RULES, f"{root}/scans", f"{root}/checkpoint", ONCE).awaitTermination()
    return read_scans(spark, f"{root}/scans").drop("scan_ts")


def _sales_feed(spark, folder, root):
    """Orders as sales: all inserted, every fifth updated to another product, day, amount and price, every seventh
    deleted, every 21st inserted again; out of order."""
    orders = read_table(spark, folder, "orders")
    key, even = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(10,2)")
    sale = [
        key.alias("id"), F.col("o_custkey").cast("int").alias("product_id"), (1 + key % 7).cast("int").alias("qty"), even.alias("price"),
        F.col("o_orderdate").alias("sale_ts"),
    ]
    moved = [
        key.alias("id"), (F.col("o_custkey") % 100).cast("int").alias("product_id"), (2 + key % 7).cast("int").alias("qty"),
        (even + 1).cast("decimal(10,2)").alias("price"), (F.col("o_orderdate") + F.expr("interval 1 day")).alias("sale_ts"),
    ]

    def step(op, place, columns, every=1):
        meta = [F.lit(op).alias("op"), (key * 4 + place).alias("seq"), F.col("o_orderdate").alias("ts")]
        return orders.where(key % every == 0).select(*meta, *columns)

    rows = step("c", 0, sale).unionAll(step("u", 1, moved, 5)).unionAll(step("d", 2, sale, 7)).unionAll(step("c", 3, moved, 21))
    rows.repartition(BATCHES, "seq").write.option("maxRecordsPerFile", 0).parquet(f"{root}/feed")
    return read_changes(spark, f"{root}/feed", SALES, streaming=True, max_files=1)


def _sales_view(spark, folder):
    root = new_folder(spark, "view")
    view = LogTable(spark, f"{root}/view", SALES_VIEW)
    start_sales_view(_sales_feed(spark, folder, root), SALES, view, f"{root}/checkpoint", ONCE).awaitTermination()
    return view.read()


def _quarters(log):
    """Quarters of a log by position, and their last times."""
    quarter = F.floor(F.col("seq") * 4 / (F.lit(log.agg(F.max("seq")).scalar()) + 1))
    times = log.groupBy(quarter.alias("q")).agg(F.unix_micros(F.max("ts").cast("timestamp")).alias("last")).collect()
    return quarter, {r["q"]: r["last"] for r in times}


def _delivered_again(spark, folder):
    """Four batches of a quarter each: each quarter comes again with the next, the first once more with the last, too late.

    The lateness is such that the watermark of the last batch is the first quarter's end.
    """
    root = new_folder(spark, "again")
    log = as_changes(read_table(spark, folder, "events"))
    quarter, last = _quarters(log)
    _dealt(log, root, [quarter == 0, quarter <= 1, quarter.isin(1, 2), quarter.isin(0, 2, 3)])
    lateness = last[1] // 1000 + -last[0] // 1000
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    feed = read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1)
    query = start_once_ingest(feed, table, f"{root}/checkpoint", f"{lateness} milliseconds", ONCE)
    query.awaitTermination()
    return table, query


def _once(spark, folder):
    return _delivered_again(spark, folder)[0].log().select("k", "seq", "op", "ts", "value", "props")


def _once_counts(spark, folder):
    table, query = _delivered_again(spark, folder)
    return table.log().agg(F.count(F.lit(1)).alias("n_kept"), F.lit(dropped_late(query)).cast("bigint").alias("n_late"))


def _closed(spark, folder):
    """Windows closed while the feed runs, and the rest when it has ended, from the log: a window written twice would show."""
    root = new_folder(spark, "closed")
    log = as_changes(read_table(spark, folder, "events"))
    quarter, _ = _quarters(log)
    _dealt(log, root, [quarter == i for i in range(4)])
    spark.createDataFrame([], "event_ts timestamp_ntz").write.parquet(f"{root}/markers")
    table = LogTable(spark, f"{root}/table", THROUGHPUT)

    def run():
        feed = read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1)
        query = start_closed_throughput(feed, table, f"{root}/checkpoint", f"{root}/markers", ONCE, "10 minutes")
        query.awaitTermination()

    run()
    end_feed(spark, f"{root}/markers")
    run()
    return table.log().select("window_start", "window_end", "n_records")


def _grown(spark, folder):
    """Products with three columns at first; then the feed brings five, and the stream goes on from its checkpoint."""
    root = new_folder(spark, "grown")

    def run(spec):
        feed = read_changes(spark, f"{root}/feed", spec, streaming=True, max_files=1)
        table = LogTable(spark, f"{root}/table", spec)
        start_ingest(feed, table, f"{root}/checkpoint", ONCE).awaitTermination()
        return table

    suppliers = read_table(spark, folder, "supplier")
    narrow = suppliers.select(
        F.lit("c").alias("op"), F.col("s_suppkey").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.col("s_suppkey").cast("int").alias("id"), F.format_string("S-%03d", "s_suppkey").alias("sku"), F.col("s_name").alias("name"),
    )
    narrow.coalesce(1).write.mode("append").parquet(f"{root}/feed")
    run(PRODUCTS)
    parts = read_table(spark, folder, "part").where("p_partkey % 3 <> 0")
    key, stamp = F.col("p_partkey"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    wide = parts.select(
        F.lit("u").alias("op"), (key + 1_000_000).cast("bigint").alias("seq"), stamp.alias("ts"), key.cast("int").alias("id"),
        F.format_string("P-%03d", key).alias("sku"), F.col("p_name").alias("name"),
        F.when(key % 5 != 0, F.col("p_retailprice").cast("decimal(10,2)")).alias("price"), stamp.alias("created_at"),
    )
    wide.coalesce(1).write.mode("append").parquet(f"{root}/feed")
    return run(PRODUCTS_GROWN).read().withColumn("price", F.col("price").cast("double"))


def _numbered(spark, folder):
    """Surrogate keys over four batches, the second of which runs again after the last."""
    root = new_folder(spark, "numbered")
    log = as_changes(read_table(spark, folder, "events"))
    quarter, _ = _quarters(log)
    _dealt(log, root, [quarter == i for i in range(4)])
    feed = read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1).select("seq", "k", "op")
    ledger = IdLedger(f"{root}/ids", ["seq"])
    start_numbering(feed, ledger, f"{root}/checkpoint", ONCE).awaitTermination()
    ledger(log.where(quarter == 1).select("seq", "k", "op"), 1)
    return ledger.read(spark, feed.schema).select("id", "seq", "k", "op", "batch_id")


def _latencies(spark, folder):
    """Latency quantiles per batch and (without a number) of all; commits are an hour apart, the first an hour after the newest event."""
    root = new_folder(spark, "latency")
    log = as_changes(read_table(spark, folder, "events"))
    _dealt(log, root, [F.col("seq") % BATCHES == i for i in range(BATCHES)])
    start = log.agg(F.max("ts")).first()[0]
    table = LogTable(spark, f"{root}/table", ACCOUNTS)
    feed = read_changes(spark, f"{root}/feed", ACCOUNTS, streaming=True, max_files=1)
    start_timed_ingest(feed, table, f"{root}/checkpoint", ONCE, lambda n: start + timedelta(hours=n + 1)).awaitTermination()
    notes = read_latency(table)
    whole = latency_quantiles(notes, []).withColumn("batch_id", F.lit(None).cast("bigint"))
    return latency_quantiles(notes).unionByName(whole)


QUERIES = {
    "stream_cdc_upsert": _upsert,
    "stream_replay_idempotent": _replay,
    "stream_quality_scan": _quality,
    "stream_observed_metrics": _observed,
    "throughput_5min": lambda s, d: throughput(changes(s, d)),
    "stream_throughput_5min": _throughput_stream,
    "data_latency": _latency,
    "stream_two_tables": _two_tables,
    "cdc_image_feed": _image_kinds,
    "stream_image_feed": lambda s, d: _image_table(s, d).read(),
    "stream_image_feed_broken": _broken,
    "stream_quality_incremental": _incremental,
    "stream_dashboard_tiles": lambda s, d: view_tiles(_sales_view(s, d)),
    "stream_daily_revenue": lambda s, d: view_daily(_sales_view(s, d)),
    "stream_dedup": _once,
    "stream_dedup_late": _once_counts,
    "stream_throughput_closed": _closed,
    "stream_schema_evolution": _grown,
    "stream_assign_ids": _numbered,
    "stream_latency_quantiles": _latencies,
}

#: Records of the feed with images that are good, and the state they lead to.
_PEOPLE = """with keyed as (
    select *, k + 100000 * sum(case when op = 'u' and seq % 7 = 0 then 1 else 0 end) over (partition by k order by seq) as own
    from chg),
images as (
    select seq, op, own, value, props, ts as "at", lag(op) over w as was, lag(own) over w as own_b, lag(value) over w as value_b,
        lag(props) over w as props_b, lag(ts) over w as at_b
    from keyed window w as (partition by k order by seq)),
records as (select *, coalesce(was <> 'd', false) as had, op <> 'd' as has from images where coalesce(was <> 'd', false) or op <> 'd')"""

_KINDS = f"""{_PEOPLE}
    select cast(own_b as bigint) as k, seq, '-D' as kind, value_b as value, props_b as props, at_b as "at" from records
        where had and (not has or own <> own_b)
    union all select cast(own as bigint), seq, '+I', value, props, "at" from records where has and (not had or own <> own_b)
    union all select cast(own as bigint), seq, '-U', value_b, props_b, at_b from records where had and has and own = own_b
    union all select cast(own as bigint), seq, '+U', value, props, "at" from records where had and has and own = own_b"""


def _scan_sql(number):
    """The report on the changes that the first batches bring."""
    log = f"(select * from chg where seq % {BATCHES} <= {number})"
    state = f"(select * from (select *, row_number() over (partition by k order by seq desc) as rn from {log}) where rn = 1 and op <> 'd')"
    checks = [
        ("has accounts", f"select count(*) from {state}", ">", 0),
        ("key is known", f"select count(*) from {state} where k is null", "=", 0),
        ("key is unique", f"select count(*) from (select k from {state} where k is not null group by k having count(*) > 1)", "=", 0),
        ("value above 10", f"select count(*) from {state} where value <= 10", "=", 0),
        ("value is spread", f"select count(*) from (select value from {state} where value is not null group by value having count(*) > 1)", "<=", 10),
        ("props differ", f"select count(*) - count(distinct props) from {state} where value > 50", "=", 0),
        ("few large", f"select count(*) from {state} where value > 100", "<", 100),
    ]
    rows = " union all ".join(
        f"select '{name}' as check_name, cast(({value}) as double) as value, {limit}.0::double as threshold, ({value}) {sign} {limit} as passed"
        for name, value, sign, limit in checks
    )
    return f"""select 'accounts' as "table", *, case when passed then 'PASS' else 'FAIL' end as status, {number}::bigint as scan from ({rows})"""


_LIVE_SALES = """with live as (
    select case when o_orderkey % 5 = 0 or o_orderkey % 21 = 0 then o_custkey % 100 else o_custkey end::integer as product_id,
        1 + o_orderkey % 7 + case when o_orderkey % 5 = 0 or o_orderkey % 21 = 0 then 1 else 0 end as qty,
        cast(o_totalprice as decimal(10,2)) + case when o_orderkey % 5 = 0 or o_orderkey % 21 = 0 then 1 else 0 end as price,
        cast(o_orderdate as date) + case when o_orderkey % 5 = 0 or o_orderkey % 21 = 0 then 1 else 0 end as day
    from orders where o_orderkey % 7 <> 0 or o_orderkey % 21 = 0)"""

_WINDOWS = """select time_bucket(interval '5 minutes', ts) as window_start,
    time_bucket(interval '5 minutes', ts) + interval '5 minutes' as window_end, count(*) as n_records
    from events group by 1, 2"""

ORACLE = {
    "stream_cdc_upsert": with_relations("select k, value, props from accounts", "chg", "accounts"),
    "stream_replay_idempotent": with_relations(
        """select s.k, s.value, c.n_changes from accounts s
        join (select k, count(*) as n_changes from chg group by k) c on c.k = s.k""",
        "chg", "accounts",
    ),
    "stream_quality_scan": _result_sql(
        [
            ("accounts", "has accounts", _count("accounts"), ">", 0),
            ("accounts", "key is known", _count("accounts", "k is null"), "=", 0),
            ("accounts", "key is unique", _repeated("accounts", "k"), "=", 0),
            ("accounts", "value above 10", _count("accounts", "value <= 10"), "=", 0),
        ],
        "chg", "accounts",
    ),
    "stream_observed_metrics": with_relations(
        """select count(*) as n_changes, count(*) filter (where op = 'd') as n_deletes,
            count(*) filter (where k is null) as missing_keys, min(seq) as min_seq, max(seq) as max_seq,
            min(ts) as first_ts, max(ts) as last_ts from chg""",
        "chg",
    ),
    "throughput_5min": _WINDOWS,
    "stream_throughput_5min": _WINDOWS,
    "data_latency": with_relations(
        """select op, max(ts) as newest,
            (epoch_us((select max(ts) from chg)) - epoch_us(max(ts))) / 1000000 as latency_seconds
        from chg group by op""",
        "chg",
    ),
    "stream_two_tables": with_relations(
        """select 'products' as table_name, count(*) as n_rows, cast(sum(id) as bigint) as total from products
        union all select 'sales', count(*), cast(sum(qty) as bigint) from
        (select *, row_number() over (partition by id order by sale_ts desc, product_id desc, qty desc, price desc) as rn
        from sales) ranked where rn = 1""",
        "products", "sales",
    ),
    "cdc_image_feed": with_relations(_KINDS, "chg"),
    "stream_image_feed": with_relations(
        f"""{_PEOPLE},
        log as (
            select own as k, seq, has, value, props, "at" from records where has
            union all select own_b, seq, false, null, null, null from records where had and (not has or own <> own_b))
        select cast(k as bigint) as k, value, props, cast(date_trunc('millisecond', "at") as timestamp) as "at" from
        (select *, row_number() over (partition by k order by seq desc) as rn from log) where rn = 1 and has""",
        "chg",
    ),
    "stream_image_feed_broken": with_relations(
        f"""{_PEOPLE}
        select * from (
            select 'not a record' as reason, count(*) as n_records from records where seq % 11 = 3
            union all select 'no position', count(*) from records where seq % 13 = 5
            union all select 'unknown operation', count(*) from records where seq % 17 = 4
            union all select 'no image', count(*) from records where seq % 19 = 1
            union all select 'no key', count(*) from records where seq % 23 = 2 and op <> 'd') where n_records > 0""",
        "chg",
    ),
    "stream_quality_incremental": with_relations(" union all ".join(map(_scan_sql, range(BATCHES))), "chg"),
    "stream_dashboard_tiles": f"""{_LIVE_SALES}
        select product_id, cast(grouping(product_id) as integer) as is_total, count(*) as sales_count, cast(sum(qty) as bigint) as total_units,
            cast(sum(price) as double) as total_price
        from live group by grouping sets ((product_id), ())""",
    "stream_daily_revenue": f"""{_LIVE_SALES}
        select day as sale_date, count(*) as daily_sales, cast(sum(qty * price) as double) as revenue,
            cast(sum(qty * price) as double) / count(*) as average_order_value
        from live group by day""",
    "stream_dedup": with_relations(
        "select k, seq, op, cast(date_trunc('millisecond', ts) as timestamp) as ts, value, props from chg", "chg"
    ),
    "stream_dedup_late": with_relations(
        """select count(*) as n_kept, count(*) filter (where seq * 4 // ((select max(seq) from chg) + 1) = 0) as n_late from chg""", "chg"
    ),
    "stream_throughput_closed": _WINDOWS,
    "stream_schema_evolution": """
        with wide as (select cast(p_partkey as integer) as id, printf('P-%03d', p_partkey) as sku, p_name as name,
            case when p_partkey % 5 <> 0 then cast(cast(p_retailprice as decimal(10,2)) as double) end as price,
            timestamp '2024-02-01 00:00:00' as created_at from part where p_partkey % 3 <> 0)
        select * from wide
        union all select cast(s_suppkey as integer), printf('S-%03d', s_suppkey), s_name, 0.0::double, timestamp '2024-01-01 00:00:00'
        from supplier where s_suppkey not in (select id from wide)""",
    "stream_assign_ids": with_relations(
        """select row_number() over (order by seq) as id, seq, k, op, seq * 4 // ((select max(seq) from chg) + 1) as batch_id from chg""",
        "chg",
    ),
    "stream_latency_quantiles": with_relations(
        """with late as (
            select cast(seq % 4 as bigint) as batch_id, epoch_ms((select max(ts) from chg) + to_hours((seq % 4 + 1)::integer)) - epoch_ms(ts) as ms
            from chg),
        held as (select batch_id, ms, greatest(length(bin(ms)) - 4, 0) as rest from late),
        counts as (
            select batch_id, ((ms >> rest) << rest)::bigint as bucket_ms, count(*) as n from held group by 1, 2
            union all select null, ((ms >> rest) << rest)::bigint, count(*) from held group by 2),
        placed as (select *, sum(n) over (partition by batch_id order by bucket_ms) as upto, sum(n) over (partition by batch_id) as total from counts)
        select batch_id, cast(max(total) as bigint) as n_changes, min(bucket_ms) filter (upto >= ceil(total * 0.5)) as p50_ms,
            min(bucket_ms) filter (upto >= ceil(total * 0.95)) as p95_ms, min(bucket_ms) filter (upto >= ceil(total * 0.99)) as p99_ms
        from placed group by batch_id""",
        "chg",
    ),
}
