"""Suite: change logs, lake tables, table definition and row changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import align
from ..operators import (
    LogTable,
    before_after,
    changelog_kinds,
    ctas,
    cvas,
    dedup,
    evolve,
    insert_rows,
    latest_by_window,
    latest_state,
    net_changes,
    op_counts,
    reconcile,
)
from ..session import new_folder
from ..sources import chunk_bounds, read_table, snapshot_chunks
from ..specs import BIGINT, MONEY, PRODUCTS, STRING, TableSpec, schema_of
from .relations import ACCOUNTS, changes, product_changes, products, sales, with_relations

STATE = ["k", "seq", "ts", "value", "props"]
AS_OF = "2024-01-15 00:00:00"


def _last_seq(log):
    return log.agg(F.max("seq")).scalar()


def _lake(spark, purpose, spec=ACCOUNTS) -> LogTable:
    return LogTable(spark, new_folder(spark, purpose), spec).create()


def _latest(spark, folder):
    return latest_state(changes(spark, folder), ["k"]).select(*STATE)


def _latest_window(spark, folder):
    return latest_by_window(changes(spark, folder), ["k"], [F.desc("seq")]).select(*STATE)


def _snapshot_plus_log(spark, folder):
    """A snapshot taken at six tenths of the log, and the log from its half on."""
    log = changes(spark, folder)
    last = _last_seq(log)
    at = F.floor(last * 0.6)
    snapshot = latest_state(log.where(F.col("seq") <= at), ["k"]).drop("seq")
    return reconcile(snapshot, log.where(F.col("seq") >= F.floor(last * 0.5)), ["k"], at).select("k", "ts", "value", "props")


def _before_after(spark, folder):
    images = before_after(changes(spark, folder), ["k"], ["value", "props"])
    return images.select(
        "k",
        "seq",
        "op",
        F.col("before.value").alias("value_before"),
        F.col("before.props").alias("props_before"),
        F.col("after.value").alias("value_after"),
        F.col("after.props").alias("props_after"),
    )


def _delivered_twice(spark, folder):
    log = changes(spark, folder)
    return dedup(log.unionAll(log), ["k"])


def _net_changes(spark, folder):
    log = changes(spark, folder)
    return net_changes(log, ["k"], F.col("seq") <= F.floor(_last_seq(log) / 2))


def _aligned(spark, folder):
    spec = TableSpec("payments", schema_of(k=BIGINT, value=MONEY, props=STRING), ("k",))
    rows = align(changes(spark, folder), spec)
    return rows.select("op", "seq", "ts", "k", F.col("value").cast("double").alias("value"), "props")


def _out_of_order(spark, folder):
    """The newer half of the log arrives before the older half."""
    log = changes(spark, folder)
    half = F.floor(_last_seq(log) / 2)
    table = _lake(spark, "out-of-order")
    table.append_batch(log.where(F.col("seq") > half), 0)
    table.append_batch(log.where(F.col("seq") <= half), 1)
    return latest_state(table.log(), ["k"], columns=["k", "value", "props"])


def _upsert(spark, folder):
    order = ("sale_ts", "product_id", "qty", "price")
    newest = latest_state(sales(spark, folder), ["id"], order, op=None)
    return newest.withColumn("price", F.col("price").cast("double"))


def _deleted(spark, folder):
    log = changes(spark, folder)
    table = _lake(spark, "delete")
    table.append_batch(log, 0)
    table.delete_where(F.col("value") > 50, _last_seq(log) + 1)
    return table.read()


def _created(spark, folder):
    """Creating a table twice, before and after its first rows, loses nothing."""
    root = new_folder(spark, "create")
    LogTable(spark, root, PRODUCTS).create().append_batch(product_changes(products(spark, folder)), 0)
    return LogTable(spark, root, PRODUCTS).create().read()


def _inserted(spark, folder):
    wide = products(spark, folder).withColumn("created_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.format_string("S-%03d", "s_suppkey").alias("sku"),
        F.col("s_name").alias("name"),
    )
    defaults = {"price": F.lit("0.00"), "created_at": F.lit(AS_OF).cast("timestamp_ntz")}
    return insert_rows(wide, rows, defaults).withColumn("price", F.col("price").cast("double"))


def _ctas(spark, folder):
    totals = sales(spark, folder).groupBy("product_id").agg(
        F.sum("qty").alias("units"), F.sum("price").cast("double").alias("price")
    )
    return ctas(totals, new_folder(spark, "ctas"))


def _cvas(spark, folder):
    large = sales(spark, folder).where(F.col("price") > 50000)
    cvas(large, "large_sales")
    return spark.sql("select product_id, count(*) as n_large from large_sales group by product_id")


def _evolved(spark, folder):
    narrow = read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"),
        F.format_string("S-%03d", "s_suppkey").alias("sku"),
        F.col("s_name").alias("name"),
    )
    return evolve(narrow, products(spark, folder)).withColumn("price", F.col("price").cast("double"))


def _as_of_time(spark, folder):
    table = _lake(spark, "as-of")
    table.append_batch(changes(spark, folder), 0)
    return table.read(as_of_ts=F.lit(AS_OF).cast("timestamp_ntz"))


def _as_of_batch(spark, folder):
    """Four commits; the newest changes by key among those of the first three."""
    log = changes(spark, folder)
    quarter = F.floor(F.col("seq") * 4 / (_last_seq(log) + 1))
    table = _lake(spark, "batches")
    for batch in range(4):
        table.append_batch(log.where(quarter == batch), batch)
    return latest_state(table.log(as_of_batch=2), ["k"], columns=ACCOUNTS.columns)


def _chunk_positions(spark, folder):
    """Snapshot chunks read one after the other while the log goes on, each as of its own position."""
    log = changes(spark, folder)
    last = _last_seq(log)
    bounds = chunk_bounds(log, "k", 1 + log.count() // 8)
    placed = snapshot_chunks(log, "k", bounds)
    position = F.floor(last * (F.col("chunk") + 2) / F.lit(len(bounds) + 3))
    placed = placed.withColumn("position", position)
    snapshot = latest_state(placed.where(F.col("seq") <= F.col("position")), ["k"]).drop("seq")
    overlap = placed.where(F.col("seq") > F.col("position") - 100)
    return reconcile(snapshot, overlap, ["k"], F.col("position")).select("k", "ts", "value", "props")


def _two_writers(spark, folder):
    """Four commits of a feed, then a delete by another writer, then the last one; read as of the delete and as of the feed."""
    log = changes(spark, folder)
    last = _last_seq(log)
    part = F.floor(F.col("seq") * 5 / (last + 1))
    table = _lake(spark, "writers")
    for batch in range(4):
        table.append_batch(log.where(part == batch), batch, "feed")
    table.delete_where(F.col("value") > 50, F.floor(last * 4 / 5))
    table.append_batch(log.where(part == 4), 4, "feed")

    def state(version, **as_of):
        return latest_state(table.log(**as_of), ["k"], columns=ACCOUNTS.columns).withColumn("version", F.lit(version))

    before = state("before the delete", as_of_batch=3, writer="feed")
    return before.unionAll(state("after the delete", as_of_batch=0, writer="batch")).unionAll(state("now"))


QUERIES = {
    "cdc_latest": _latest,
    "cdc_latest_window": _latest_window,
    "cdc_snapshot_plus_log": _snapshot_plus_log,
    "cdc_snapshot_chunks": _chunk_positions,
    "cdc_before_after": _before_after,
    "cdc_changelog_kinds": lambda s, d: changelog_kinds(changes(s, d), ["k"], ["value", "props"]),
    "cdc_dedup": _delivered_twice,
    "cdc_net_changes": _net_changes,
    "cdc_op_counts": lambda s, d: op_counts(changes(s, d)),
    "cdc_align_types": _aligned,
    "cdc_out_of_order": _out_of_order,
    "upsert_latest": _upsert,
    "delete_rows": _deleted,
    "create_empty_table": _created,
    "insert_rows": _inserted,
    "ctas_roundtrip": _ctas,
    "cvas_view": _cvas,
    "schema_evolution": _evolved,
    "time_travel_as_of": _as_of_time,
    "time_travel_batch": _as_of_batch,
    "time_travel_two_writers": _two_writers,
}


def _latest_sql(columns: str, where: str = "true") -> str:
    return with_relations(
        f"""select {columns} from (select *, row_number() over (partition by k order by seq desc) as rn
        from chg where {where}) ranked where rn = 1 and op <> 'd'""",
        "chg",
    )


_IMAGES = """select k, seq, op,
    case when lag(op) over w <> 'd' then lag(value) over w end as value_before,
    case when lag(op) over w <> 'd' then lag(props) over w end as props_before,
    case when op <> 'd' then value end as value_after,
    case when op <> 'd' then props end as props_after,
    coalesce(lag(op) over w <> 'd', false) as had
    from chg window w as (partition by k order by seq)"""

_NARROW = "select cast(s_suppkey as integer) as id, printf('S-%03d', s_suppkey) as sku, s_name as name"

ORACLE = {
    "cdc_latest": _latest_sql("k, seq, ts, value, props"),
    "cdc_latest_window": _latest_sql("k, seq, ts, value, props"),
    "cdc_snapshot_plus_log": _latest_sql("k, ts, value, props"),
    "cdc_snapshot_chunks": _latest_sql("k, ts, value, props"),
    "cdc_before_after": with_relations(
        f"select k, seq, op, value_before, props_before, value_after, props_after from ({_IMAGES}) images", "chg"
    ),
    "cdc_changelog_kinds": with_relations(
        f"""with images as ({_IMAGES})
        select k, seq, '-U' as kind, value_before as value, props_before as props from images where had and op <> 'd'
        union all select k, seq, '+U', value_after, props_after from images where had and op <> 'd'
        union all select k, seq, '+I', value_after, props_after from images where not had and op <> 'd'
        union all select k, seq, '-D', value_before, props_before from images where had and op = 'd'""",
        "chg",
    ),
    "cdc_dedup": with_relations("select distinct * from (select * from chg union all select * from chg) twice", "chg"),
    "cdc_net_changes": with_relations(
        """with cut as (select max(seq) // 2 as half from chg),
        ranked as (select k, seq, op, seq <= half as early,
            row_number() over (partition by k order by seq desc) as rn,
            row_number() over (partition by k, seq <= half order by seq desc) as part_rn from chg, cut),
        old as (select k, seq from ranked where early and part_rn = 1 and op <> 'd'),
        new as (select k, seq from ranked where rn = 1 and op <> 'd')
        select coalesce(old.k, new.k) as k,
            case when old.k is null then 'insert' when new.k is null then 'delete' else 'update' end as change,
            old.seq as old_seq, new.seq as new_seq
        from old full join new on old.k = new.k where old.seq is distinct from new.seq""",
        "chg",
    ),
    "cdc_op_counts": with_relations("select op, count(*) as n_changes from chg group by op", "chg"),
    "cdc_align_types": with_relations(
        """select op, seq, cast(date_trunc('millisecond', ts) as timestamp) as ts, k,
            cast(cast(value as decimal(10,2)) as double) as value, props from chg""",
        "chg",
    ),
    "cdc_out_of_order": _latest_sql("k, value, props"),
    "upsert_latest": with_relations(
        """select id, product_id, qty, cast(price as double) as price, sale_ts from
        (select *, row_number() over (partition by id order by sale_ts desc, product_id desc, qty desc, price desc) as rn
        from sales) ranked where rn = 1""",
        "sales",
    ),
    "delete_rows": _latest_sql("k, value, props").replace("op <> 'd'", "op <> 'd' and not coalesce(value > 50, false)"),
    "create_empty_table": with_relations("select id, sku, name from products", "products"),
    "insert_rows": with_relations(
        f"""select id, sku, name, cast(price as double) as price, timestamp '2024-01-01 00:00:00' as created_at
        from products union all {_NARROW}, 0.0, timestamp '{AS_OF}' from supplier""",
        "products",
    ),
    "ctas_roundtrip": with_relations(
        """select product_id, cast(sum(qty) as bigint) as units, cast(sum(price) as double) as price
        from sales group by product_id""",
        "sales",
    ),
    "cvas_view": with_relations(
        "select product_id, count(*) as n_large from sales where price > 50000 group by product_id", "sales"
    ),
    "schema_evolution": with_relations(
        f"{_NARROW}, cast(null as double) as price from supplier"
        " union all select id, sku, name, cast(price as double) from products",
        "products",
    ),
    "time_travel_as_of": _latest_sql("k, value, props", f"date_trunc('millisecond', ts) <= timestamp '{AS_OF}'"),
    "time_travel_batch": _latest_sql("k, value, props", "seq * 4 // ((select max(seq) from chg) + 1) <= 2"),
    "time_travel_two_writers": with_relations(
        """with parts as (select *, seq * 5 // ((select max(seq) from chg) + 1) as part from chg),
        early as (select * from (select *, row_number() over (partition by k order by seq desc) as rn from parts
            where part < 4) ranked where rn = 1 and op <> 'd'),
        late as (select * from (select *, row_number() over (partition by k order by seq desc) as rn from parts
            where part = 4) ranked where rn = 1),
        kept as (select k, value, props from early where not coalesce(value > 50, false))
        select k, value, props, 'before the delete' as version from early
        union all select k, value, props, 'after the delete' from kept
        union all select k, value, props, 'now' from kept where k not in (select k from late)
        union all select k, value, props, 'now' from late where op <> 'd'""",
        "chg",
    ),
}
