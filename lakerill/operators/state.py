"""Keeping a keyed table in step with its change log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import newer, same_key
from ..specs import DELETE

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _fixed_width(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FIXED_WIDTH) or (isinstance(dtype, T.DecimalType) and dtype.precision <= 18)


def latest_state(
    log: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = ("seq",),
    op: str | None = "op",
    columns: Sequence[str] | None = None,
    keep_deletes: bool = False,
) -> DataFrame:
    """The newest row of every key; keys whose newest change is a delete are gone.

    A NULL in ``order`` is older than any value, so a row with NULL counts where its key has no other.
    ``op`` is None for logs without deletes. ``columns`` prunes what is carried. Every map task
    reduces a key to one row before the shuffle, so a hot key costs no more than any other. Rows that
    are fixed-width but for the key are carried column by column, which Spark aggregates by hashing;
    others travel as one struct, which it aggregates by sorting.
    """
    wanted = list(columns) if columns is not None else [c for c in log.columns]
    carried = [c for c in wanted if c not in key and c != op]
    integral = len(order) == 1 and isinstance(log.schema[order[0]].dataType, _INTEGRAL)
    # never NULL, since max_by passes over rows whose rank is
    rank = F.coalesce(F.col(order[0]).cast("bigint"), F.lit(-(1 << 63))) if integral else F.struct(*order)
    alive = F.lit(True) if op is None else F.coalesce(F.col(op) != DELETE, F.lit(True))
    keep_op = op is not None and keep_deletes
    flat = integral and not keep_op and all(_fixed_width(log.schema[c].dataType) for c in carried)
    if flat:
        picks = [F.max_by(F.col(c), rank).alias(c) for c in carried]
        state = log.groupBy(*key).agg(*picks, F.max_by(alive, rank).alias("__alive"))
        return state.where("__alive").select(*_in_order(wanted, key, carried, None))
    image = F.struct(*[F.col(c) for c in carried], *([F.col(op)] if op is not None else []))
    newest = log.groupBy(*key).agg(F.max_by(image, rank).alias("__row"))
    if op is not None and not keep_deletes:
        newest = newest.where(F.coalesce(F.col(f"__row.{op}") != DELETE, F.lit(True)))
    out = [c if c in key else f"__row.{c}" for c in _in_order(wanted, key, carried, op if keep_op else None)]
    return newest.select(*out)


def _in_order(wanted: Sequence[str], key: Sequence[str], carried: Sequence[str], op: str | None) -> list[str]:
    kept = {*key, *carried, *([op] if op else [])}
    return [*[k for k in key if k not in wanted], *[c for c in wanted if c in kept]]


def latest_by_window(
    log: DataFrame, key: Sequence[str], order: Sequence[Column], op: str | None = "op"
) -> DataFrame:
    """:func:`latest_state` for an arbitrary sort order, newest first.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so hot keys stay harmless.
    """
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    newest = log.withColumn("__rn", place).where("__rn = 1").drop("__rn")
    return newest if op is None else newest.where(F.coalesce(F.col(op) != DELETE, F.lit(True)))


def reconcile(
    snapshot: DataFrame,
    log: DataFrame,
    key: Sequence[str],
    snapshot_seq: int | Column,
    order: str = "seq",
    op: str = "op",
) -> DataFrame:
    """State from a snapshot taken at position ``snapshot_seq`` and a log that overlaps it.

    The snapshot holds all changes up to its position, so of the log only the later ones count. A position may be a column
    that both frames have, such as that of the chunk a key belongs to: chunks are read one after the other while the log goes on.
    """
    position = F.lit(snapshot_seq) if isinstance(snapshot_seq, int) else snapshot_seq
    rows = snapshot.withColumns({order: position.cast("bigint"), op: F.lit("c")})
    later = log.where(F.col(order) > position)
    return latest_state(rows.unionByName(later, allowMissingColumns=True), key, (order,), op)


def dedup(
    log: DataFrame, key: Sequence[str], order: str = "seq", ts: str = "ts", lateness: str | None = None
) -> DataFrame:
    """One copy of every change ``(key, order)`` that was delivered more than once.

    A stream remembers every change it has seen, so its state grows with the feed and nothing is lost, however late.
    With a ``lateness`` it forgets changes that much older than the newest event time, and **drops whatever arrives
    later than that**, first copies too; its ``ts`` then leaves as a zoned timestamp.
    """
    if log.isStreaming and lateness:
        timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
        return timed.dropDuplicatesWithinWatermark([*key, order])
    return log.dropDuplicates([*key, order])


def net_changes(
    log: DataFrame,
    key: Sequence[str],
    old: Column,
    new: Column | None = None,
    order: str = "seq",
    op: str = "op",
) -> DataFrame:
    """What became of every key between two versions: ``insert``, ``update`` or ``delete``.

    ``old`` and ``new`` say which log rows a version holds (all rows where ``new`` is None). One scan
    and one shuffle find both versions of a key; keys that are alike in both are left out.
    """
    late = F.lit(True) if new is None else new
    mine = F.col(order)

    def version(holds: Column) -> list[Column]:
        at = F.when(holds, mine)
        return [F.max(at), F.max_by(F.col(op) != DELETE, at)]

    (old_seq, old_alive), (new_seq, new_alive) = version(old), version(late)
    both = log.groupBy(*key).agg(
        old_seq.alias("old_seq"),
        F.coalesce(old_alive, F.lit(False)).alias("__was"),
        new_seq.alias("new_seq"),
        F.coalesce(new_alive, F.lit(False)).alias("__is"),
    )
    kind = (
        F.when(F.col("__is") & ~F.col("__was"), "insert")
        .when(F.col("__was") & ~F.col("__is"), "delete")
        .when(F.col("__was") & F.col("__is") & (F.col("new_seq") > F.col("old_seq")), "update")
    )
    return (
        both.withColumn("change", kind)
        .where(F.col("change").isNotNull())
        .select(
            *key,
            "change",
            F.when(F.col("__was"), F.col("old_seq")).alias("old_seq"),
            F.when(F.col("__is"), F.col("new_seq")).alias("new_seq"),
        )
    )


def op_counts(log: DataFrame, op: str = "op") -> DataFrame:
    """Changes by kind."""
    return log.groupBy(op).agg(F.count(F.lit(1)).alias("n_changes"))


def merge(base: DataFrame, tail: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of every key of ``base`` and ``tail``, both with one row per key, deletes included.

    A full join on the key; on a base bucketed by the key only the tail is shuffled.
    """
    columns = base.columns
    in_base = F.lit(True).alias("__in_base")
    b, t = base.select("*", in_base).alias("b"), tail.select(*columns).alias("t")  # a missing t is all NULL, so never newer
    # plain equality, which buckets serve; a NULL key equals nothing and is seen to below
    same = reduce(lambda x, y: x & y, [F.col(f"b.{k}") == F.col(f"t.{k}") for k in key])
    use_tail = F.col("b.__in_base").isNull() | newer("t", "b", order)
    merged = b.join(t, same, "full").select(
        *[F.when(use_tail, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in columns]
    )
    unknown = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key])
    nulls = base.where(unknown).unionByName(tail.select(*columns).where(unknown))
    nulls = latest_state(nulls, key, order, keep_deletes=True).select(*columns)
    return merged.where(~unknown).unionByName(nulls)
