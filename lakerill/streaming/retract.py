"""What a change of a row takes back and adds, and sums kept up to date by it, one micro-batch after the other.

What the batches before have left is held in lake tables. A batch reads them as of the batch before, puts what is held and what it
brings together by one aggregation, and appends what it has changed; a batch that runs again replaces its own. If a batch is
small, only the keys it names are shuffled; a scan of what is held finds them. Now and then the changes are folded into a base.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import same_key
from ..operators.lake import LogTable
from ..specs import BIGINT, BOOLEAN, DELETE, TableSpec

_OLDEST = -(1 << 63)
#: A batch of no more rows sends its keys to all tasks, and of what is held only these go on.
FEW = 100_000
#: A state with more batches than this since its last base gets a new one.
FOLD_AFTER = 32


def _fields(prefix: str, schema: T.StructType, columns: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(f"{prefix}{i}", schema[c].dataType) for i, c in enumerate(columns)]


def row_state(spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str], columns: Sequence[str]) -> LogTable:
    """Where ``row_changes`` keeps the newest row of each key, with the row it has replaced."""
    kept = [*_fields("k", schema, key), *_fields("now", schema, columns), *_fields("was", schema, columns)]
    kept.append(T.StructField("there", BOOLEAN))
    return LogTable(spark, root, TableSpec("rows", T.StructType(kept), tuple(f"k{i}" for i in range(len(key))))).create()


def sum_state(spark: SparkSession, root: str, schema: T.StructType, by: Sequence[str], sums: Sequence[str]) -> LogTable:
    """Where the sums of ``running_sums`` are kept if no other table has them, with those before."""
    ends = [T.StructField(f"{s}{end}", BIGINT) for end in ("", "_before") for s in sums]
    return LogTable(spark, root, TableSpec("sums", T.StructType([*[schema[c] for c in by], *ends]), tuple(by))).create()


def held_before(state: LogTable, batch_id: int, writer: str = "batch") -> DataFrame:
    """What a batch starts from: all that may be the newest row of a key as of the batch before it."""
    if batch_id and batch_id - 1 not in {b.batch_id for b in state.batches() if b.writer == writer}:
        raise ValueError(f"{state.root} does not hold what batch {batch_id - 1} has left; begin with a new checkpoint")
    return state.versions(batch_id - 1, writer)


def fold(state: LogTable, batch_id: int) -> None:
    """Fold the batches before ``batch_id`` into a base once there are many."""
    if state.since_base(batch_id - 1) > FOLD_AFTER:
        state.compact(upto=batch_id - 1)


def _together(fresh: DataFrame, held: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both, without those of ``held`` that a small ``fresh`` does not touch."""
    if fresh.limit(FEW + 1).count() <= FEW:
        keys = F.broadcast(fresh.select(*by)).alias("k")
        held = held.alias("h").join(keys, same_key("h", "k", by), "left_semi").select("h.*")
    return fresh.unionAll(held)


def row_changes(changes: DataFrame, batch_id: int, state: LogTable, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A batch of changes as rows to take back (``weight`` -1) and rows to add (+1), with ``columns``.

    Per key the newest change by ``seq`` counts, whenever it comes: what arrives late or twice changes nothing. A batch
    with several changes of a key shows the last one only, an update that leaves ``columns`` alike shows nothing. A
    change without ``seq`` is older than any other. A null in the key is a key like any other. ``state`` is of ``row_state``.
    """
    fold(state, batch_id)
    by, now, was = ([f"{p}{i}" for i in range(len(some))] for p, some in (("k", key), ("now", columns), ("was", columns)))
    alive = F.coalesce(F.col("op") != DELETE, F.lit(True)).alias("alive")
    seq = F.coalesce(F.col("seq"), F.lit(_OLDEST)).alias("seq")
    named = [F.col(c).alias(n) for c, n in zip([*key, *columns], [*by, *now])]
    fresh = changes.select(*named, seq, alive, F.lit(True).alias("new"))
    held = held_before(state, batch_id).select(*by, *now, seq, alive, F.lit(False).alias("new"))
    at_new, at_old = F.when(F.col("new"), F.col("seq")), F.when(~F.col("new"), F.col("seq"))
    both = _together(fresh, held, by).groupBy(*by).agg(
        F.max(at_new).alias("seq"),
        F.max(at_old).alias("old_seq"),
        F.max_by("alive", at_new).alias("alive"),
        F.coalesce(F.max_by("alive", at_old), F.lit(False)).alias("there"),
        *[F.max_by(n, at_new).alias(n) for n in now],
        *[F.max_by(n, at_old).alias(w) for n, w in zip(now, was)],
    )
    settled = both.where("seq is not null and (old_seq is null or seq > old_seq)").select(
        F.when(F.col("alive"), "u").otherwise(DELETE).alias("op"),
        "seq",
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        *by,
        *[F.when(F.col("alive"), F.col(n)).alias(n) for n in now],
        *[F.when(F.col("there"), F.col(w)).alias(w) for w in was],
        "there",
    )
    state.append_batch(settled, batch_id, exact=True)
    alike = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(w)) for n, w in zip(now, was)], F.lit(True))
    stays = F.col("op") != DELETE
    moved = state.batch(batch_id).where(~(F.col("there") & stays & alike))
    back = moved.where("there").select(F.lit(-1).alias("weight"), *[F.col(w).alias(c) for c, w in zip(columns, was)])
    add = moved.where(stays).select(F.lit(1).alias("weight"), *[F.col(n).alias(c) for c, n in zip(columns, now)])
    return back.unionAll(add)


def running_sums(deltas: DataFrame, by: Sequence[str], sums: Sequence[str], held: DataFrame) -> DataFrame:
    """Sums of whole numbers per group: the groups that a batch changes, as ``<sum>_before`` and ``<sum>_after``.

    ``held`` has the sums of the batches before, with their ``seq``; of a group the newest row counts (``held_before``). Each task adds
    up what it has per group before the shuffle, so a group that most rows belong to costs no more than another. A missing
    number adds nothing.
    """
    groups, names = [f"g{i}" for i in range(len(by))], [f"s{i}" for i in range(len(sums))]
    of_group = [F.col(c).alias(g) for c, g in zip(by, groups)]
    numbers = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(n) for c, n in zip(sums, names)]
    fresh = deltas.select(*of_group, *numbers, F.lit(None).cast("bigint").alias("seq"))
    both = _together(fresh, held.select(*of_group, *numbers, "seq"), groups)
    before = [F.coalesce(F.max_by(n, "seq"), F.lit(0)).alias(f"{n}b") for n in names]
    more = [F.coalesce(F.sum(F.when(F.col("seq").isNull(), F.col(n))), F.lit(0)).alias(n) for n in names]
    changed = both.groupBy(*groups).agg(*before, *more).where(reduce(lambda a, b: a | b, [F.col(n) != 0 for n in names]))
    ends = [(F.col(f"{n}b").alias(f"{c}_before"), (F.col(f"{n}b") + F.col(n)).alias(f"{c}_after")) for n, c in zip(names, sums)]
    return changed.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], *[b for b, _ in ends], *[a for _, a in ends])
