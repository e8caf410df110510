"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from ..sources.ids import assign_ids
from .text import n_words

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Along training time, in equal steps, how a source's weight swings around its mean, repeating like the weights:
#: sources of the largest weight come early, those of the smallest late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``weight_rank`` and ``target`` from ``source`` and ``source_size``.

    Sources in code point order, null last, weigh ``weights``, repeating, and share ``share`` of all sizes; none gets more
    than ``most`` times its size, and what that leaves is shared by weight again until none is above. The table of sources
    stays distributed; each round of sharing brings four numbers to the driver.
    """
    ranked = assign_ids(sizes, order=["source"], name="rank")
    rank = F.col("rank") - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight.cast("double")).withColumn("weight_rank", rank), "sources")
    limit = F.lit(float(most)) * F.col("source_size")
    level = 0.0
    while True:
        # a source at its limit stays there: the level only rises
        full = F.col("weight") * F.lit(level) > limit
        total, taken, open_weight, n_full = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        new = (share * total - taken) / open_weight if open_weight else level
        if new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level), limit)
    return ranked.select("source", "source_size", "weight_rank", target.alias("target"))


def _position(used: Column, rank: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """When a source has used the share ``used`` of its tokens: its integrated weight schedule, inverted."""
    cases = None
    for k, knots in enumerate(schedules):
        step = 1 / (len(knots) - 1)
        whole = sum(a + b for a, b in zip(knots, knots[1:])) / 2 * step
        before, place = 0.0, F.lit(0.0)
        for i, (a, b) in enumerate(zip(knots, knots[1:])):
            height, slope, rest = a / whole, (b - a) / step / whole, F.greatest(F.lit(0.0), used - before)
            # solves height * x + slope / 2 * x**2 = rest
            root = F.sqrt(F.greatest(F.lit(0.0), height * height + 2 * slope * rest))
            inside = i * step + F.when(rest > 0, 2 * rest / (height + root)).otherwise(0.0)
            place = F.when(used >= before, F.least(inside, F.lit((i + 1) * step))).otherwise(place)
            before += (a + b) / 2 * step / whole
        chosen = F.pmod(rank, F.lit(len(schedules))) == k
        cases = F.when(chosen, place) if cases is None else cases.when(chosen, place)
    return cases


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    size: str | None = None,
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """Every row of ``docs`` with the training positions the mix gives it.

    ``targets`` says how many words each source gives. The documents of a source form a stream in the order of a hash
    of their doc_id; the stream is read up to the target, up to ``most`` times over, and a document is taken each time its
    middle comes before the target. A source thus misses its target by less than half a document. The share of the
    target that is used up before a document, put through the inverse of the integrated schedule, is its position between 0
    and 1. Sums along the stream run per slice of the hash first, so no task holds a source.

    Returns the columns of ``docs`` (those named as follows are replaced) plus ``size`` (words, or the column named by
    ``size``), ``source_size``, ``target`` (those of its source) and ``positions`` (array, empty if the mix leaves it out).
    Null texts have size 0, null sources are one source and come last. Documents without words are taken or not by their
    place in the stream. Rows come in no order; ``schedule`` and ``in_training_order`` sort them by position. Rows with equal doc_id follow each other in an order given by all their columns' hash.
    """
    made = ("size", "source_size", "target", "positions")
    names = [c for c in docs.columns if c not in made or c == size]
    rows = docs.withColumn("__size", F.coalesce(F.col(size), F.lit(0)).cast("bigint") if size else n_words("text"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    piece = F.substring(digest, 1, 4)
    key = F.concat(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), piece)  # never null, one plain key to join and sort by
    plain = [c for c in names if not isinstance(docs.schema[c].dataType.jsonValue(), dict)]
    # a hash, so that columns nobody asks for needn't travel to break ties
    rows = rows.withColumns({"__hash": digest, "__slice": piece, "__key": key, "__tie": F.xxhash64(*plain)})
    slices = rows.groupBy("source", "__slice", "__key").agg(F.sum("__size").alias("__n"))
    slices = materialise(slices, "mix")  # words are counted once more for the rows, from here on only sums are read
    wanted = targets(slices.groupBy("source").agg(F.sum("__n").alias("source_size")), weights, share, most)
    # at most 65,536 slices to a source
    ahead = F.sum("__n").over(Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.withColumn("__ahead", F.coalesce(ahead, F.lit(0))).alias("s")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    offsets = slices.join(wanted.alias("t"), same).select("__key", "__ahead", "source_size", "target", "weight_rank")
    rows = rows.drop("source_size", "target", "positions", *(["size"] if size != "size" else []))
    joined = rows.join(offsets, "__key")
    along = Window.partitionBy("__key").orderBy("__hash", "doc_id", "__tie")
    before = F.coalesce(F.sum("__size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = joined.withColumn("__start", F.col("__ahead") + before)
    places = []
    for k in range(most):
        middle = F.col("__start") + k * F.col("source_size") + F.col("__size") / 2
        used = F.when(F.col("target") > 0, middle / F.col("target")).otherwise(0.0)
        places.append(F.when(middle <= F.col("target"), _position(used, F.col("weight_rank"), schedules)))
    positions = F.array_compact(F.array(*places)).alias("positions")
    kept = [F.col(c) for c in names if c != "size"]
    return joined.select(*kept, F.col("__size").alias("size"), "source_size", "target", positions)


def schedule(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """``mix`` without the texts, in training order: range-partitioned and sorted by the first position of each document.

    Returns ``doc_id``, ``source`` and what ``mix`` adds, a row per document; those that the mix leaves out come last, ties go by
    doc_id. Words are counted once and written with the ids, so neither the sums nor the cutting of ranges reads a text again.
    Rows with equal doc_id, source and size are alike.
    """
    sizes = materialise(docs.select("doc_id", "source", n_words("text").alias("size")), "sizes")
    mixed = mix(sizes, weights, schedules, "size", share, most)
    # beyond every position
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    mixed = materialise(mixed.withColumn("__first", first), "mixed")  # ranges are cut from the files
    return mixed.repartitionByRange("__first", "doc_id").sortWithinPartitions("__first", "doc_id").drop("__first")


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per time a document is taken, range-partitioned and sorted by ``position``."""
    taken = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return taken.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
