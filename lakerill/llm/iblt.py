"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests, in SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A sketch has this many tables, and each of them this many cells in every block.
TABLES, WIDTH = 3, 8
#: A block that does not peel is cut into this many, a power of two. After so many cuts, when what is left agrees in 39 of its
#: 64 bits, digests are compared one by one.
SPLIT_BITS, LEVELS = 3, 10
#: Differences up to this size mostly peel from one block.
_FITS = 10
_SENTENCE_END = r"\n|(?<=[.!?]) "
_ROUNDS = TABLES * WIDTH  # each round empties a cell at least
#: Documents in a slice of the doc_id order, about; and the most slices.
_SLICE, _MOST_SLICES = 1000, 1 << 16


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def paragraphs(text: str | Column) -> Column:
    """The different digests of a text's paragraphs: its lines, cut after each sentence. A null has none.

    A digest depends on nothing around it, so an inserted sentence costs one.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    pieces = F.filter(F.split(text, _SENTENCE_END), lambda p: p != "")
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    """What tells a cell of one key from a cell of several."""
    return F.xxhash64(key)


def placed(keys: Column) -> Column:
    """Keys with their check and their cell in every table (three bits of the key each), computed once."""

    def place(k: Column) -> Column:
        cells = (F.shiftrightunsigned(k, 3 * t).bitwiseAND(_long(WIDTH - 1)) + WIDTH * t for t in range(TABLES))
        return F.struct(k.alias("k"), _check(k).alias("h"), *(c.alias(f"c{t}") for t, c in enumerate(cells)))

    return F.transform(keys, place)


def sketch(places: Column, without: Column | None = None) -> Column:
    """The cells of placed keys: number, exclusive or of the keys, count, exclusive or of their checks.

    Nothing in a cell grows but its count, so a text may have any number of digests. The keys of ``without`` are subtracted:
    the same as the difference of two sketches, in one pass.
    """

    def cells(t: int) -> Column:
        def cell(i: Column) -> Column:
            def add(sign: int):
                return lambda c, p: F.struct(
                    c["c"].alias("c"), c["k"].bitwiseXOR(p["k"]).alias("k"), (c["n"] + _long(sign)).alias("n"), c["h"].bitwiseXOR(p["h"]).alias("h")
                )

            held = F.struct(i.alias("c"), _long(0).alias("k"), _long(0).alias("n"), _long(0).alias("h"))
            for keys, sign in ((places, 1), (without, -1)):
                if keys is not None:
                    held = F.aggregate(F.filter(keys, lambda p: p[f"c{t}"] == i), held, add(sign))
            return held

        return F.transform(F.sequence(_long(WIDTH * t), _long(WIDTH * t + WIDTH - 1)), cell)

    return F.concat(*map(cells, range(TABLES)))


def _less(a: Column, b: Column) -> Column:
    """A cell without what another one holds."""
    return F.struct(
        a["c"].alias("c"), a["k"].bitwiseXOR(b["k"]).alias("k"), (a["n"] - b["n"]).alias("n"), a["h"].bitwiseXOR(b["h"]).alias("h")
    )


def subtract(a: Column, b: Column) -> Column:
    """The sketch of what only one of two sketches has."""
    return F.zip_with(a, b, _less)


def _held(cells: Column) -> Column:
    return F.filter(cells, lambda c: (c["k"] != 0) | (c["n"] != 0) | (c["h"] != 0))


def _peel_round(cells: Column) -> Column:
    """Keys of cells that hold one key alone are taken out of all their cells."""
    alone = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"])))
    keys = F.array_distinct(F.transform(alone, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"), c["h"].alias("h"))))

    def place(p: Column) -> Column:
        cells = (F.shiftrightunsigned(p["k"], 3 * t).bitwiseAND(_long(WIDTH - 1)) + WIDTH * t for t in range(TABLES))
        return F.struct(*(p[x].alias(x) for x in "knh"), *(c.alias(f"c{t}") for t, c in enumerate(cells)))

    def without(c: Column, keys: Column) -> Column:
        own = F.filter(keys, lambda p: (p["c0"] == c["c"]) | (p["c1"] == c["c"]) | (p["c2"] == c["c"]))
        return F.aggregate(own, c, _less)

    return _let(
        F.transform(keys, place),
        lambda keys: F.struct(
            _held(F.transform(cells, lambda c: without(c, keys))).alias("cells"),
            F.transform(keys, lambda p: F.struct(p["k"].alias("k"), p["n"].alias("n"))).alias("keys"),
        ),
    )


_DIGESTS = "array<struct<k:bigint,n:bigint>>"


def peel(cells: Column) -> Column:
    """The digests that a difference holds (``k``, and ``n``: 1 on the left side, -1 on the right); null if it does not peel."""
    none = F.array().cast(_DIGESTS)
    start = F.struct(_held(cells).alias("cells"), none.alias("keys"), F.lit(False).alias("stuck"))

    def step(state: Column, _: Column) -> Column:
        more = _let(
            _peel_round(state["cells"]),
            lambda r: F.struct(
                r["cells"].alias("cells"), F.concat(state["keys"], r["keys"]).alias("keys"), (F.size(r["keys"]) == 0).alias("stuck")
            ),
        )
        return F.when((F.size(state["cells"]) == 0) | state["stuck"], state).otherwise(more)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ROUNDS)), start, step, lambda s: F.when(F.size(s["cells"]) == 0, s["keys"])
    )


def estimate(cells: Column, more: Column) -> Column:
    """About how many digests a difference holds, from the squares of its cells' counts; ``more``: left ones less right ones.

    Digests of the two sides meet in a cell with opposite signs, so a table's squared counts add up to the number of digests on
    average, but for what the sides' different numbers add.
    """
    squares = F.aggregate(cells, _long(0), lambda s, c: s + c["n"] * c["n"]) / TABLES
    return F.greatest((WIDTH * squares - more * more) / (WIDTH - 1), F.abs(more))


def difference(a: Column, b: Column, cells_a: Column | None = None, cells_b: Column | None = None) -> Column:
    """The digests that only one of two arrays of placed digests has, recovered from their sketches (see ``peel``).

    Sketches grow eightfold at a time: further bits of a digest name its block, and every block is a sketch of its own. An
    estimate of the difference says how large to begin; a block that does not peel is made larger in turn.
    """
    cells_a = sketch(a) if cells_a is None else cells_a
    cells_b = sketch(b) if cells_b is None else cells_b

    def split(a: Column, b: Column, level: int, first: Column) -> Column:
        def block(keys: Column, i: Column) -> Column:
            shift = 3 * TABLES + SPLIT_BITS * level
            return F.filter(keys, lambda p: F.shiftrightunsigned(p["k"], shift).bitwiseAND(_long((1 << SPLIT_BITS) - 1)) == i)

        def part(i: Column) -> Column:
            return _let(F.struct(block(a, i).alias("a"), block(b, i).alias("b")), lambda p: solve(p["a"], p["b"], level + 1, first))

        return F.flatten(F.transform(F.sequence(_long(0), _long((1 << SPLIT_BITS) - 1)), part))

    def solve(a: Column, b: Column, level: int, first: Column) -> Column:
        if level == LEVELS:
            left, right = (F.transform(x, lambda p: p["k"]) for x in (a, b))
            sides = ((F.array_except(left, right), 1), (F.array_except(right, left), -1))
            return F.concat(*(F.transform(x, lambda k: F.struct(k.alias("k"), _long(n).alias("n"))) for x, n in sides))
        none = F.when((F.size(a) == 0) & (F.size(b) == 0), F.array().cast(_DIGESTS))
        found = F.when(first <= level, peel(sketch(a, b)))
        return F.coalesce(none, found, split(a, b, level, first))

    def begin(cells: Column) -> Column:
        about = estimate(cells, (F.size(a) - F.size(b)).cast("bigint"))
        first = F.ceil(F.log2(F.greatest(about, F.lit(1.0)) / _FITS) / SPLIT_BITS)
        return _let(first, lambda f: F.coalesce(F.when(f <= 0, peel(cells)), split(a, b, 0, f)))

    return _let(subtract(cells_a, cells_b), begin)


def likeness(a: Column, b: Column, cells_a: Column | None = None, cells_b: Column | None = None) -> Column:
    """Shared digests among all digests of two arrays of placed digests (1 if both are empty), by way of their sketches' difference."""
    both = F.size(a) + F.size(b)
    apart = F.size(difference(a, b, cells_a, cells_b))
    return F.when(both == 0, 1.0).otherwise(_let(apart, lambda d: (both - d) / (both + d))).cast("double")


def as_text(cells: Column) -> Column:
    """A sketch as a string: keys, counts and checks of its cells in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["k"]), F.hex(c["n"]), F.hex(c["h"]))), " ")


def _slices(docs: DataFrame) -> tuple[list[int], list[int]]:
    """Smallest and largest doc_id of ranges of the order, largest first; reads ids only, and brings at most 65,536 pairs."""
    ids = docs.where("doc_id is not null").select("doc_id")
    n = min(_MOST_SLICES, max(1, -(-docs.count() // _SLICE)))
    ranges = ids.repartitionByRange(n, F.desc("doc_id")) if n > 1 else ids.coalesce(1)
    rows = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    found = sorted(((r["lo"], r["hi"]) for r in rows.collect()), reverse=True)
    return [lo for lo, _ in found], [hi for _, hi in found]


def _slice_of(doc_id: Column, lows: list[int]) -> Column:
    """How many slices lie wholly above an id: first among runs of slices, then within one; nulls are in the last slice."""
    run = max(1, int(len(lows) ** 0.5))
    runs = [lows[i : i + run] for i in range(0, len(lows), run)]
    last = F.array(*(_long(r[-1]) for r in runs))
    inner = F.array(*(F.array(*(_long(x) for x in r)) for r in runs))
    outer = F.size(F.filter(last, lambda x: x > doc_id))
    within = F.size(F.filter(F.element_at(inner, F.least(outer + 1, F.lit(len(runs)))), lambda x: x > doc_id))
    place = F.when(outer >= len(runs), len(lows) - 1).otherwise(outer * run + within)
    return F.when(doc_id.isNull(), len(lows) - 1).otherwise(F.least(place, F.lit(len(lows) - 1)))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``digests`` (placed), ``cells`` (their sketch) of every row, and ``next_text``, ``next_digests``,
    ``next_cells`` of the one after it by descending doc_id.

    After the last row comes the first; nulls are last, rows with equal doc_id go by their text's hash. The order is cut into
    slices of about a thousand documents by ranges of doc_id; the head of each slice is also sent to the slice before it, so the
    text crosses the network once and no task holds more than its slices.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    lows, highs = _slices(rows)
    if not lows:  # no ids at all
        lows, highs = [0], []
    doc_id, last = F.col("doc_id"), len(lows) - 1
    rows = rows.withColumn("slice", _slice_of(doc_id, lows))
    first = _long(highs[0]) if highs else F.lit(None).cast("bigint")
    if len(highs) > 1:
        run = max(1, int(len(highs) ** 0.5))
        heads = F.array(*(F.array(*(_long(x) for x in highs[i : i + run])) for i in range(0, len(highs), run)))
        at = F.element_at(F.element_at(heads, F.floor(F.col("slice") / run).cast("int") + 1), F.pmod("slice", F.lit(run)).cast("int") + 1)
    else:
        at = first
    # the head of the first slice follows the last one
    before = F.when(F.col("slice") == 0, last).otherwise(F.col("slice") - 1)
    head = doc_id == at if highs else F.lit(True)
    sent = F.when(head, F.array(F.struct("slice", F.lit(0).alias("donor")), F.struct(before.alias("slice"), F.lit(1).alias("donor"))))
    sent = sent.otherwise(F.array(F.struct("slice", F.lit(0).alias("donor"))))
    rows = rows.select("doc_id", "text", F.explode(sent).alias("to")).select("doc_id", "text", "to.slice", "to.donor")
    rows = rows.repartition("slice").withColumn("digests", placed(paragraphs("text")))
    rows = rows.withColumn("cells", sketch(F.col("digests")))
    order = Window.partitionBy("slice").orderBy(F.col("donor"), F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    rows = rows.select(
        "doc_id", "text", "digests", "cells", "donor",
        *(F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "digests", "cells")),
    )
    return rows.where("donor = 0").drop("donor")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, and their likeness.

    The edited version has its last third (rounded down, in code points) replaced by as much of the beginning of the next document
    (see ``with_next``). Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. Null texts are empty; an empty text's sketch is all zeros. Everything after the one
    shuffle of the texts happens row by row.
    """
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - third), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third)
    )
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "digests",
        "cells",
        placed(paragraphs("edited")).alias("edited_digests"),
        "next_digests",
        "next_cells",
    ).withColumn("edited_cells", sketch(F.col("edited_digests")))
    a, own = F.col("digests"), F.col("cells")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(own).alias("fingerprint"),
        as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(a, F.col("edited_digests"), own, F.col("edited_cells")).alias("near_edited"),
        likeness(a, F.col("next_digests"), own, F.col("next_cells")).alias("near_next"),
    )
