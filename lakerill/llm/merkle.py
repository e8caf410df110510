"""A Merkle manifest of a table: leaves per row, trees per group, proofs by nested-struct rollup, in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Children of a node, as bits of a rank; levels of a block.
FAN_BITS, LEVELS = 4, 3
_BLOCK_BITS = FAN_BITS * LEVELS
_HEX = 64  # characters of a digest
_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number below


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: per field ``-`` if null, else its length in UTF-8 bytes, ``:`` and its value."""

    def written(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def _digit(rank: str, level: int) -> Column:
    return F.shiftright(rank, FAN_BITS * level).bitwiseAND((1 << FAN_BITS) - 1).cast("int")


def _ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``__r``, the place in their group by ``order`` (nulls first), and ``__n``, the group's size.

    The rows are cut into ranges of (group, order) of about equal counts, sorted and written once with their places; a place in
    the group is that one plus the sizes of the group's earlier ranges. A group of any size is spread over as many tasks as it
    fills. The row's place in the input also splits rows that are alike.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "__place")]
    sorted_rows = rows.withColumn("__place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    stored = materialise(
        sorted_rows.drop("__place").withColumns(
            {"__part": F.shiftright(place, _ROW_BITS), "__row": place.bitwiseAND((1 << _ROW_BITS) - 1)}
        ),
        "ranges",
    )
    # a row per range and group: a window over a group sees its ranges, not its rows
    sizes = stored.groupBy("__part", F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("first"))
    earlier = Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("__part").alias("__p"), "__g", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("__before"),
        F.sum("n").over(Window.partitionBy("__g")).alias("__n"),
    )
    same = (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))
    return stored.join(sizes, same).select(*rows.columns, (F.col("__row") + F.col("__before")).alias("__r"), "__n")


def _blocks(nodes: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """Nodes (``g``, ``r``, ``n``, ``h``, ``c``) rolled up to blocks (``g``, ``b``) of at most 16 ** 3 nodes.

    The digits of a rank are grouped away one after the other, each time nesting what is below in structs: a block's ``kids`` hold
    their digit, their own ``kids`` and ``joined``, the digests of these. One shuffle by (g, b) serves all groupings. ``tops``
    (``g``, ``b``, ``top``) are rows that travel along, so that a block also gets its own way to the root without a join.
    """
    n = F.col("n")
    height = F.when(n <= 1, 0).when(n <= 1 << FAN_BITS, 1).when(n <= 1 << 2 * FAN_BITS, 2).otherwise(LEVELS)
    rows = nodes.select(
        "g", F.shiftright("r", _BLOCK_BITS).alias("b"), "n", height.alias("height"),
        *(_digit("r", level).alias(f"d{level}") for level in range(LEVELS)),
        F.struct(_digit("r", 0).alias("d"), F.col("h").alias("h"), F.col("c").alias("c")).alias("kid"),
    )
    if tops is not None:
        rows = rows.unionByName(tops.select("g", "b", "top"), allowMissingColumns=True)
    else:
        rows = rows.withColumn("top", F.lit(None).cast("string"))
    rows = rows.repartition("g", "b")
    for level in range(LEVELS):
        above = [f"d{i}" for i in range(level + 1, LEVELS)]
        rows = rows.groupBy("g", "b", *reversed(above)).agg(
            F.max("n").alias("n"),
            F.max("height").alias("height"),
            F.array_sort(F.collect_list("kid")).alias("kids"),  # nulls, of rows of ``tops``, are left out
            F.first("top", True).alias("top"),
        )
        rows = rows.withColumn("joined", F.array_join(F.transform("kids", lambda k: k["h"]), ""))
        # where a group's tree is lower than its block there is one child here, and it is the node
        rows = rows.withColumn("h", F.when(F.col("height") > level, F.sha2("joined", 256)).otherwise(F.col("joined")))
        if above:
            kid = F.struct(F.col(above[0]).alias("d"), "h", "joined", "kids")
            rows = rows.withColumn("kid", F.when(F.size("kids") > 0, kid)).drop("kids", "joined", "h")
    return rows


def _climb(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of nodes, each the blocks of the one below, and the root of every group (``g``, ``h``)."""
    tiers = [nodes]
    while True:
        blocks = _blocks(tiers[-1].withColumn("c", F.lit(None).cast("string")))
        if most <= 1 << _BLOCK_BITS:
            return tiers, materialise(blocks.select("g", "h"), "roots")
        size = F.ceil(F.col("n") / (1 << _BLOCK_BITS)).cast("bigint").alias("n")
        above = blocks.select("g", F.col("b").alias("r"), size, "h")
        tiers.append(materialise(above, "tier").withColumn("c", F.lit(None).cast("string")))
        most = -(-most // (1 << _BLOCK_BITS))


def _step(joined: str, digit: str) -> Column:
    """What stands left and right of a node among the digests of its run."""
    at = F.col(digit) * _HEX
    return F.struct(
        F.substring(joined, F.lit(1), at).alias("left"), F.substring(joined, at + _HEX + 1, F.length(joined)).alias("right")
    )


def _descend(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every node of the lowest tier (``g``, ``r``, ``h``, ``c``) with ``top``: its steps to the root, and the roots.

    ``tops`` (``g``, ``top``) has the steps and roots above the groups. A tier's blocks are opened child by child.
    """
    tops = tops.withColumn("b", F.lit(0).cast("bigint"))
    for i, tier in reversed(list(enumerate(tiers))):
        rows = _blocks(tier, tops)
        for level in reversed(range(LEVELS)):
            kept = [c for c in rows.columns if c not in ("kids", "joined", "h")]
            rows = rows.select(*kept, F.col("joined").alias(f"j{level}"), F.explode("kids").alias("kid"))
            kept = [c for c in rows.columns if c != "kid"]
            below = ["kid.h", "kid.joined", "kid.kids"] if level else ["kid.h", "kid.c"]
            rows = rows.select(*kept, F.col("kid.d").alias(f"d{level}"), *below)
        own = F.slice(F.array(*(_step(f"j{level}", f"d{level}") for level in range(LEVELS))), F.lit(1), F.col("height"))
        rank = F.shiftleft("b", _BLOCK_BITS)
        for level in range(LEVELS):
            rank = rank + F.shiftleft(F.col(f"d{level}").cast("bigint"), FAN_BITS * level)
        top = F.struct(F.concat(own, F.col("top.steps")).alias("steps"), "top.subroot", "top.root")
        rows = rows.select("g", rank.alias("r"), "h", "c", top.alias("top"))
        if i:
            tops = materialise(rows.select("g", F.col("r").alias("b"), "top"), "tops")
    return rows


def manifest(leaves: DataFrame, group: str, order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Proofs of all rows of ``leaves``, whose digests are in ``leaf``.

    A group's leaves stand in ``order`` (nulls first, then by digest); sixteen consecutive nodes at a time, the last run maybe
    fewer, become the digest of their digests until one is left, the group's ``subroot``; the subroots, by group (null
    first, bytewise), likewise give ``root``. Returns the columns ``carry``, ``group``, ``leaf``, ``subroot``, ``root`` and
    ``steps``: per level, from the leaf up through the subroot, the digests ``left`` and ``right`` of the node in its run.

    Rows that are alike are leaves of their own, next to each other. A table without rows has no row here. Trees are
    made in blocks of 4096 nodes, so a group of any size is spread over tasks; leaves are digests, not texts, and are
    written twice: as they come, since the sort reads them twice, and in their order.
    """
    named = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    carried = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)), F.lit(0).alias("__")).alias("c")
    rows = materialise(leaves.select(F.col(group).alias("g"), *named, F.col("leaf").alias("h"), carried), "leaves")
    ranked = _ranked(rows, "g", [*(f"k{i}" for i in range(len(named))), "h"])
    nodes = ranked.select("g", F.col("__r").alias("r"), F.col("__n").alias("n"), "h", "c")
    tiers, roots = _climb(nodes, nodes.agg(F.max("n")).first()[0] or 1)

    groups = _ranked(roots.select(F.lit(0).alias("all"), "g", "h"), "all", ["g"])
    groups = groups.select(F.lit(0).alias("g"), F.col("__r").alias("r"), F.col("__n").alias("n"), "h", F.struct("g").alias("c"))
    upper, root = _climb(groups, groups.agg(F.max("n")).first()[0] or 1)
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = F.struct(none.alias("steps"), F.lit("").alias("subroot"), F.col("h").alias("root"))
    over = _descend(upper, root.select("g", start.alias("top")))
    top = F.struct("top.steps", F.col("h").alias("subroot"), "top.root").alias("top")
    over = materialise(over.select(F.col("c.g").alias("g"), top), "tops")
    return _descend(tiers, over).select(
        *(F.col(f"c.c{i}").alias(c) for i, c in enumerate(carry)), F.col("g").alias(group), F.col("h").alias("leaf"),
        "top.subroot", "top.root", "top.steps",
    )


def proof_text(steps: str | Column) -> Column:
    """All siblings of a proof one after the other, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: str | Column, steps: str | Column) -> Column:
    """The root that a leaf and its proof give."""
    leaf = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


#: The fields of a document, in the order in which its digest takes them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_text(text: str = "text") -> Column:
    """The text with A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and which of them still hold after some texts were changed.

    Documents the crc32 of whose decimal doc_id five divides are tampered with: their text is lower-cased (A-Z), nulls stay, so
    a text without capitals stays as it is and is verified. A null doc_id has no crc32 and is not tampered with. Returns
    ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` of the untampered documents, ``folded_root`` from the
    tampered leaf and the untampered siblings, and ``verified``.
    """
    fields = [F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = F.when(chosen, leaf_digest([*fields[:-1], tampered_text()]))
    leaves = docs.select("doc_id", "source", leaf_digest(fields).alias("leaf"), changed.alias("changed"))
    proofs = manifest(leaves, "source", ["doc_id"], ["doc_id", "changed"])
    rows = proofs.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), "steps"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text("steps"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
