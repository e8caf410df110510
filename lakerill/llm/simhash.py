"""SimHash near-duplicates: meet-in-the-middle ball hashing of 64-bit fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .text import with_fields

#: Variants that meet in one task group on average and at most; eight bytes each.
_GROUP, _LARGEST = 4_000_000, 16_000_000
#: By so many leading bits a group that is too large is split further.
_MORE_BITS = 4
_EDGE = "a long, b long"
#: Shingles of a text that are hashed at once.
_SHINGLES = 1 << 16
#: Pairs that a group holds before it keeps a forest of them.
_PAIRS = 2_000_000


def fingerprints(text: str | None, shingle: int = 4, prints: int = 1) -> list[int]:
    """64-bit SimHashes of a text: ASCII lower case, word shingles, XXH64 with seed 42; repeats count each time.

    The first fingerprint has a shingle's hash as it is, each further one that hash mixed with the fingerprint's number, so they err
    independently of each other.
    """
    parts = (text or "").encode().lower().split()  # bytes: only A-Z change, only the six characters split
    if not parts:
        return [0] * prints
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    last = ends[min(shingle, len(parts)) - 1 :] - 1
    first = (ends - [len(p) + 1 for p in parts])[: len(last)]
    digest = xxhash.xxh64_digest  # the highest byte comes first
    ones = np.zeros((prints, 64), np.int64)
    for at in range(0, len(last), _SHINGLES):
        block = slice(at, at + _SHINGLES)
        hashes = b"".join([digest(joined[i:j], 42) for i, j in zip(first[block].tolist(), last[block].tolist())])
        own = np.frombuffer(hashes, ">u8").astype(np.uint64)
        for k in range(prints):
            raw = (_mixed(own, k) if k else own).astype(">u8").view(np.uint8)
            ones[k] += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(last), axis=1)
    return [int.from_bytes(b.tobytes()) for b in bits]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    return fingerprints(text, shingle)[0]


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """A bijection of 64-bit numbers for each ``k``, whose bits have nothing to do with those of another."""
    h = hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _fingerprints(shingle: int, names: list[str], prints: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprints(x.as_py(), shingle, prints) for x in batch["__text"]], np.uint64).reshape(-1, prints)
            made = [pa.array(np.ascontiguousarray(column).view(np.int64)) for column in found.T]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *made], names=[*names, *_print_names(prints)])

    return run


def _print_names(prints: int) -> list[str]:
    return ["__print", *(f"__print{k}" for k in range(1, prints))]


def with_fingerprint(docs: DataFrame, keep: list[str], shingle: int = 4, prints: int = 1) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``__print``, the fingerprint as a signed long (then ``__print1`` and so on)."""
    schema = with_fields(docs.select(*keep).schema, ", ".join(f"{n} long" for n in _print_names(prints)))
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(_fingerprints(shingle, keep, prints), schema)


def _flips(width: int, most: int) -> np.ndarray:
    """All masks over ``width`` low bits with at most ``most`` bits set."""
    sets = (c for k in range(most + 1) for c in combinations(range(width), k))
    return np.array([sum(1 << i for i in c) for c in sets], np.uint64)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Places of links that join all that ``a``, ``b`` join, without a circle."""
    parent, kept = list(range(n)), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return kept


def _thinned(pairs: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """A spanning forest of the pairs (two places in one number) that are near enough."""
    a, b = pairs // len(prints), pairs % len(prints)
    near = np.bitwise_count(prints[a] ^ prints[b]) <= radius
    pairs, a, b = pairs[near], a[near], b[near]
    return pairs[_forest(a, b, len(prints))]


def _collide(radius: int):
    """Within one range of variants (and its leading bits): fingerprints that share a variant, as a spanning forest of checked links."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        return _linked(group["print"].to_numpy(), key[0].as_py(), key[1].as_py(), radius)

    return run


def _linked(prints: np.ndarray, within: int, bits: int, radius: int) -> pa.Table:
    half, low = radius // 2, 64 - bits
    keep = np.uint64((1 << low) - 1)
    prints = np.unique(prints).view(np.uint64)
    away = np.bitwise_count((prints >> np.uint64(low)) ^ np.uint64(within)) if bits else np.zeros(len(prints))
    made: list[tuple[np.ndarray, np.ndarray]] = []  # the places of fingerprints, and the masks of their variants
    for d in range(half + 1):
        at, masks = np.flatnonzero(away == d), _flips(low, half - d)
        step = max(1, 500_000 // len(masks))
        made += [(at[i : i + step], masks) for i in range(0, len(at), step)]
    total = sum(len(at) * len(masks) for at, masks in made)
    variants, filled = np.empty(total, np.uint64), 0
    for at, masks in made:
        part = ((prints[at] & keep)[:, None] ^ masks[None, :]).ravel()
        variants[filled : filled + len(part)] = part
        filled += len(part)
    variants.sort()
    twice = np.unique(variants[1:][variants[1:] == variants[:-1]])
    del variants
    a = b = np.zeros(0, np.int64)
    if len(twice):
        center = np.full(len(twice), -1, np.int64)  # the first fingerprint seen with each shared variant
        pairs = np.zeros(0, np.int64)
        for at, masks in made:
            part = ((prints[at] & keep)[:, None] ^ masks[None, :]).ravel()
            slot = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
            hit = np.flatnonzero(twice[slot] == part)
            slot, who = slot[hit], at[hit // len(masks)]
            fresh = center[slot] < 0
            center[slot[fresh]] = who[fresh]
            pair = np.unique(center[slot] * len(prints) + who)
            pairs = np.union1d(pairs, pair[pair // len(prints) != pair % len(prints)])
            if len(pairs) > _PAIRS:  # what is joined already needs no more than a forest
                pairs = _thinned(pairs, prints, radius)
        a, b = pairs // len(prints), pairs % len(prints)
        near = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        a, b = a[near], b[near]
        kept = _forest(a, b, len(prints))
        a, b = a[kept], b[kept]
    signed = prints.view(np.int64)
    return pa.table({"a": signed[a], "b": signed[b]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def links(prints: DataFrame, n: int, radius: int = 4) -> DataFrame:
    """Links ``a``, ``b`` that join all fingerprints (column ``print``, different ones, about ``n``) within ``radius`` bits.

    Two fingerprints at most ``radius`` apart have a common variant within ``radius // 2`` of both. A variant's leading
    bits name the group it belongs to; a fingerprint is sent once to each group that its variants reach, and the variants are
    made there, so the shuffle holds some dozens of rows per fingerprint in place of thousands of variants. Whatever shares
    a variant is within ``radius`` of each other, so a variant needs no more than a star of links, and a group sends on a
    spanning forest: never more links than fingerprints.

    Near copies that differ a little have fingerprints with the same leading bits. A group with more variants than a task may hold is
    split by further bits, again and again until each one fits; a variant is in one part alone, so nothing is lost.
    """
    if radius % 2:
        raise ValueError("the radius has to be even")
    half = radius // 2
    per_print = len(_flips(64, half))
    bits = min(40, max(0, int(np.ceil(np.log2(max(1, n * per_print / _GROUP))))))
    own = F.shiftrightunsigned("print", 64 - bits) if bits else F.lit(0).cast("bigint")
    now = _dealt(prints.select("print", own.alias("own"), F.lit(half).alias("left")), F.lit(0).cast("bigint"), bits, half)
    done = None
    while True:
        now = materialise(now, "ranges")
        # how many variants a fingerprint has in a range: those with the flips that are left to it
        weight = F.element_at(F.array(*(F.lit(len(_flips(64 - bits, k))) for k in range(half + 1))), F.col("left") + 1)
        sizes = now.groupBy("range").agg(F.sum(weight).alias("variants"))
        large = materialise(sizes.where(F.col("variants") > _LARGEST).select("range"), "large")
        fits = now if bits > 64 - _MORE_BITS or large.isEmpty() else now.join(large, "range", "left_anti")
        part = fits.select("print", "range", F.lit(bits).alias("bits"))
        done = part if done is None else done.unionAll(part)
        if fits is now:
            break
        bits += _MORE_BITS
        more = F.shiftrightunsigned("print", 64 - bits).bitwiseAND(F.lit((1 << _MORE_BITS) - 1).cast("bigint"))
        rest = now.join(large, "range").select("print", more.alias("own"), "left", F.shiftleft("range", _MORE_BITS).alias("range"))
        now = _dealt(rest, F.col("range"), _MORE_BITS, half)
    return done.groupBy("range", "bits").applyInArrow(_collide(radius), _EDGE)


def _dealt(rows: DataFrame, start: Column, bits: int, half: int) -> DataFrame:
    """Each fingerprint once per range that its variants reach by ``bits`` more bits, with the flips that are ``left`` to it there."""
    masks = [(int(m), int(m).bit_count()) for m in _flips(bits, half)]
    steps = F.array(*(F.struct(F.lit(m).cast("bigint").alias("m"), F.lit(n).alias("n")) for m, n in masks))
    reached = rows.select("print", "own", "left", start.alias("start"), F.explode(steps).alias("x")).where("x.n <= left")
    return reached.select("print", (F.col("start") + F.col("own").bitwiseXOR(F.col("x.m"))).alias("range"), (F.col("left") - F.col("x.n")).alias("left"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node in ``edges`` (``a``, ``b``): the smallest node it is connected to.

    Alternates large and small stars until nothing changes; each round is written to the shared folder. A node with very many
    neighbours costs a combined minimum and a join that adaptive execution can split.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    # `b` hangs on the smaller `a`
    now = materialise(edges.where("a != b").select(low.alias("a"), high.alias("b")).distinct(), "links")
    while True:
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.where("a != b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        small = small.where("a != b").distinct()
        new = materialise(small, "links")
        # a forest of stars is done: no node hangs on one node and holds another
        inner = new.select(F.col("a").alias("node")).join(new.select(F.col("b").alias("node")), "node", "left_semi")
        twice = new.groupBy("b").count().where("count > 1")
        now = new
        if inner.isEmpty() and twice.isEmpty():
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())


def _links_of_texts(stored: DataFrame, prints: int, radius: int) -> DataFrame:
    """Links ``a``, ``b`` between first fingerprints: of texts that any of their fingerprints bring within ``radius`` bits.

    The fingerprints of each number are linked by themselves. A fingerprint that texts of several first ones share stands for the
    smallest of those, and links each of the others to it.
    """
    names = _print_names(prints)
    different = materialise(stored.select(*names).distinct(), "fingerprints")
    found = None
    for name in names:
        own = different.groupBy(F.col(name).alias("print")).agg(F.min("__print").alias("rep"), F.max("__print").alias("top"))
        own = materialise(own, "fingerprints")
        near = links(own.select("print"), own.count(), radius)
        for side in ("a", "b"):
            rep = own.select(F.col("print").alias(side), F.col("rep").alias(f"rep_{side}"))
            near = near.join(rep, side)
        near = near.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
        shared = own.where("rep != top").select(F.col("print").alias(name), F.col("rep").alias("b"))
        if name != "__print":
            near = near.unionAll(different.join(shared, name).select(F.col("__print").alias("a"), "b"))
        near = materialise(near, "edges")
        found = near if found is None else found.unionAll(near)
    return found


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, prints: int = 1) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits, the first one) and ``component_id`` of every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; a component's id is its smallest doc_id. With several ``prints``, documents
    link if any of their fingerprints do: what one misses of pairs that are less alike, the others may find, at the price
    of one search each. Fingerprints have 64 bits whatever the number, so texts that aren't alike stay apart. Equal fingerprints are
    gathered before anything is compared, so exact copies cost one fingerprint. Texts without words (nulls too) have
    fingerprint zero and link like any other. Null doc_ids are kept, and name a component only if it has no other.
    """
    stored = materialise(with_fingerprint(docs, ["doc_id"], shingle, prints), "fingerprints")
    first = stored.groupBy(F.col("__print").alias("print")).agg(F.min("doc_id").alias("first"))
    first = materialise(first, "fingerprints")
    # sizes of files are known without reading: the count comes from their footers
    edges = links(first.select("print"), first.count(), radius) if prints == 1 else _links_of_texts(stored, prints, radius)
    joined = components(edges)
    rooted = joined.join(first, joined.node == first.print).select("print", "root", "first")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("id"))
    linked = rooted.join(smallest, "root").select(F.col("print").alias("p"), "id")
    named = first.join(linked, F.col("print") == F.col("p"), "left").select(
        F.col("print").alias("__print"), F.coalesce("id", "first").alias("component_id")
    )
    # written, so that both sides of the last join are plain shuffles and a common fingerprint's partition can be split
    named = materialise(named, "components")
    text = F.lower(F.lpad(F.hex("__print"), 16, "0"))
    return stored.join(named, "__print").select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4, prints: int = 1) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group of near-duplicates.

    Where several rows carry that doc_id, or a whole component has no doc_id, all of them stay.
    """
    kept = near_duplicates(docs, radius, shingle, prints).where("doc_id <=> component_id").select("doc_id").distinct()
    there = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
    return docs.alias("d").join(kept.alias("k"), there, "left_semi").select("d.*")
