"""Source divergence audit: how far the sources of a language are apart, by a frequent-pattern tree of term rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Shares are counted in these; every kept term is taken to occur so many times more than it does.
UNIT, PRIOR = 1_000_000_000, 5
#: Bytes of text whose terms a task counts at once, about; cells of a block of term rows; pair sums that a task holds.
_BLOCK, _CELLS, _HELD = 6 << 20, 1 << 19, 1 << 20

_COUNTS = "lang string, source string, term string, n long, docs long"
_SUMS = "lang string, i int, j int, value long"
#: Everything that is no letter of A-Z and below 128 parts terms; A-Z become a-z.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str) -> bytes:
    """The terms of a text, parted by spaces: runs of letters and of whatever is not ASCII, A-Z lower-cased."""
    return text.encode().translate(_TERMS)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms and of documents per language and source, and a row without a term for each of these.

    The texts of some batches are counted together: terms are numbered by Arrow, and numbers of (source, term) and of
    (document, term) are sorted and counted.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > _BLOCK:
            yield _counted(held)
            held, size = [], 0
    if held:
        yield _counted(held)


def _counted(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    # a code per language and source, and where each has its first row
    lang, source = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    pair = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
    _, first, group = np.unique(pair, return_index=True, return_inverse=True)
    n_groups = len(first)
    lists = pc.ascii_split_whitespace(pa.array([terms(x.as_py()) for x in rows["text"]], pa.large_binary()).cast(pa.large_string()))
    flat, doc = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    coded, doc = flat.filter(real).dictionary_encode(), doc.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    code, n_terms = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(coded.dictionary))
    keys, n = np.unique(group[doc] * n_terms + code, return_counts=True)
    once = np.unique(doc * n_terms + code)
    _, docs = np.unique(group[once // n_terms] * n_terms + once % n_terms, return_counts=True)  # the same keys
    at = pa.array(np.concatenate([first, first[keys // n_terms]]))
    term = pa.concat_arrays([pa.nulls(n_groups, pa.large_string()), coded.dictionary.take(pa.array(keys % n_terms))])
    none = np.zeros(n_groups, np.int64)
    columns = [rows[c].combine_chunks().take(at) for c in ("lang", "source")] + [term.cast(pa.string())]
    columns += [pa.array(np.concatenate([none, x])) for x in (n, docs)]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _share(n: str | Column, size: str | Column) -> Column:
    """A term's share of ``size`` words, in billionths, by whole numbers of any length."""
    n, size = (F.col(c) if isinstance(c, str) else c for c in (n, size))
    units = F.lit(UNIT).cast("decimal(10,0)") * (n + PRIOR).cast("decimal(20,0)")
    return F.call_function("div", units, size.cast("decimal(20,0)")) + 1


def _tree(items: np.ndarray, length: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair corrections of a frequent-pattern tree: pairs of source numbers (the larger in the low bits) and their sums.

    ``items`` (number, count, size by row and place) are sorted term rows, ``many`` how often each occurs. At every depth a
    node is a run of rows that agree up to there, and its multiplicity the number of these. A node meets each of its
    ancestors once, however many rows share it, and its correction counts as often as its multiplicity.
    """
    number, count, size = items
    share, zero = 1 + UNIT * (count + PRIOR) // size, 1 + UNIT * PRIOR // size
    if int(count.max(initial=0)) > (1 << 63) // UNIT - PRIOR - 1:  # beyond 64 bits, with whole numbers of any length
        share = np.array([1 + UNIT * (int(n) + PRIOR) // int(d) for n, d in zip(count.ravel(), size.ravel())], np.int64).reshape(count.shape)
    rows = np.arange(len(length))
    differs = np.ones(len(length), bool)
    differs[1:] = False
    keys, sums = [], []
    for depth in range(items.shape[2]):
        there = length > depth
        # a new node where this place or one above it differs from the row before
        differs[1:] |= (number[1:, depth] != number[:-1, depth]) | (count[1:, depth] != count[:-1, depth])
        starts = rows[there & differs]
        if not len(starts):
            break
        times = np.add.reduceat(np.where(there, many, 0), rows[differs])[there[differs]]
        p, z, s = share[starts, depth], zero[starts, depth], number[starts, depth]
        for above in range(depth):
            q, y, r = share[starts, above], zero[starts, above], number[starts, above]
            keys.append(r << 32 | s)
            sums.append((np.abs(q - p) - np.abs(q - z) - np.abs(y - p) + np.abs(y - z)) * times)
    none = [np.zeros(0, np.int64)]
    return _added(np.concatenate(keys or none), np.concatenate(sums or none))


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, at, values)
    return found, sums


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of pair corrections of sorted term rows, a tree per block of rows; a node cut by a block's border counts in both."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (keys, sums) in held.items():
            arrays = [pa.array([lang] * len(keys), pa.string()), pa.array((keys >> 32).astype(np.int32))]
            arrays += [pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "i", "j", "value"])
        held.clear()

    for batch in batches:
        paths, langs, many = batch["path"], batch["lang"].to_pylist(), batch["m"].to_numpy()
        length = pc.list_value_length(paths).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(length)
        fields = [paths.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        a = 0
        while a < len(langs):
            b, widest = a, 1
            while b < len(langs) and langs[b] == langs[a] and (b == a or (b - a + 1) * max(widest, length[b]) <= _CELLS):
                widest = max(widest, int(length[b]))
                b += 1
            items = np.full((3, b - a, widest), -1, np.int64)
            items[2] = 1
            place = np.arange(ends[b - 1] - (ends[a] - length[a])) - np.repeat(ends[a:b] - length[a:b] - (ends[a] - length[a]), length[a:b])
            row = np.repeat(np.arange(b - a), length[a:b])
            for i in range(3):
                items[i, row, place] = fields[i][ends[a] - length[a] : ends[b - 1]]
            found = _tree(items, length[a:b], many[a:b])
            before = held.get(langs[a], (np.zeros(0, np.int64),) * 2)
            held[langs[a]] = _added(*(np.concatenate(x) for x in zip(before, found)))
            a = b
            if sum(len(k) for k, _ in held.values()) > _HELD:
                yield from flush()
    yield from flush()


def _tree_sums(rows: DataFrame) -> DataFrame:
    """``lang``, ``i``, ``j`` (i < j, numbers of sources) and ``value``, the corrections of terms that both sources have.

    ``rows`` (``lang``, ``path``: number, count and size of each source that has the term, by number). Equal rows become one with
    their number before anything is sorted; then ranges of the sorted rows are inserted into a tree, range by range.
    """
    distinct = rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("m"))
    # written, since cutting ranges reads its input twice; the cuts go by how a row begins, which keeps the sample of them small
    ranges = materialise(distinct, "paths").repartitionByRange("lang", F.slice("path", 1, 3), F.xxhash64("path"))
    ranges = ranges.sortWithinPartitions("lang", "path")
    return ranges.mapInArrow(_walk, _SUMS).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def _alone(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``i``, ``j`` and ``value``: |p - z| summed over the terms of i, p its share there, z a missing term's in j.

    The shares of a source and the z of all others are sorted together, equal ones as one with their number; running counts and
    sums then give every z its sum. A source has few different counts (their sum is its size), so its window is small.
    """
    shares = kept.groupBy("lang", "i", "p").agg(F.count(F.lit(1)).alias("m"))
    shares = shares.select("lang", "i", F.col("p").alias("x"), "m", F.lit(None).cast("int").alias("j"))
    a, b = groups.select("lang", F.col("s").alias("i")), groups.select("lang", F.col("s").alias("j"), F.col("z").alias("x"))
    # as many rows as the result has: every source and every other of its language
    probes = a.join(b, "lang").where("i != j").select("lang", "i", "x", F.lit(0).cast("bigint").alias("m"), "j")
    own = Window.partitionBy("lang", "i")
    before = own.orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = shares.unionByName(probes).select(
        "lang", "i", "j", "x",
        F.sum("m").over(before).alias("low"), F.sum(F.col("m") * F.col("x")).over(before).alias("low_sum"),
        F.sum("m").over(own).alias("all"), F.sum(F.col("m") * F.col("x")).over(own).alias("all_sum"),
    ).where("j is not null")
    value = F.col("x") * (2 * F.col("low") - F.col("all")) - 2 * F.col("low_sum") + F.col("all_sum")
    return sums.select("lang", "i", "j", value.alias("value"))


def audit(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """How far each source of a language is from every other, and which terms it has more of than its language.

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased (``terms``); a language keeps those in at least ``least``
    of its documents. A source's share p of a kept term is 1 + floor(10^9 (count + 5) / (N + 5 V)), N its kept words and V the
    language's kept terms. Returns ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for ``pair`` an item is
    another source and the value the summed |p - q|, for ``term`` (the ``top`` first ones) a term the source has and its p - q
    over the language's q, where that is positive.

    The sum over terms is that of terms neither source has, plus what a term changes that one of them has, plus what it
    changes further if both have it. The last part comes from the tree of term rows (``_walk``), the others from counts of equal
    shares. Nulls in text, lang and source are empty; every row is a document, equal ones too; a source without terms has its
    pairs; a language without kept terms has pairs of value 0; a table without rows gives none.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # counted per block of texts before they are dealt; a language's row without a term has its sources
    counts = rows.mapInArrow(_count, _COUNTS).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    stored = materialise(by_term.where(F.col("term").isNull() | (F.col("docs") >= least)).drop("docs"), "terms")
    by_term = stored.where("term is not null")

    sizes = by_term.select("lang", F.explode("held").alias("x")).groupBy("lang", F.col("x.source").alias("source"))
    sizes = sizes.agg(F.sum("x.n").alias("words"), F.count(F.lit(1)).alias("own_terms"))
    langs = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_words"))
    groups = stored.where("term is null").select("lang", F.explode("held.source").alias("source")).join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    groups = groups.select("lang", "source", *map(zero, ("terms", "lang_words", "words", "own_terms")))
    # a row per source of a language, in which only their number grows
    groups = groups.withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    size, lang_size = (F.col(c) + PRIOR * F.col("terms") for c in ("words", "lang_words"))
    groups = groups.withColumns({"size": size, "lang_size": lang_size})
    groups = materialise(groups.withColumn("z", F.when(size > 0, _share(F.lit(0), "size")).otherwise(0)), "groups")

    known = groups.select("lang", "source", "s", "size", "lang_size")
    kept = by_term.select("lang", "term", "total", F.explode("held").alias("x"))
    kept = kept.select("lang", "term", "total", "x.source", "x.n").join(known, ["lang", "source"])
    kept = kept.withColumns({"p": _share("n", "size"), "q": _share("total", "lang_size")})

    paths = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("s", "n", "size"))).alias("path"))
    both = _tree_sums(paths)
    one = _alone(groups, kept.select("lang", F.col("s").alias("i"), "p"))
    least_first = [F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")]
    changed = both.unionByName(one.select("lang", *least_first, "value")).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))
    a = groups.select("lang", F.col("s").alias("i"), F.col("source").alias("a"), "terms", F.col("own_terms").alias("a_terms"), F.col("z").alias("a_z"))
    b = groups.select("lang", F.col("s").alias("j"), F.col("source").alias("b"), F.col("own_terms").alias("b_terms"), F.col("z").alias("b_z"))
    # every pair of a language has a row: each source is probed for each other one
    pairs = changed.join(a, ["lang", "i"]).join(b, ["lang", "j"])
    rest = F.abs(F.col("a_z") - F.col("b_z")) * (F.col("terms") - F.col("a_terms") - F.col("b_terms"))
    value = F.when(F.col("terms") > 0, F.col("value") + rest).otherwise(0).cast("bigint")
    two = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")))
    pairs = pairs.select("lang", value.alias("value"), F.explode(two).alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    more = kept.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    first = more.withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(first)
