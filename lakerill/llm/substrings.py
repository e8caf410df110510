"""Substring deduplication by Rabin-Karp hashes of every window of words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import batches_of_text, pack, pack_steps, unpack, unpack_steps, with_fields, word_codes, words

#: The base of the polynomial, odd, so that it has an inverse modulo 2**64; and what it is raised to at most at once.
_BASE = 0x9E3779B97F4A7C15
_NO_ID = (1 << 63) - 1  # a null doc_id counts as the largest
BLOCK = 3 << 20  # bytes of text hashed at once in a task
#: Windows that meet in one group at most, on average; about 60 bytes of memory each.
GROUP = 1_000_000
_SHARD = "shard long, ids binary, sums binary, starts binary, at binary, hashes binary"
_ADDED = "n_words long, n_removed long, removed_spans array<struct<start: long, end: long>>"
_FLAGS = "id long, sum long, starts binary"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads the hashes over all high bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(codes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (in ``codes``) and Rabin-Karp hash of every window that stays in one document."""
    n = len(codes)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.flatnonzero(np.arange(n) + window <= ends)
    up, down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up, dtype=np.uint64)])
    return starts, _mix((sums[starts + window] - sums[starts]) * down[starts])


def _firsts(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash (then as given, ids rising), and for each place the smallest id of its hash."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return order, ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]


def _by_document(ids: np.ndarray, sums: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    order = np.lexsort((starts, sums, ids))
    ids, sums, starts = ids[order], sums[order], starts[order]
    cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (sums[1:] != sums[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(ids)]):
        if b > a:
            yield int(ids[a]), int(sums[a]), pack_steps(starts[a:b])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _shard_schema() -> pa.Schema:
    names = ("ids", "sums", "starts", "at", "hashes")
    return pa.schema([("shard", pa.int64()), *((n, pa.binary()) for n in names)])


def _shards(window: int, bits: int, block: int):
    """Per block of documents: its different windows, dealt to 2**bits shards by hash; and what the block itself settles.

    A window that several documents of the block have is sent once, for the smallest of them: however common it is, a
    shard gets it at most once per block. The others are known to be removed; they travel under a shard below zero.
    """
    width = 8 - bits // 8  # the bytes that the shard does not imply

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _shard_schema()
        for batch in batches_of_text(batches, "text", block):
            batch = batch.sort_by("id")
            doc_ids, doc_sums = (batch[c].to_numpy().astype(np.int64) for c in ("id", "sum"))
            codes, bounds = word_codes(batch["text"], lambda w: xxhash.xxh64_intdigest(w))
            flat, hashes = window_hashes(codes, bounds, window)
            if not len(flat):
                continue
            doc = np.searchsorted(bounds, flat, side="right") - 1
            order, first = _firsts(hashes, doc_ids[doc])
            late = doc_ids[doc[order]] > first
            known = order[late]
            rows = [
                (-1 - (i & _NO_ID) % _NO_ID, pack(np.array([i])), pack(np.array([s])), pack(np.array([0])), p, b"")
                for i, s, p in _by_document(doc_ids[doc[known]], doc_sums[doc[known]], flat[known] - bounds[doc[known]])
            ]
            sent = np.sort(order[~late])
            shard = (hashes[sent] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sent), np.int64)
            dealt = np.argsort(shard, kind="stable")
            sent, shard = sent[dealt], shard[dealt]
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for part in np.split(sent, cuts):
                used = np.unique(doc[part])
                rows.append(
                    (
                        int(hashes[part[0]] >> np.uint64(64 - bits)) if bits else 0,
                        pack_steps(doc_ids[used]),
                        pack(doc_sums[used], 4),
                        pack_steps(bounds[used]),
                        pack_steps(flat[part]),
                        pack(hashes[part], width),
                    )
                )
            yield _rows(rows, schema)
            pa.default_memory_pool().release_unused()

    return run


def _settle(width: int):
    def run(group: pa.Table) -> pa.Table:
        """Flags the windows of one shard that a smaller document has too."""
        schema = pa.schema([("id", pa.int64()), ("sum", pa.int64()), ("starts", pa.binary())])
        out: list[tuple[int, int, bytes]] = []
        ids, sums, starts, hashes = [], [], [], []
        for row in group.to_pylist():
            if row["shard"] < 0:
                out.append((int(unpack(row["ids"]).view(np.int64)[0]), int(unpack(row["sums"])[0]), row["at"]))
                continue
            begin, at = unpack_steps(row["starts"]).astype(np.int64), unpack_steps(row["at"]).astype(np.int64)
            k = np.searchsorted(begin, at, side="right") - 1
            ids.append(unpack_steps(row["ids"]).view(np.int64)[k])
            sums.append(unpack(row["sums"], 4).astype(np.int64)[k])
            starts.append(at - begin[k])
            hashes.append(unpack(row["hashes"], width))
        if ids:
            ids, sums, starts, hashes = map(np.concatenate, (ids, sums, starts, hashes))
            by_id = np.argsort(ids, kind="stable")
            ids, sums, starts, hashes = ids[by_id], sums[by_id], starts[by_id], hashes[by_id]
            order, first = _firsts(hashes, ids)
            late = order[ids[order] > first]
            out += _by_document(ids[late], sums[late], starts[late])
        return pa.Table.from_batches([_rows(out, schema)] if out else [], schema)

    return run


def _apply(window: int, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_text(batches, "text", BLOCK):
            texts, totals, removed, spans = batch["text"].to_pylist(), [], [], []
            for i, flags in enumerate(batch["__flags"].to_pylist()):
                parts = words(texts[i])
                totals.append(len(parts))
                if not flags:
                    removed.append(0)
                    spans.append([])
                    continue
                starts = np.concatenate([unpack_steps(f) for f in flags]).astype(np.int64)
                step = np.zeros(len(parts) + 1, np.int64)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                spans.append([{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
                removed.append(int(gone.sum()))
                texts[i] = b" ".join(parts[j] for j in np.flatnonzero(~gone)).decode()
            cols = [pa.array(texts, pa.string()) if n == "text" else batch[n] for n in names]
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            more = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(cols + more, names=[*names, "n_words", "n_removed", "removed_spans"])

    return run


def remove_repeated(docs: DataFrame, window: int = 50, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts in a document with a smaller doc_id.

    Every window of every text is hashed (Rabin-Karp, a polynomial modulo 2**64 over 64-bit word codes). Blocks of
    documents (``block`` bytes of text) send each of their different windows once to a shard of the hash space, packed; a shard holds about ``group``
    windows and finds the smallest document of each. Flagged starts go back to their document, where overlapping windows
    merge into maximal intervals. The text crosses the network once, for that last step.

    Returns the rows and columns of ``docs`` (``doc_id``, ``text``, any others) plus ``n_words``, ``n_removed`` and
    ``removed_spans`` (half-open word intervals); columns of these names are replaced. A text that loses words becomes the
    kept words joined by one space; any other stays as it is, a null a null. A null doc_id counts as larger than all others.
    Rows that share a doc_id do not remove from one another. Windows are the same if their 64-bit hashes are: of n different
    windows n**2 / 2**65 pairs are expected to be taken for one another.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "removed_spans")]
    keyed = docs.select(
        *names,
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("__id"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("__sum"),
    )
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, int(np.ceil(np.log2(max(1, chars / 6 / group)))))
    shards = keyed.select(F.col("__id").alias("id"), F.col("__sum").alias("sum"), "text").mapInArrow(
        _shards(window, bits, block), _SHARD
    )
    flags = shards.groupBy("shard").applyInArrow(_settle(8 - bits // 8), _FLAGS)
    flags = flags.groupBy(F.col("id").alias("__id"), F.col("sum").alias("__sum")).agg(
        F.collect_list("starts").alias("__flags")
    )
    joined = keyed.join(flags.hint("shuffle_hash"), ["__id", "__sum"], "left").select(*names, "__flags")
    schema = with_fields(docs.select(*names).schema, _ADDED)
    return joined.mapInArrow(_apply(window, names), schema)


def digest(docs: DataFrame, window: int = 50) -> DataFrame:
    """What ``remove_repeated`` did, one row per document: words, words removed, hash of the kept words."""
    joined = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return remove_repeated(docs.select("doc_id", "text"), window).select(
        "doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256")
    )
