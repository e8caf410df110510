"""Best-fit packing of tokenized documents into sequences, improved by local search."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import with_fields

#: Pieces that are packed together on average.
GROUP = 4096
_CACHE = 200_000  # chunks of text whose ids a worker remembers,
_CACHED = 48  # none of them longer than this, which bounds the bytes too
_CHUNK = re.compile(r" (?=\S)")
_WIDE = re.compile(r" (?!\S)")
_PIECE = "piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long"


@lru_cache(maxsize=2)
def _encoder(path: str, added: bool = False):
    """Ids of a text as 32-bit integers, as the byte-level BPE tokenizer file at ``path`` gives them; no token is put around it.

    With ``added``, the file's added tokens inside the text have their own ids, as in the tokenizers library; without, they are
    ordinary text. The rank file beside it holds the same vocabulary for a faster library. The tokenizer starts anew at each space before
    a word, so the text is cut there, and the ids of frequent chunks are remembered.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as f:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    class Known(dict):
        def __missing__(self, chunk: str) -> bytes:
            found = array("I", encode(" " + chunk)).tobytes()
            if len(chunk) <= _CACHED and len(self) < _CACHE:
                self[chunk] = found
            return found

    known = Known()

    def ids(text: str) -> bytes:
        first, *rest = _CHUNK.split(text) if _WIDE.search(text) else text.split(" ")
        return array("I", encode(first)).tobytes() + b"".join(map(known.__getitem__, rest))

    own = _added_tokens(path) if added else {}
    if not own:
        return ids
    parts = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")")

    def ids_with_added(text: str) -> bytes:
        # every second part is an added token
        return b"".join(own[p] if i % 2 else ids(p) for i, p in enumerate(parts.split(text)) if p)

    return ids_with_added


def _added_tokens(path: str) -> dict[str, bytes]:
    """The added tokens of a tokenizer file and their ids; only plain ones, which match wherever they stand."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens") or []
    for t in tokens:
        if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
            raise ValueError(f"the added token {t['content']!r} takes more than its own characters")
    return {t["content"]: array("I", [t["id"]]).tobytes() for t in tokens}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens; the first takes what full pieces leave."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((i, capacity) for i in range(first, n, capacity))]


def _pieces(path: str, capacity: int, end: int, names: list[str], added: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = _encoder(path, added), array("I", [end]).tobytes()
        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch["__text"]):
                ids = encode(text.as_py() or "") + last
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(i)
                    found.append((k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            if not row:
                continue
            cols = [batch[n].take(pa.array(row)) for n in names]
            made = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols + made, names=[*names, "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that takes it; bins of places in ``lengths``."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        with_room[room - size].append(k)
        rooms |= 1 << (room - size)
    return bins


def _gives(members: list[int], lengths: list[int]) -> list[tuple[int, ...]]:
    """What a bin can give: one or two of its documents for each total length, since documents of one length are alike.

    The lengths add up to a bin's fill, so its distinct ones, and with them their pairs, are few however many documents it has.
    """
    alike: dict[int, list[int]] = {}
    for i in members:
        alike.setdefault(lengths[i], []).append(i)
    found = {n: (same[0],) for n, same in alike.items()}
    sizes = list(alike)
    for a, m in enumerate(sizes):
        if len(alike[m]) > 1:
            found.setdefault(2 * m, (alike[m][0], alike[m][1]))
        for n in sizes[:a]:
            found.setdefault(m + n, (alike[m][0], alike[n][0]))
    return list(found.values())


def local_search(lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty bins by moving documents and exchanging one for one or two for one between underfull bins.

    The emptiest bin gives: each step moves a document of it to another bin, or exchanges one or two for one there, such that
    the other bin grows by the most it can. The giver is never the fuller of the two, so the squared fill increases with every
    step, which ends the search. A bin that gives its last document is gone. The search ends when no bin can give any more, or at
    the least number of bins that the total allows.
    """
    size = np.array(lengths, np.int64)
    bins = [list(b) for b in bins]
    fill = np.array([size[b].sum() for b in bins], np.int64)
    where = np.zeros(len(size), np.int64)
    for k, b in enumerate(bins):
        where[b] = k
    least, n = -(-int(size.sum()) // capacity), len(bins)
    open_items = np.flatnonzero(fill[where] < capacity)
    stuck: set[int] = set()
    while n > least:
        under = [k for k in np.flatnonzero(fill < capacity).tolist() if bins[k] and k not in stuck]
        if not under:
            break
        giver = min(under, key=lambda k: fill[k])
        while bins[giver]:
            others = open_items[(where[open_items] != giver) & (fill[where[open_items]] < capacity)]
            others = others[fill[where[others]] >= fill[giver]]
            room = capacity - fill[where[others]]
            gives = _gives(bins[giver], lengths)
            best, step = 0, None
            for out in gives:
                given = int(size[list(out)].sum())
                gain = np.where(given - size[others] <= room, given - size[others], 0)
                if len(gain) and gain.max() > best:
                    best, step = int(gain.max()), (out, int(others[gain.argmax()]))
                if len(out) == 1 and len(room):
                    fits = np.flatnonzero(room >= given)
                    if len(fits) and given > best:
                        tight = fits[room[fits].argmin()]
                        best, step = given, (out, -1 - int(where[others[tight]]))
            if step is None:
                stuck.add(giver)
                break
            out, back = step
            taker = int(where[back]) if back >= 0 else -1 - back
            for i in out:
                bins[giver].remove(i)
                bins[taker].append(i)
                where[i] = taker
            if back >= 0:
                bins[taker].remove(back)
                bins[giver].append(back)
                where[back] = giver
            fill[giver] -= best
            fill[taker] += best
        if not bins[giver]:
            n -= 1
            fill[giver] = capacity  # out of the search
    return [b for b in bins if b]


def _place(capacity: int, order: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, ignore_index=True)  # the same bins if the task runs again
        lengths = group["length"].tolist()
        part = [i for i, n in enumerate(lengths) if n < capacity]
        short = [lengths[i] for i in part]
        bins = [[i] for i, n in enumerate(lengths) if n >= capacity]
        bins += [[part[i] for i in b] for b in local_search(short, best_fit(short, capacity), capacity)]
        sequence, offset = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        for k, b in enumerate(bins):
            sequence[b] = k
            offset[b] = np.cumsum([0, *(lengths[i] for i in b[:-1])])
        number = group.pop("__group").to_numpy(np.int64)
        return group.assign(sequence_id=(number << 32) + sequence, offset=offset)

    return run


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, group: int = GROUP, added: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` tokens as local search finds.

    A document is its ids and then ``end``; one of more than ``capacity`` ids is cut into full pieces after a shorter first
    one. ``tokenizer`` names a byte-level BPE file whose rank file (.tiktoken) lies beside it; with
    ``added``, its added tokens inside a text have their own ids, else they are ordinary text. Each document leaves at most one
    piece that is not full. Pieces are dealt by hash to groups of about ``group`` (of full ones as many again), and each group is packed by itself: best
    fit, then moves and exchanges until no bin can be emptied. A group wastes less than a sequence or so, whatever the size of
    the table, and its task's memory does not grow. Groups are dealt by doc_id and content, so a common source or text is
    spread; only rows with equal doc_id and text share a group.

    Returns a row per piece: the columns of ``docs`` but ``text`` (and those named as below), ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``. Null and empty texts are one token. Repeated rows are packed each.
    """
    made = {"text", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    names = [c for c in docs.columns if c not in made]
    schema = docs.select(*names).schema
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    # a document has one piece that isn't full, and full ones by its length: some four bytes a token
    groups = max(1, -(-rows // group), size // (4 * capacity * group))
    pieces = docs.select(*names, F.col("text").alias("__text")).mapInArrow(
        _pieces(tokenizer, capacity, end, names, added), with_fields(schema, _PIECE)
    )
    number = F.pmod(F.xxhash64("doc_id", "ids_crc32", "piece"), F.lit(groups))
    order = ["doc_id", "piece", "ids_crc32", "length"]
    groups = pieces.withColumn("__group", number).groupBy("__group")
    return groups.applyInPandas(_place(capacity, order), with_fields(schema, _PLACED))
