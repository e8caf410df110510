"""Quality rules as a ledger: every rule is evaluated once, policies are applied to the stored bits."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import with_fields

SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long,"
    " n_upper long, n_letters long"
)
_NAMES = [f.split()[0] for f in MEASURES.split(",")]
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_SPACE = b" \t\n\x0b\x0c\r"
_GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
#: Texts of more bytes are measured by numbered words, which give the same and take a tenth of the memory.
_LONG = 1 << 20


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # an SQL condition over the measures


#: The place of a rule is its bit. Never reorder or reuse; append.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("shouting", "2 * n_upper > n_letters"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
)
#: Versions of the policy: the rules that count. A published version never changes.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "shouting"),
    "v2": tuple(r.name for r in RULES),
}


def repeat_words(parts: Sequence[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that are found twice or more, the first one included."""
    windows = list(zip(*(parts[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen: set[tuple] = set()
    twice: set[tuple] = set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    total = end = 0
    for i, w in enumerate(windows):
        if w in twice:
            total += i + width - max(i, end)
            end = i + width
    return total


def word_numbers(raw: bytes, block: int = _LONG) -> np.ndarray:
    """The words of a text as numbers, equal words with equal ones; the text is split block by block."""
    known: dict[bytes, int] = {}
    found = array("I")
    start = 0
    while start < len(raw):
        cut = start + block
        if cut < len(raw):
            # up to the end of the word that the block cuts
            cut = min((e.start() for e in [_GAP.search(raw, cut)] if e), default=len(raw))
        found.extend(known.setdefault(w, len(known)) for w in raw[start:cut].split())
        start = cut
    return np.frombuffer(found, np.uint32) if found else np.zeros(0, np.uint32)


def repeat_words_numbered(words: np.ndarray, width: int = 5) -> int:
    """As ``repeat_words``, of numbered words, in a few numbers per word: windows get numbers of their own, one word wider at a time."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    base = int(words.max()) + 1
    windows = words[:n].astype(np.int64)
    for i in range(1, width):
        # at most n numbers of windows times ``base`` of words: far below 2**63
        windows *= base
        windows += words[i : i + n]
        windows = np.unique(windows, return_inverse=True)[1]
    twice = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i : i + n] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    raw = (text or "").encode()
    if len(raw) > _LONG:
        words = word_numbers(raw)
        n_words, repeated = len(words), repeat_words_numbered(words)
    else:
        parts = raw.split()
        n_words, repeated = len(parts), repeat_words(parts)
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    inside = len(text or "") - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    return (
        n_words,
        inside,
        sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LETTERS)),
    )


def _measures(names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*(measure(t.as_py()) for t in batch["__text"])) if batch.num_rows else [[]] * len(_NAMES)
            cols = [pa.array(c, pa.int64()) for c in found]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *cols], names=[*names, *_NAMES])

    return run


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns of ``docs`` but ``text`` (and those named as below), the measures, and ``failures``: a bit for each rule that fails.

    Null and empty texts have no words and fail ``few_words``; repeated rows are measured each. No shuffle: one pass over the texts, once for all policies.
    """
    names = [c for c in docs.columns if c not in ("text", "failures", *_NAMES)]
    rows = docs.select(*names, F.col("text").alias("__text"))
    rows = rows.mapInArrow(_measures(names), with_fields(docs.select(*names).schema, MEASURES))
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), 1 << i).otherwise(0).cast("bigint"))
    return rows.withColumn("failures", bits)


def mask(policy: str, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def passes(policy: str, rules: Sequence[Rule] = RULES):
    """A condition on a ledger: no rule of the policy fails."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")) == 0


def ablations(ledger: DataFrame, policy: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail nothing else, and that the policy without it would keep.

    Documents are first counted by their failure bits: at most 2**rules rows meet, however many documents there are.
    """
    whole = mask(policy, rules)
    counts = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("bigint")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    used = F.array(
        *(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
          for i, r in enumerate(rules) if whole >> i & 1)
    )
    rows = counts.select("bits", "n", F.explode(used).alias("r"))
    bit = F.col("r.bit")
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == bit, F.col("n"))), F.lit(0)).alias("failed_alone"),
        F.sum(F.when(F.col("bits").isin(0) | (F.col("bits") == bit), F.col("n")).otherwise(0)).alias("kept_without"),
    )
