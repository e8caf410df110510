"""URL filters: host and path rules, and a classifier of hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import with_fields

# Words of which names of unwanted hosts are made, what they are joined with, and words of ordinary hosts.
UNWANTED = (
    "casino poker slots jackpot lottery roulette betting bets gamble pills pharma viagra meds adult porn xxx cams escort spam ads adserver"
    " banner popup tracker track pixel clickbait loans payday replica warez malware phish"
).split()
JOINED = "online win free cheap best bonus cash now buy hot club farm links vip deals king pro world top x".split()
WANTED = (
    "garden library museum history science cooking travel station nation weather journal school zeitung wetter schule museo ciudad"
    " noticias maison histoire cuisine voyage mairie gemeinde verein kirche university institute hospital theater concert football"
    " recipes mountain river planet energy climate language letters village council government railway airport bicycle painting"
    " teacher student research archive society reader writing thermal tension nothing brother weather another together"
).split()
_ORDINARY = "news club house center open my our new daily city land net art book room world".split()
# Sounds of made-up names, which stand for the many hosts whose words nobody knows.
_ONSETS, _VOWELS, _CODAS = "b br d f g h k l m n p r s st t th v w z".split(), "a e i o u ai ou ea".split(), "n r s t nd ng l nt th".split()
_MADE_UP = 240
_BITS = 14


def _made_up(i: int) -> str:
    """A name of two or three syllables."""
    sounds = []
    for k in range(2 + i % 2):
        n = i * 7 + k * 11
        sounds.append(_ONSETS[n % len(_ONSETS)] + _VOWELS[(n // 3) % len(_VOWELS)] + (_CODAS[(n // 5) % len(_CODAS)] if (i + k) % 3 else ""))
    return "".join(sounds)


def labelled_names() -> list[tuple[str, int]]:
    """Host names of the labelled table: words of either kind alone and joined with some others, and made-up names; 1 is unwanted."""
    rows = [(_made_up(i), 0) for i in range(_MADE_UP)]
    for label, words, others in ((1, UNWANTED, JOINED), (0, WANTED, _ORDINARY)):
        for i, word in enumerate(words):
            mates = [others[(i * 5 + 3 * k) % len(others)] for k in range(4)]
            joined = [f"{word}-{mates[0]}", f"{mates[1]}-{word}", f"{word}{mates[2]}", f"{mates[3]}{word}"]
            rows += [(name, label) for name in [word, *joined]]
    return rows


def labelled_urls(names: Sequence[tuple[str, int]] | None = None) -> list[tuple[str, int]]:
    """The labelled table: each name under some prefixes, domains and paths; 1 is unwanted."""
    prefixes, domains = ("", "www.", "m.", "blog."), ("example.com", "example.org", "example.net")
    paths = ("/", "/en/123", "/de/4567/", "/fr/89.html", "/es/2345", "/about", "/en/777?page=2")
    names = labelled_names() if names is None else names
    return [
        (f"http://{prefixes[k]}{name}.{domains[(i + k) % 3]}{paths[(i + 2 * k) % 7]}", label)
        for i, (name, label) in enumerate(names)
        for k in range(4)
    ]


def split_url(url: str | Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path; both empty for a null or what has no ://."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _parts(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2].partition("?")[0].partition("#")[0]
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def grams(host: str, path: str) -> set[int]:
    """Buckets of the 3- to 5-grams of host and path; digits are alike."""
    out = set()
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        text = "".join("0" if c.isdigit() else c for c in text)
        for n in (3, 4, 5):
            out.update(crc32(f"{kind}{text[i : i + n]}".encode("utf-8", "surrogatepass")) >> (32 - _BITS) for i in range(len(text) - n + 1))
    return out


def train(rows: Sequence[tuple[str, int]], steps: int = 800, rate: float = 0.7, ridge: float = 1e-4) -> np.ndarray:
    """Weights by bucket, the bias last: logistic regression by gradient descent."""
    inputs = [np.array(sorted(grams(*_parts(url)))) for url, _ in rows]
    y = np.array([label for _, label in rows], float)
    at, who = np.concatenate(inputs), np.repeat(np.arange(len(inputs)), [len(x) for x in inputs])
    scale = 1 / np.sqrt(np.array([len(x) for x in inputs]))
    w, bias = np.zeros(1 << _BITS), 0.0
    for _ in range(steps):
        z = np.bincount(who, w[at], len(inputs)) * scale + bias
        error = (1 / (1 + np.exp(-z)) - y) / max(1, len(y))
        w -= rate * len(inputs) ** 0.5 * (np.bincount(at, (error * scale)[who], 1 << _BITS) + ridge * w)
        bias -= rate * error.sum()
    return np.append(w, bias).astype(np.float32)


def best_rule(host: str, path: str, rules: Mapping[str, Sequence[tuple[str, str]]]) -> tuple[str, str] | None:
    """The longest rule (rule, verdict) that fits; of two as long the one with the longer host."""
    best, suffix = None, host
    while suffix:
        for start, verdict in rules.get(suffix, ()):
            if path.startswith(start) and (best is None or len(suffix + start) > len(best[0])):
                best = (suffix + start, verdict)
        suffix = suffix.partition(".")[2]
    return best


def _judge(rules: Mapping[str, Sequence[tuple[str, str]]], weights: np.ndarray, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, verdicts, scores = [], [], []
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist()):
                at = np.fromiter(grams(host, path), np.int64)
                z = float(weights[at].sum()) / max(1, len(at)) ** 0.5 + float(weights[-1])
                rule = best_rule(host, path, rules)
                scores.append(1 / (1 + np.exp(-z)))
                found.append(rule and rule[0])
                verdicts.append(rule[1] if rule else "block" if z >= 0 else "allow")
            more = [pa.array(found, pa.string()), pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *more], names=[*names, "rule", "verdict", "score"])

    return run


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    labelled: Sequence[tuple[str, int]] | None = None,
    url: str = "url",
) -> DataFrame:
    """The columns of ``pages`` and ``host``, ``path``, ``rule``, ``verdict``, ``score`` (columns of these names are replaced).

    ``rules``: (host and path, "block" or "allow"), at most 100,000 of them, sent with the tasks. A rule fits its host and
    all subdomains if the path starts with the rule's; the longest wins. Where none fits, a logistic regression on hashed
    character n-grams of host and path decides, trained on the small table ``labelled`` (url, 1 if unwanted); ``score`` is
    its probability of being unwanted. No shuffle. Null urls and those without :// have empty host and path.
    """
    if len(rules) > 100_000:
        raise ValueError("too many rules to send with every task")
    index: dict[str, list[tuple[str, str]]] = {}
    for rule, verdict in rules:
        host, slash, rest = rule.partition("/")
        index.setdefault(host, []).append((slash + rest, verdict))
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    host, path = split_url(url)
    rows = pages.select(*names, host.alias("host"), path.alias("path"))
    schema = with_fields(rows.schema, "rule string, verdict string, score double")
    weights = train(labelled_urls() if labelled is None else labelled)
    return rows.mapInArrow(_judge(index, weights, rows.columns), schema)
