"""Toxicity: noisy-channel restoration of disguised words, then scores learnt from labels."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .text import batches_of_text, with_fields

#: Letters of the language model; any other counts as the last one. Fixed value.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
#: What a character may stand for besides itself. Fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
_SIZE = len(LETTERS) + 2  # the boundary is 0, an unknown letter the last
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_LEET_COST, _REPEAT_COST, _DROP_COST, _RARE_COST, _SPLIT_COST = log(5), log(4), log(3), log(2000), log(20)
_CACHE = 150_000
_EDGE = re.compile(r"^[^\w@$]+|[^\w]+$|^[@$]+(?=[@$]|$)")
_MARKS = ".,;:!?\"'()[]{}#*$%&|<>-_=+~/\\"
_TWICE, _TRIPLE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")
_SIGNS = "".join(c for c in LEET if not c.isdigit())
#: Signs stand for letters at the end of a word only where the word would be this short without them.
_SHORT = 3
_ODD = re.compile(r"(.)\1\1|[^\W\d_][\W\d_]+[^\W\d_]|^[@$0-9|!+(<€£]+[^\W\d_]|[^\W\d_][0-9]+$")
_SPACED = re.compile(r"(?<!\S)(?:[\w@$!|+][\x20\x09-\x0D.\-_*]+){2,}[\w@$!|+](?!\S)")
_GAPS = re.compile(r"[\x20\x09-\x0D]+")


# ---- language model


def _letter_codes() -> np.ndarray:
    """Per code point below 0x300 its number in the model; white space is the boundary."""
    table = np.full(0x300, _SIZE - 1, np.int64)
    for c, code in _CODE.items():
        table[ord(c)] = code
    table[[9, 10, 11, 12, 13, 32]] = 0
    return table


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, grams = _letter_codes(), np.zeros(_SIZE**3, np.int64)
    for batch in batches_of_text(batches, "text", 1 << 20):
        text = "\n".join(["", "", *(t for t in batch["text"].to_pylist() if t), ""]).lower()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        code = table[np.minimum(points, 0x2FF)]
        last, now = code[1:-1], code[2:]
        before = np.where(last == 0, 0, code[:-2])  # a word begins anew
        gram = ((before * _SIZE + last) * _SIZE + now)[(last > 0) | (now > 0)]
        grams += np.bincount(gram, minlength=_SIZE**3)
    used = np.flatnonzero(grams)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(grams[used])], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """-log P(letter | two letters before) from all words of all texts, smoothed.

    Trigram counts are added up per task and then per trigram; the driver gets at most 60**3 of them, however large the corpus.
    """
    counts = docs.select("text").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = np.zeros(_SIZE**3)
    got = counts.toPandas()
    table[got["gram"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    table = table.reshape(_SIZE, _SIZE, _SIZE)
    single = table.sum(axis=(0, 1)) + 1
    double = table.sum(axis=0) + 20 * (single / single.sum())[None, :]
    double /= double.sum(axis=1, keepdims=True)
    triple = table + 20 * double[None]
    return -np.log(triple / triple.sum(axis=2, keepdims=True)).astype(np.float32)


# ---- decoding


def lattice(token: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """Per run of a character: what it may stand for, and the cost. "" drops it, " " ends a word there.

    In a token whose letters were written ``apart`` a word may end after any of them.
    """
    out = []
    runs = [(m.group(1), len(m.group())) for m in re.finditer(r"(.)\1*", token, re.S)]
    for c, n in runs:
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options.append((c, 0.0 if n == 1 else _REPEAT_COST * (n > 2)))
            if n > 1:
                options.append((c + c, 0.0 if n == 2 else _REPEAT_COST))
        else:
            for x in LEET.get(c, ""):
                options.append((x, _LEET_COST))
                if n > 1:
                    options.append((x + x, _LEET_COST))
            if c in LEET:
                options += [("", _RARE_COST), (" ", _RARE_COST)]  # a number or sign beside a word
            else:
                options += [("", _DROP_COST), (" ", 0.0)]
        out.append(options)
        if apart:
            out.append([("", 0.0), (" ", _SPLIT_COST)])
    return out


def restore(token: str, model: np.ndarray, apart: bool = False) -> str:
    """The likeliest reading of a token of any length, by Viterbi over its lattice; a state is the last two letters.

    A state's path is a chain that shares its beginning with the others, so a long token takes time and memory in proportion.
    """
    best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}
    for options in lattice(token.lower(), apart):
        after: dict[tuple[int, int], tuple] = {}
        for (a, b), (cost, path) in best.items():
            for letters, price in options:
                state, total = (a, b), cost + price
                for c in letters:
                    if c == " ":
                        if state != (0, 0):
                            total += float(model[state[0], state[1], 0])
                            state = (0, 0)
                        continue
                    code = _CODE.get(c, _SIZE - 1)
                    total += float(model[state[0], state[1], code])
                    state = (state[1], code)
                if state not in after or total < after[state][0]:
                    after[state] = (total, (path, letters) if letters else path)
        best = after
    ends = [(cost + (float(model[a, b, 0]) if (a, b) != (0, 0) else 0.0), path) for (a, b), (cost, path) in best.items()]
    least = min(cost for cost, _ in ends)
    return min(_read(path) for cost, path in ends if cost == least)


def _read(path: tuple | None) -> str:
    parts = []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


def read_token(token: str, model: np.ndarray) -> list[str]:
    """The words that a lower-case token may stand for: itself without marks around it, and a restored reading if it looks odd.

    A token of letters that begins with a sign of ``LEET``, or ends with one after a few letters, keeps its plain reading beside the
    restored one and the one with a letter for each sign; one that doubles a letter also stands for itself with each
    doubled letter, and with all of them, written once. Any may be meant.
    """
    core = token.strip(_MARKS)
    if not core.isalpha():
        core = _EDGE.sub("", token)
        return restore(core, model).split() if core and _ODD.search(core) else [core]
    start = token.index(core)
    before, after = token[:start], token[start + len(core) :]
    lead = before[len(before.rstrip(_SIGNS)) :]
    tail = after[: len(after) - len(after.lstrip(_SIGNS))] if len(core) < _SHORT else ""
    if _TRIPLE.search(core):
        return restore(lead + core + tail, model).split()
    readings = [core]
    if lead or tail:
        whole = lead + core + tail
        readings += ["".join(LEET.get(c, c)[0] for c in whole), *restore(whole, model).split()]
    doubled = list(_TWICE.finditer(core))
    if doubled:
        readings += [core[: m.start()] + core[m.start() + 1 :] for m in doubled] + [_TWICE.sub(r"\1", core)]
    return list(dict.fromkeys(readings))


def spaced_words(text: str, model: np.ndarray) -> list[str]:
    """Words written with their letters apart, in lower-case text.

    Read as one word, with words ended wherever that is likelier, and without the first or last letter, which may be a word
    of its own that stands beside them.
    """
    found = []
    for m in _SPACED.finditer(text):
        letters = _GAPS.sub("", m.group())
        if len(set(letters)) > 2:  # one letter over and over is no word
            found += restore(letters, model).split() + restore(letters, model, apart=True).split()
            found += [w for part in (letters[1:], letters[:-1]) for w in restore(part, model).split()]
    return list(dict.fromkeys(found))


# ---- scores


def features(word: str) -> list[str]:
    """The word and its beginnings of four to six letters, which inflected forms share."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]


def _feature_counts(model: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_text(batches, "text", 2 << 20):
            counts: dict[str, list[int]] = {}
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                text = text.lower()
                found = {w for t in set(text.split()) for w in read_token(t, model)}.union(spaced_words(text, model))
                for f in {f for w in found for f in features(w)}:
                    counts.setdefault(f, [0, 0])[label] += 1
            if counts:
                clean, toxic = zip(*counts.values())
                cols = [pa.array(list(counts)), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["feature", "clean", "toxic"])

    return run


class _Scores(dict):
    """Scores of tokens, remembered up to a bound."""

    def __init__(self, model: np.ndarray, lexicon: dict[str, float]):
        self.model, self.lexicon = model, lexicon

    def of(self, words: list[str]) -> float:
        return max((self.lexicon.get(f, 0.0) for w in words for f in features(w)), default=0.0)

    def __missing__(self, token: str) -> float:
        score = self.of(read_token(token, self.model))
        if len(self) < _CACHE:
            self[token] = score
        return score

    def strongest(self, text: str | None) -> list[float]:
        """The three highest scores of a text's tokens, and how many score at all."""
        text = (text or "").lower()
        top = list(filter(None, map(self.__getitem__, set(text.split()))))
        top += filter(None, (self.of([w]) for w in spaced_words(text, self.model)))
        top.sort(reverse=True)
        return [*(top + [0.0, 0.0, 0.0])[:3], log(1 + len(top))]


def _measure(model: np.ndarray, lexicon: dict[str, float], weights: np.ndarray | None, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(model, lexicon)
        for batch in batches:
            x = np.array([scores.strongest(t.as_py()) for t in batch["__text"]]).reshape(-1, 4)
            cols = [batch[n] for n in names]
            if weights is None:
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(x[:, i]) for i in range(4))], names=[*names, *"abcd"])
            else:
                score = 1 / (1 + np.exp(-np.clip(x @ weights[:4] + weights[4], -30, 30)))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(score)], names=[*names, "score"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights and bias by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w)), x.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id), F.lit(5))


class Scorer:
    """A fitted model: language model, lexicon of scored features, weights of the document measures."""

    def __init__(self, model: np.ndarray, lexicon: dict[str, float], weights: np.ndarray):
        self.model, self.lexicon, self.weights = model, lexicon, weights

    def score(self, docs: DataFrame) -> DataFrame:
        """The columns of ``docs`` but ``text`` (and ``score``, replaced) and ``score``, 0 to 1; nulls score as empty texts."""
        names = [c for c in docs.columns if c not in ("text", "score")]
        schema = with_fields(docs.select(*names).schema, "score double")
        rows = docs.select(*names, F.col("text").alias("__text"))
        return rows.mapInArrow(_measure(self.model, self.lexicon, self.weights, names), schema)


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000, least_documents: int = 3) -> Scorer:
    """Learn from the labels of documents outside the held-out fold (crc32 of the id modulo 5 is 0).

    The language model reads all texts. The classifier is fitted on at most about ``most`` labelled documents, those of the
    lowest hashes: two thirds of them count in how many toxic and clean documents each feature occurs, which gives
    the lexicon (features of ``least_documents`` toxic ones or more, of which chance makes about one), the rest weigh
    the measures of a document. The lexicon is bounded by the sample: it has features of these documents alone. Equal texts count once. Rows without label, id or text are left out of the fit.
    Without labels of both kinds every score is the share of toxic labels, or 0.
    """
    model = language_model(docs)
    marked = labels.where("toxic in (0, 1) and doc_id is not null").where(fold("doc_id") != 0)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    n = marked.count()
    chosen = marked.where(place < F.lit(int(min(1.0, most / max(1, n)) * (1 << 30))))
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = texts.groupBy(F.xxhash64("text").alias("h"), F.crc32("text").alias("c")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")
    )
    part = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string")) / 5), F.lit(3))
    sample = sample.withColumn("part", part)
    teach = sample.where("part != 0").select("text", "toxic")
    counts = teach.mapInArrow(_feature_counts(model), "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = dict(teach.groupBy("toxic").count().collect())
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    share = toxic / max(1, toxic + clean)
    if not toxic or not clean:
        return Scorer(model, {}, np.array([0, 0, 0, 0, 30.0 if share else -30.0]))
    n, k = F.col("toxic") + F.col("clean"), F.col("toxic")
    # Chernoff: by chance, so many toxic ones among n have a probability of exp(-surprise) at most
    rest = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - share))).otherwise(0.0)
    surprise = k * F.log(k / n / share) + rest
    odds = F.log((k + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    counts = materialise(counts.where(k >= least_documents), "features")
    far = counts.where((k > n * share) & (surprise > log(max(2, counts.count()))))
    rows = far.select("feature", odds.alias("odds")).where("odds > 1")
    words = {f: float(s) for f, s in rows.collect()}
    check = sample.where("part = 0").select("toxic", F.col("text").alias("__text"))
    got = check.mapInArrow(_measure(model, words, None, ["toxic"]), "toxic long, a double, b double, c double, d double")
    x = got.toPandas().sort_values(list("abcd"))
    if x["toxic"].nunique() < 2:
        return Scorer(model, words, np.array([1.0, 0.5, 0.25, 0.0, log(share / (1 - share)) - 1]))
    return Scorer(model, words, _logistic(x[list("abcd")].to_numpy(), x["toxic"].to_numpy(np.float64)))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    scorer = fit(docs, labels)
    names = list(docs.columns)
    rows = docs.select(*names, F.col("text").alias("__text"))
    schema = with_fields(docs.schema, "__score double")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _measure(scorer.model, scorer.lexicon, scorer.weights, names)
        for b in measure(batches):
            yield b.rename_columns([*names, "__score"])

    return rows.mapInArrow(score, schema).where(F.col("__score") < threshold).drop("__score")
