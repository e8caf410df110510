"""Personal data: exact patterns, and a semi-Markov conditional random field for the spellings that they miss."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush, merge
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pii_examples
from .text import with_fields

KINDS = ("email", "ip", "card", "phone")
_SPANS = "__spans array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"

Span = tuple[str, int, int]

# -- patterns -------------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# where a match can't start inside a run, starting only at its first digit finds the same and takes linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def patterns(text: str) -> list[Span]:
    """The spans that the patterns find: leftmost, not overlapping per kind; matches that fail their check are dropped."""
    found = list(emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 40 and 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


# -- candidates and their features ----------------------------------------------------------------

#: An entity has at most so many groups of digits, or pieces of a host.
GROUPS, PIECES = 8, 5
_RUN = re.compile(r"[0-9]+")
_SEPARATOR = re.compile(r"[\s().\[\]/–·+-]{1,4}|\s?[\[(](?:dot|DOT|\.)[\])]\s?")
_AT = re.compile(r"\s{0,2}[\[({<]\s?(?:at|AT|@)\s?[\])}>]\s{0,2}|\s(?:at|AT)\s|\s?@\s?")
_DOT = re.compile(r"\.(?=[A-Za-z0-9])|\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\s\.\s")
_PIECE = re.compile(r"[A-Za-z0-9-]{1,63}")
_NAME = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\Z")
_WORD_DOT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{1,64}(?:\s(?:dot|DOT)\s|\s?[\[({<]\s?(?:dot|DOT)\s?[\])}>]\s?)\Z")

# Words and endings that tell what stands next to them.
_CUES = {
    "mail": "mail email e-mail contact write reach courriel correo adresse address mailto".split(),
    "phone": "tel phone call fax mobile telefon telefono teléfono téléphone móvil handy cell dial ring whatsapp hotline".split(),
    "card": "card visa mastercard amex credit kreditkarte carte tarjeta debit pan".split(),
    "ip": "ip host server address ping addr gateway dns router node".split(),
    "other": "version isbn order invoice section page pages article id no nr ref number ticket issue chapter year since".split(),
}
_ENDINGS = frozenset("com org net edu gov info io de fr es it uk eu us ch at nl co biz dev app ca au br".split())
_COMMON = frozenset("the a an is are was be it this that look meet me us here home work once least all you we they of on in".split())


def _shape(kinds: Iterable[str]) -> str:
    seen = sorted(set(kinds))
    return seen[0] if len(seen) == 1 else "mixed" if seen else "none"


def _cue(text: str, start: int) -> str:
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", text[max(0, start - 40) : start].lower())[-3:]
    return next((name for w in reversed(words) for name, known in _CUES.items() if w in known), "none")


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    def kind(c: str) -> str:
        return "end" if not c else "space" if c.isspace() else "word" if c.isalnum() or c == "_" else c

    return kind(text[start - 1 : start]), kind(text[end : end + 1])


def _beside(text: str, start: int, end: int) -> tuple[bool, bool]:
    """Whether a digit is next to a span, but for one or two separators."""
    before, after = text[max(0, start - 3) : start].rstrip(" .-/()"), text[end : end + 3].lstrip(" .-/()")
    return before[-1:].isdigit(), after[:1].isdigit()


def _numbers(text: str, blocked: list[tuple[int, int]]) -> Iterator[tuple]:
    """Candidates of digit groups: up to ``GROUPS`` groups with separators between, as phone, card or ip."""
    runs: list[tuple[int, int]] = []
    at = 0

    def grow(i: int) -> Iterator[tuple]:
        first, groups, separators = runs[i][0], [], []
        cue, total = "", 0
        for j in range(i, min(i + GROUPS, len(runs))):
            a, b = runs[j]
            if j > i:
                separators.append(text[runs[j - 1][1] : a])
            groups.append(text[a:b] if b - a <= 19 else "0" * 20)
            total += b - a
            if total > 19:
                return
            if text[b : b + 1].isalpha() or text[b : b + 1] == "_":
                continue
            if total >= 4:
                cue = cue or _cue(text, first)
                yield from _number(text, first, b, groups, separators, total, cue)

    for m in _RUN.finditer(text):
        while at < len(blocked) and blocked[at][1] <= m.start():
            at += 1
        inside = at < len(blocked) and blocked[at][0] < m.end()
        if runs and (inside or not _SEPARATOR.fullmatch(text, runs[-1][1], m.start())):
            for i in range(len(runs)):
                yield from grow(i)
            runs = []
        if not inside and not (text[m.start() - 1 : m.start()].isalpha() or text[m.start() - 1 : m.start()] == "_"):
            runs.append(m.span())
            if len(runs) > 4 * GROUPS:  # a long table of numbers is worked through as it comes
                for i in range(len(runs) - GROUPS):
                    yield from grow(i)
                runs = runs[-GROUPS:]
    for i in range(len(runs)):
        yield from grow(i)


def _number(text: str, first: int, end: int, groups: list[str], separators: list[str], total: int, cue: str) -> Iterator[tuple]:
    lengths = [len(g) for g in groups]
    if total < 7 and len(groups) != 4:
        return
    shape = _shape("." if s == "." else "(.)" if "." in s or "ot" in s.lower() else s.strip() or " " for s in separators)
    wide = any(len(s) > 1 for s in separators)
    dates = lengths in ([4, 2, 2], [2, 2, 4], [4, 2, 2, 2, 2], [4, 2, 2, 2, 2, 2])
    thousands = len(lengths) > 1 and lengths[0] < 4 and set(lengths[1:]) == {3} and shape in (" ", ".")
    common = [f"sep={shape}", f"wide={wide}", f"groups={len(groups)}"]
    common += ["date"] * dates + ["thousands"] * thousands + ["zero"] * (groups[0] == "0")

    def made(kind: str, start: int, more: list[str]) -> tuple:
        left, right = _around(text, start, end)
        before, after = _beside(text, start, end)
        told = [*common, *more, f"cue={cue}", f"left={left}", f"right={right}", f"before={before}", f"after={after}"]
        return start, end, kind, [f"{kind}:{x}" for x in ("", *told)]

    if len(groups) == 4 and max(lengths) <= 3:
        octets = all(int(g) <= 255 for g in groups)
        dotted = all("." in s or "ot" in s.lower() for s in separators)
        yield made("ip", first, [f"octets={octets}", f"dotted={dotted}", f"valid={octets and dotted}"])
    if 13 <= total <= 19:
        digits = "".join(groups)
        good = luhn(digits)
        even = len(set(lengths[:-1])) <= 1
        issuer = bool(re.match(r"4|5[1-5]|3[47]|6|2[2-7]", digits))
        yield made("card", first, [f"luhn={good}", f"even={even}", f"issuer={issuer}", f"digits={total}", f"luhn,even={good and even}"])
    if 7 <= total <= 15:
        start = first
        if text[start - 1 : start] == "(" and ")" in text[first:end]:
            start -= 1
        if text[start - 1 : start] == "+":
            start -= 1
        opening = "+" if text[start] == "+" else "(" if text[start] == "(" else "00" if groups[0].startswith("00") else groups[0][0]
        opening = opening if opening in ("+", "(", "00", "0") else "digit"
        pattern = "-".join(map(str, lengths[-3:]))
        yield made("phone", start, [f"open={opening}", f"digits={total}", f"ends={pattern}", f"open,sep={opening}{shape}", f"longest={max(lengths)}"])


def _mails(text: str, blocked: list[tuple[int, int]]) -> Iterator[tuple]:
    """Candidates around what stands for an @: a name of dotted words before it, up to ``PIECES`` pieces of a host after it."""
    for at in _AT.finditer(text):
        name = _NAME.search(text[max(0, at.start() - 65) : at.start()])
        if not name:
            continue
        starts = [at.start() - len(name[0])]
        for _ in range(2):
            more = _WORD_DOT.search(text[max(0, starts[-1] - 75) : starts[-1]])
            if not more:
                break
            starts.append(starts[-1] - len(more[0]))
        ends, dots, pieces, place = [], [], [], at.end()
        while len(pieces) < PIECES and (piece := _PIECE.match(text, place)):
            pieces.append(piece[0])
            if dots:
                ends.append((piece.end(), [*dots], [*pieces]))
            dot = _DOT.match(text, piece.end())
            if not dot:
                break
            dots.append(dot[0])
            place = dot.end()
        if not ends:
            continue
        sign = "word" if at[0].strip().lower() == "at" else "bracket" if at[0].strip()[0] in "[({<" else "@"
        for start in reversed(starts):
            for end, dotted, parts in ends:
                if any(a < end and start < b for a, b in blocked):
                    continue
                style = _shape("." if d == "." else "bracket" if d.strip()[0] in "[({<" else "word" if "o" in d.lower() else " . " for d in dotted)
                first = text[start : at.start()].lower()
                left, right = _around(text, start, end)
                more = text[end : end + 1] and bool(_DOT.match(text, end) and _PIECE.match(text, _DOT.match(text, end).end()))
                told = [
                    f"at={sign}", f"dots={style}", f"at,dots={sign},{style}", f"ending={parts[-1].lower() in _ENDINGS}",
                    f"pieces={len(parts)}", f"common={first in _COMMON}", f"host={parts[0].lower() in _COMMON}", f"cue={_cue(text, start)}",
                    f"left={left}", f"right={right}", f"goes_on={bool(more)}", f"capital={parts[-1][:1].isupper() and not parts[-1].isupper()}",
                    f"names={start != starts[-1]}", f"inner_ending={any(p.lower() in _ENDINGS for p in parts[1:-1])}",
                ]
                yield start, end, "email", [f"email:{x}" for x in ("", *told)]


def candidates(text: str, taken: Iterable[Span] = ()) -> Iterator[tuple]:
    """Spans that might be entities, by start: (start, end, kind, features). None overlaps a span of ``taken``."""
    blocked: list[tuple[int, int]] = []
    for a, b in sorted((s[1], s[2]) for s in taken):
        if blocked and a < blocked[-1][1]:
            blocked[-1] = blocked[-1][0], max(b, blocked[-1][1])
        else:
            blocked.append((a, b))
    numbers = _numbers(text, blocked) if _DIGIT.search(text) else ()
    key = lambda c: (c[0], c[1], c[2])
    return merge(_in_order(numbers), _in_order(_mails(text, blocked)), key=key)


def _in_order(found: Iterable[tuple]) -> Iterator[tuple]:
    """Candidates by start: a phone number may start up to two characters before its first digit."""
    held: list[tuple] = []
    for i, c in enumerate(found):
        while held and held[0][0] < c[0] - 80:
            yield heappop(held)[-1]
        heappush(held, (c[0], c[1], c[2], i, c))
    while held:
        yield heappop(held)[-1]


# -- the model ------------------------------------------------------------------------------------

#: Labels of the chain: nothing, then the kinds.
_LABELS = ("", *KINDS)


def _linked(text: str, a: int, b: int) -> bool:
    """Whether two entities with this text between them are neighbours: a few characters, none a letter or digit."""
    return b - a <= 3 and not any(c.isalnum() for c in text[a:b])


def decode(text: str, weights: dict[str, float], taken: Iterable[Span] = ()) -> list[Span]:
    """The best set of entities: semi-Markov dynamic programming over segment boundaries and the label before them.

    A candidate segment scores the sum of its features' weights and a transition from the label of the entity that ends just
    before it (none if text stands between); everything outside entities scores zero. Segments are bounded, so only
    the states at ends that may still be followed by a neighbour or overlapped are held; a path is a chain of its entities.
    """
    # states at a boundary: label -> (score, end of its entity, chain)
    best: dict[str, tuple] = {"": (0.0, -1, None)}
    waiting: list[tuple] = []  # entities that end later: (end, number, label, score, chain)
    count = 0

    def settle(now: int) -> None:
        while waiting and waiting[0][0] <= now:
            end, _, label, score, path = heappop(waiting)
            move(end)
            if label not in best or score > best[label][0]:
                best[label] = (score, end, path)
        move(now)

    def move(now: int) -> None:
        # labels whose entity is no neighbour any more count as none
        for label in KINDS:
            state = best.get(label)
            if state and not _linked(text, state[1], now):
                del best[label]
                if state[0] > best[""][0]:
                    best[""] = (state[0], -1, state[2])

    for start, end, kind, features in candidates(text, taken):
        settle(start)
        score = sum(weights.get(f, 0.0) for f in features)
        came = max(((s[0] + weights.get(f"{label}>{kind}", 0.0), s[2]) for label, s in best.items()), key=lambda x: x[0])
        count += 1
        heappush(waiting, (end, count, kind, came[0] + score, (came[1], (kind, start, end))))
    settle(len(text) + 10)
    path, found = best[""][2], []
    while path:
        path, span = path
        found.append(span)
    return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


class _Lattice:
    """A labelled text as a graph of boundaries and labels, for training."""

    def __init__(self, text: str, spans: Iterable[Span], index: dict[str, int]):
        def number(name: str) -> int:
            return index.setdefault(name, len(index))

        self.edges: list[tuple] = []  # from, to, features; by their end
        segments = list(candidates(text))
        gold = {(s, e, k) for k, s, e in spans}
        places = sorted({0, *(c[0] for c in segments), *(c[1] for c in segments)})
        nodes: dict[tuple[int, str], int] = {(0, ""): 0}
        self.gold: dict[int, int] = {}
        by_start: dict[int, list[tuple]] = {}
        for c in segments:
            by_start.setdefault(c[0], []).append(c)
        for here, after in zip(places, [*places[1:], None]):
            labels = [x for x in _LABELS if (here, x) in nodes]
            for label in labels:
                node = nodes[here, label]
                for s, e, kind, features in by_start.get(here, ()):
                    to = nodes.setdefault((e, kind), len(nodes))
                    self.edges.append((here, e, node, to, [*map(number, features), number(f"{label}>{kind}")]))
                if after is not None:
                    kept = label if label and _linked(text, here, after) else ""
                    to = nodes.setdefault((after, kept), len(nodes))
                    self.edges.append((here, after, node, to, []))
        end = places[-1]
        self.finals = [n for (p, _), n in nodes.items() if p == end]
        self.size = len(nodes)
        # the features of the labelled path
        last, place = "", 0
        for s, e, kind in sorted(gold):
            found = next((c for c in segments if (c[0], c[1], c[2]) == (s, e, kind)), None)
            if found is None:
                raise ValueError(f"no candidate {text[s:e]!r} in {text!r}")
            before = last if last and _linked(text, place, s) else ""
            for f in [*map(number, found[3]), number(f"{before}>{kind}")]:
                self.gold[f] = self.gold.get(f, 0) + 1
            last, place = kind, e

    def expected(self, weights: list[float]) -> tuple[float, dict[int, float]]:
        """The logarithm of the sum over all paths, and how often each feature is expected."""
        low = -1e30
        ahead, behind = [low] * self.size, [low] * self.size
        ahead[0] = 0.0
        scores = [sum(weights[f] for f in e[4]) for e in self.edges]
        into: dict[int, list[int]] = {}
        out: dict[int, list[int]] = {}
        for i, e in enumerate(self.edges):
            into.setdefault(e[3], []).append(i)
            out.setdefault(e[2], []).append(i)
        for node in self._order():
            if node in into:
                ahead[node] = _log_sum([ahead[self.edges[i][2]] + scores[i] for i in into[node]])
        for node in self.finals:
            behind[node] = 0.0
        for node in reversed(self._order()):
            if node in out:
                behind[node] = _log_sum([behind[self.edges[i][3]] + scores[i] for i in out[node]])
        total = behind[0]
        counts: dict[int, float] = {}
        for i, (_, _, a, b, features) in enumerate(self.edges):
            if features:
                p = math.exp(min(0.0, ahead[a] + scores[i] + behind[b] - total))
                for f in features:
                    counts[f] = counts.get(f, 0.0) + p
        return total, counts

    def _order(self) -> list[int]:
        place = {0: 0}
        for _, end, _, to, _ in self.edges:
            place[to] = end
        return sorted(place, key=place.get)


@lru_cache(maxsize=1)
def model(rounds: int = 30, rate: float = 0.5, decay: float = 0.002) -> dict[str, float]:
    """Weights of a conditional random field, fitted to the labelled examples by their likelihood (adaptive gradient).

    The examples are a fixed table made by rules (``pii_examples.training``), so a session fits the same model every time.
    """
    index: dict[str, int] = {}
    lattices = [_Lattice(text, spans, index) for text, spans in pii_examples.training()]
    lattices = [x for x in lattices if x.edges]
    weights, squares = [0.0] * len(index), [1e-8] * len(index)
    block = 32
    for _ in range(rounds):
        for a in range(0, len(lattices), block):
            slope: dict[int, float] = {}
            for x in lattices[a : a + block]:
                for f, n in x.expected(weights)[1].items():
                    slope[f] = slope.get(f, 0.0) - n
                for f, n in x.gold.items():
                    slope[f] = slope.get(f, 0.0) + n
            for f, g in slope.items():
                g = g / block - decay * weights[f]
                squares[f] += g * g
                weights[f] += rate * g / math.sqrt(squares[f])
    return {name: weights[i] for name, i in index.items()}


# -- the operator ---------------------------------------------------------------------------------


def spans_of(text: str, weights: dict[str, float]) -> list[tuple[str, int, int, bool]]:
    """All spans of a text by kind and start; the last field tells whether the model added them."""
    base = patterns(text)
    added = decode(text, weights, base)
    found = chain(((*s, False) for s in base), ((*s, True) for s in added))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def _run(names: list[str], weights: dict[str, float]):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ([dict(zip(("kind", "start", "end", "added"), s)) for s in spans_of(x.as_py() or "", weights)] for x in batch["__text"])
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(found, kind)], names=[*names, "__spans"])

    return run


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``spans``: kind, start, end (code points, end exclusive) and whether the model added it.

    Patterns find e-mail addresses, IP addresses, card and phone numbers; the model adds what they miss (written-out or bracketed signs,
    numbers that run into each other, numbers without a country code) and never overlaps or removes what they found. Spans
    are ordered by kind as in ``KINDS``, then by start. Row by row and over whole texts: a null or empty text has no spans,
    equal rows have equal ones. No column of ``docs`` but the text is looked at; ``keep`` must not hold ``spans``.
    """
    if "spans" in keep:
        raise ValueError("spans is the name of the result")
    schema = with_fields(docs.select(*keep).schema, _SPANS)
    rows = docs.select(*keep, F.col(text).alias("__text")).mapInArrow(_run(keep, model()), schema)
    return rows.withColumnRenamed("__spans", "spans")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per document the spans of the patterns, counted by kind and digested, and all spans."""
    found = find(docs, ["doc_id"])
    base = F.filter("spans", lambda s: ~s["added"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    n_added = F.size(F.filter("spans", lambda s: s["added"])).cast("bigint")
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), n_added.alias("n_added")
    )
