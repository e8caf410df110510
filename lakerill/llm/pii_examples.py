"""Labelled examples of personal data, made by rules: the table that the model of ``pii`` is fitted to."""

from __future__ import annotations

import random
from collections.abc import Callable

# What examples are made of. ``#`` is a digit, ``9`` a digit but 0.
_WORDS = (
    "the report was sent and nobody could read it because our server moved to another room last week so we left them"
    " der Bericht und die Zahlen sind noch nicht fertig el informe no está listo le rapport est en retard"
).split()
_NAMES = "john maria peter.smith anna_k li.wei j.doe sales info42 karl-heinz support admin claire88".split()
_HOSTS = "mail example company web-shop uni post inbox acme provider kontor".split()
_ENDS = "com org net de fr es io edu co.uk info".split()
_CALLS = ["tel.", "phone:", "call me at", "fax", "Telefon", "móvil", "mobile", "ring", "", "", ""]
_CARDS = ["card", "my visa is", "Kreditkarte", "tarjeta", "pay with", "", ""]
_HOST_WORDS = ["server", "ip", "host", "ping", "address", "", ""]
_MAIL_WORDS = ["mail", "write to", "contact", "e-mail:", "reach me:", "", ""]
_PHONES = [
    "(9##) 9##-####", "9##-9##-####", "9##.9##.####", "1-9##-9##-####", "0049 ## #######", "0## #######", "0###/######", "0##-########",
    "0# ## ## ## ##", "6## ### ###", "+9# ## #### ####", "+1 (9##) 9##-####", "+1 (###) 555-####", "001 9## 9## ####", "9## 9## ####",
    "(0##) #### ####", "(0##) #######", "0### ### ####",
]
_NOT_NUMBERS = [
    "20##-0#-1#", "1#.0#.20##", "20##-0#-1# 1#:##:##", "version 9.#.##", "order 9#########", "invoice 20######", "page 9##-9##",
    "9 ### ###", "9##.###.###", "ISBN 978-#-##-######-#", "9####-####", "ticket no. 9#######", "ref 0#########", "17########",
    "9 9 9 9 9 9 9 9 9 9", "id 9#########", "## ## ##", "9#:## 9#:##", "9###", "9## 9##", "section 9.#.9.#.9", "release 9.##.###.####",
    "9#,## 9#,## 9#,##", "9############", "account 9##########", "9###-9### 9###-9###", "since 19## 20## 20##", "9.9 9.9 9.9 9.9",
    "IBAN DE## #### #### #### #### ##", "FR## #### #### #### #### #### ###", "9##### 0#### 9#### 0####",
]
_NOT_MAILS = [
    "we meet at noon dot", "look at this.file", "arrive at home.", "the a at the dot in it", "price @ 3.50", "at example.com",
    "is at work.Then", "see you at lunch . Bye", "was at once", "look (at) it", "it stays at the.", "meet us at office.The",
]

Example = tuple[str, list[tuple[str, int, int]]]


def _fill(pattern: str, rng: random.Random) -> str:
    return "".join(str(rng.randrange(10)) if c == "#" else str(rng.randrange(1, 10)) if c == "9" else c for c in pattern)


def _check_digit(digits: str) -> str:
    """The digit that makes a card number of ``digits`` and it right."""
    total = sum(map(int, digits[-2::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[::-2])
    return str(-total % 10)


def card_digits(rng: random.Random, good: bool = True) -> str:
    start = rng.choice(["4", "51", "55", "37", "6011", "9", "7"])
    length = 15 if start == "37" else 16
    digits = start + "".join(str(rng.randrange(10)) for _ in range(length - 1 - len(start)))
    last = int(_check_digit(digits))
    return digits + str(last if good else (last + rng.randrange(1, 10)) % 10)


def _grouped(digits: str, sign: str) -> str:
    cuts = [0, 4, 10, 15] if len(digits) == 15 else range(0, 17, 4)
    edges = list(cuts)
    return sign.join(digits[a:b] for a, b in zip(edges, edges[1:]))


def _card(rng: random.Random) -> str:
    digits = card_digits(rng)
    return _grouped(digits, rng.choice([" ", "-", ".", "  ", " - ", "/"])) if rng.random() < 0.75 else digits


def _address(rng: random.Random, most: int = 255) -> list[str]:
    return [str(rng.randrange(most + 1)) for _ in range(4)]


def _ip(rng: random.Random) -> str:
    return rng.choice([".", "[.]", " . ", "(.)", "[dot]", " [.] "]).join(_address(rng))


def _mail(rng: random.Random) -> str:
    name, host, end = rng.choice(_NAMES), rng.choice(_HOSTS), rng.choice(_ENDS)
    if rng.random() < 0.2:
        host += "." + rng.choice(_HOSTS)
    at, dot = rng.choice(
        [("@", "."), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" @ ", "."), (" AT ", " DOT "), ("[@]", "."),
         (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", " . "), ("{at}", "{dot}")]
    )
    whole = f"{host}.{end}".replace(".", dot)
    return (name.replace(".", dot) if dot.strip().lower() == "dot" else name) + at + whole


_MADE: dict[str, tuple[Callable[[random.Random], str], list[str]]] = {
    "email": (_mail, _MAIL_WORDS),
    "ip": (_ip, _HOST_WORDS),
    "card": (_card, _CARDS),
    "phone": (lambda rng: _fill(rng.choice(_PHONES), rng), _CALLS),
}


def _nothing(rng: random.Random) -> str:
    kind = rng.randrange(5)
    if kind == 0:
        return rng.choice(_NOT_MAILS)
    if kind == 1:
        digits = card_digits(rng, good=False)
        return digits if rng.random() < 0.6 else _grouped(digits, rng.choice(" -."))
    if kind == 2:
        parts = _address(rng)
        parts[rng.randrange(4)] = str(rng.randrange(256, 1000))
        return rng.choice([".", "[.]", " . ", " "]).join(parts)
    return _fill(rng.choice(_NOT_NUMBERS), rng)


def training(n: int = 700, seed: int = 7) -> list[Example]:
    """``n`` texts with the spans (kind, start, end) of what they hold: one or two entities, neighbours among them, or none."""
    rng, examples = random.Random(seed), []
    for _ in range(n):
        text, spans = "".join(f"{w} " for w in rng.choices(_WORDS, k=rng.randrange(0, 4))), []
        if rng.random() < 0.4:
            text += _nothing(rng) + " "
        else:
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                kind = rng.choice(list(_MADE))
                make, cues = _MADE[kind]
                cue = rng.choice(cues) if not spans or rng.random() < 0.3 else ""
                text += f"{cue} " if cue else ""
                found = make(rng)
                spans.append((kind, len(text), len(text) + len(found)))
                text += found + rng.choice([" ", " ", ", ", ". "])
        text += " ".join(rng.choices(_WORDS, k=rng.randrange(0, 3)))
        examples.append((text, spans))
    return examples
