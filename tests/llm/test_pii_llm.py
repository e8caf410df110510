import hashlib
import re

import pytest
from helpers_llm import awkward, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from lakerill.llm import pii, pii_examples, suite_llm


def plain(text):
    """The patterns as they are stated, by Python's own backtracking."""
    digits = lambda t: re.sub(r"[^0-9]", "", t)

    def luhn(t):
        total = 0
        for i, d in enumerate(reversed([int(x) for x in digits(t)])):
            d = d * 2 if i % 2 else d
            total += d - 9 if d > 9 else d
        return total % 10 == 0

    text = text or ""
    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return {
        "email": email,
        "ip": [m.span() for m in ips if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in cards if 13 <= len(digits(m[0])) <= 19 and luhn(m[0])],
        "phone": [m.span() for m in phones if 9 <= len(digits(m[0])) <= 15],
    }


def as_dict(spans):
    return {k: sorted((a, b) for kind, a, b in spans if kind == k) for k in pii.KINDS}


PIECES = ["a", "b.c", "@", ".", "-", "+", "1", "22", "255.", "300", " ", "(", ")", "4111111111111111", "%", "é", "\n", "0049", "_", "0000"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_patterns_are_those_stated(text):
    assert as_dict(pii.patterns(text)) == plain(text)


def test_patterns_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1.2." * 20_000, "1 " * 40_000, "a@" * 100_000, "+1" + " ()" * 100_000, "@" * 200_000):
        pii.patterns(text)
        pii.decode(text, pii.model())


def best_by_trial(found, weights, text):
    """All sets of candidates that do not overlap, scored one by one."""
    best = (0.0, [])

    def go(i, chosen):
        nonlocal best
        if i == len(found):
            score, last = 0.0, None
            for s, e, kind, features in chosen:
                near = last[2] if last and pii._linked(text, last[1], s) else ""
                score += sum(weights.get(f, 0.0) for f in features) + weights.get(f"{near}>{kind}", 0.0)
                last = (s, e, kind)
            if score > best[0] + 1e-9:
                best = (score, [(k, s, e) for s, e, k, _ in chosen])
            return
        go(i + 1, chosen)
        if not chosen or chosen[-1][1] <= found[i][0]:
            go(i + 1, [*chosen, found[i]])

    go(0, [])
    return best[1]


def test_decoding_finds_the_best_set():
    weights, seen = pii.model(), 0
    for text, _ in pii_examples.training(300, seed=3):
        found = list(pii.candidates(text))
        if len(found) <= 13:
            seen += len(found) > 2
            assert pii.decode(text, weights) == best_by_trial(found, weights, text), text
    assert seen > 50


HELD_OUT = [
    ("ring the office on (020) 7946 0018 today", ["(020) 7946 0018"]),
    ("Tel: 212-555-0187", ["212-555-0187"]),
    ("our hotline 0800 123 4567 is free", ["0800 123 4567"]),
    ("send it to jane [at] contoso [dot] com", ["jane [at] contoso [dot] com"]),
    ("me: bob AT initech DOT net.", ["bob AT initech DOT net"]),
    ("john dot smith at gmail dot com is gone", ["john dot smith at gmail dot com"]),
    ("ana(at)correo.es", ["ana(at)correo.es"]),
    ("mail jane.roe @ contoso.com now", ["jane.roe @ contoso.com"]),
    ("the box at 10[.]0[.]0[.]17 fails", ["10[.]0[.]0[.]17"]),
    ("amex 3782 822463 10005", ["3782 822463 10005"]),
    ("5555.5555.5555.4444", ["5555.5555.5555.4444"]),
    ("paid by 4111111111111111 5555555555554444", ["4111111111111111", "5555555555554444"]),
    ("see +1 (826) 555-4081 190.137.223.204", ["190.137.223.204", "+1 (826) 555-4081"]),
    ("born 12.03.1987 in room 204", []),
    ("in 1998 2003 2011 and 2020", []),
    ("total 1 234 567 890", []),
    ("call me at 6 pm at cafe dot", []),
    ("build 10.0.19045.3803", []),
    ("IBAN DE89 3704 0044 0532 0130 00", []),
    ("2021-03-04 12:33:21", []),
    ("lat 48.137154 lon 11.576124", []),
    ("UUID 123e4567-e89b-12d3-a456-426614174000", []),
    ("token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", []),
    ("4111111111111112 is no card", []),
]


def test_held_out_texts():
    right = 0
    for text, want in HELD_OUT:
        got = [text[a:b] for _, a, b, _ in pii.spans_of(text, pii.model())]
        right += got == want
    assert right >= 0.9 * len(HELD_OUT)


def test_held_out_examples():
    found = wanted = both = 0
    for text, spans in pii_examples.training(1000, seed=99):
        got = set(pii.decode(text, pii.model()))
        found, wanted, both = found + len(got), wanted + len(spans), both + len(got & set(spans))
    assert both > 0.95 * found and both > 0.95 * wanted


def test_added_spans_leave_the_patterns_alone():
    for text, _ in pii_examples.training(300, seed=5):
        base = pii.patterns(text)
        spans = pii.spans_of(text, pii.model())
        assert sorted(s[:3] for s in spans if not s[3]) == sorted(base)
        added = [s for s in spans if s[3]]
        assert not any(a[1] < b[2] and b[1] < a[2] for a in added for b in spans if a is not b)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


def test_long_tables_of_numbers_decode_as_their_parts():
    parts = [text for text, _ in pii_examples.training(40, seed=11)]
    filler = " and then nothing at all happened "
    whole, want = "", []
    for text in parts * 20:
        want += [(k, a + len(whole), b + len(whole)) for k, a, b in pii.decode(text + filler, pii.model())]
        whole += text + filler
    got = pii.decode(whole, pii.model())
    # cue words of the part before are the only thing that may reach over
    assert len(set(got) ^ set(want)) <= 0.02 * len(want)


def digest(text, model):
    base = plain(text)
    joined = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k])
    spans = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in pii.spans_of(text or "", model))
    return (*(len(base[k]) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest(), spans)


@pytest.mark.parametrize("source", ["documents", "awkward"])
def test_query(spark, folder, source):
    docs = documents(spark) if source == "documents" else awkward(spark, ["spans", "kind", "start", "added", "n_email"])
    docs.write.parquet(f"{folder}/documents.parquet")
    got = suite_llm.op13_pii(spark, folder)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    model = pii.model()
    want = [(r.doc_id, *digest(r.text, model)) for r in docs.collect()]
    assert sorted((tuple(r)[:-1] for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table_and_names(spark):
    assert pii.digest(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        pii.find(empty(spark).withColumnRenamed("lang", "spans"), ["spans"])
