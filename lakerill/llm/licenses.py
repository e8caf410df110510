"""License scans: a trained paragraph classifier, confirmed against license templates."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import with_fields

#: What a paragraph of each family says. Sentences of the public licenses and their usual notices.
TEMPLATES: Mapping[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is available under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL"
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        "SPDX-License-Identifier: ISC",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more"
        " details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
        " disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES,"
        " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
        " DISCLAIMED.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
#: Paragraphs about licenses that name no family. Fixed values.
UNRELATED = (
    "All rights reserved.",
    "See the license file for details.",
    "A driver's license is required for this work.",
    "The museum is open to the public, version three of the exhibition is free.",
    "Licensed dealers only.",
    "The university released a copy of the study under pressure.",
    "Terms and conditions apply to this software.",
    "Public works are subject to the following conditions.",
    "This work was published by a general foundation.",
    "The apache helicopter was released in a later version.",
    "Students at MIT wrote this program.",
    "The file is available, free of charge, at the library.",
    "Use in source and binary forms is common.",
)
UNKNOWN = "unknown"
_WORD = re.compile(r"[A-Za-z0-9]+(?:[-.'][A-Za-z0-9]+)*")
_FOUND = "array<struct<paragraph: long, family: string, probability: double, similarity: double, start: long, end: long>>"
#: What a pair of words that a template lacks costs a span (one that it has is worth 1), and the loss that ends a span.
_MISS, _LOSS = 0.5, 6.0
#: Words around a span, on its lines, that the classifier reads too.
_AROUND = 12


def words_of(text: str) -> list[str]:
    """The words of a text, lower case."""
    return "\n".join(_WORD.findall(text)).lower().split()


def _grams(parts: Sequence[str]) -> list[str]:
    return [*parts, *(f"{a} {b}" for a, b in zip(parts, parts[1:]))]


def grams(paragraph: str) -> list[str]:
    """Words and pairs of words, lower case."""
    return _grams(words_of(paragraph))


class Classifier:
    """Sparse multinomial logistic regression over word n-grams, calibrated by a temperature and a threshold."""

    def __init__(self, families: Sequence[str], weights: Mapping[str, np.ndarray], bias: np.ndarray, temperature: float):
        self.families, self.bias, self.temperature = list(families), bias, temperature
        self.weights = dict(weights)  # only n-grams with a weight
        templates = [(f, _pairs(words_of(t))) for f in families for t in TEMPLATES.get(f, ())]
        self.templates = [(f, pairs) for f, pairs in templates if pairs]
        self.of_pair: dict[tuple[str, str], list[int]] = {}  # the templates that have a pair
        for i, (_, pairs) in enumerate(self.templates):
            for p in pairs:
                self.of_pair.setdefault(p, []).append(i)
        self.known = set(self.of_pair)

    def predict_words(self, parts: Sequence[str]) -> tuple[str, float]:
        z = self.bias.copy()
        for g in set(_grams(parts)):
            if (w := self.weights.get(g)) is not None:
                z += w
        z /= self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.families[k], float(p[k])

    def predict(self, paragraph: str) -> tuple[str, float]:
        return self.predict_words(words_of(paragraph))

    def similarity(self, family: str, parts: Sequence[str]) -> float:
        """The largest share of the word pairs of one of the family's templates that the words have."""
        own = _pairs(parts)
        return max((len(own & pairs) / len(pairs) for f, pairs in self.templates if f == family), default=0.0)


def _pairs(parts: Sequence[str]) -> set[tuple[str, str]]:
    return set(zip(parts, parts[1:]))


def examples(seed: int = 7, copies: int = 20) -> list[tuple[str, str]]:
    """Training paragraphs: templates whole and with words left out, in longer text; unrelated ones and mixed-up words."""
    rng = random.Random(seed)
    filler = " ".join(UNRELATED).split()
    pool = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    rows = []
    for family, sentences in TEMPLATES.items():
        for t in sentences:
            rows.append((t, family))
            for _ in range(copies):
                # of a few words each one counts
                kept = [w for w in t.split() if rng.random() > 0.1 or len(t.split()) < 4]
                around = rng.choices(filler, k=rng.randrange(12))
                cut = rng.randrange(len(around) + 1)
                rows.append((" ".join(around[:cut] + kept + around[cut:]), family))
    for _ in range(len(rows) // 2):
        rows.append((" ".join(rng.choices(pool, k=rng.randrange(3, 25))), UNKNOWN))
        rows.append((" ".join(rng.choices(filler, k=rng.randrange(3, 40))), UNKNOWN))
    rows += [(t, UNKNOWN) for t in UNRELATED for _ in range(copies)]
    rng.shuffle(rows)
    return rows


def train(rows: Sequence[tuple[str, str]] | None = None, steps: int = 300, rate: float = 1.0, sparse: float = 2e-4) -> Classifier:
    """Proximal gradient descent (an absolute penalty keeps few n-grams) on four fifths; the temperature fits the rest."""
    rows = examples() if rows is None else rows
    families = sorted({f for _, f in rows})
    index: dict[str, int] = {}
    seen = Counter(g for t, _ in rows for g in set(grams(t)))
    bags = [[index.setdefault(g, len(index)) for g in sorted(set(grams(t))) if seen[g] >= 8] for t, _ in rows]
    x = np.zeros((len(rows), len(index)), np.float32)
    for i, bag in enumerate(bags):
        x[i, bag] = 1
    y = np.eye(len(families), dtype=np.float32)[[families.index(f) for _, f in rows]]
    fit = np.arange(len(rows)) % 5 != 0
    w, b = np.zeros((len(index), len(families)), np.float32), np.zeros(len(families), np.float32)

    def softmax(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    for _ in range(steps):
        error = (softmax(x[fit] @ w + b) - y[fit]) / fit.sum()
        w -= rate * (x[fit].T @ error)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparse, 0)
        b -= rate * error.sum(axis=0)
    z = x[~fit] @ w + b
    loss = [(-np.log(np.maximum((softmax(z / t) * y[~fit]).sum(axis=1), 1e-9)).mean(), t) for t in np.linspace(0.2, 3, 57)]
    kept = {g: w[i].astype(np.float64) for g, i in index.items() if w[i].any()}
    return Classifier(families, kept, b.astype(np.float64), float(min(loss)[1]))


def _blocks(text: str) -> Iterator[list[tuple[str, int, int, int]]]:
    """The paragraphs: runs of lines with words, as words with their line, start and end. A line of signs alone is a gap."""
    block, at = [], 0
    for i, line in enumerate(text.split("\n")):
        found = [(m[0].lower(), i, at + m.start(), at + m.end()) for m in _WORD.finditer(line)]
        if found:
            block += found
        elif block:
            yield block
            block = []
        at += len(line) + 1
    if block:
        yield block


def _spans(parts: Sequence[str], pairs: set[tuple[str, str]]) -> Iterator[tuple[int, int]]:
    """Spans of words (first, last) dense in the word pairs of a template, none counted twice, one after the other."""
    k, n, start = 0, len(parts) - 1, None
    score = best = 0.0
    end, seen = 0, set()
    while k < n or start is not None:
        if k < n:
            pair = (parts[k], parts[k + 1])
            new = pair in pairs and pair not in seen
            if start is None:
                if new:
                    start = end = k
                    score = best = 1.0
                    seen = {pair}
                k += 1
                continue
            score += 1 if new else -_MISS
            if new:
                seen.add(pair)
                if score > best:
                    best, end = score, k
            if score > 0 and best - score < _LOSS:
                k += 1
                continue
        # where it begins is found from its end: what comes before may be a piece of another notice
        score = best = 0.0
        begin, seen = end, set()
        for j in range(end, start - 1, -1):
            pair = (parts[j], parts[j + 1])
            new = pair in pairs and pair not in seen
            score += 1 if new else -_MISS
            if new:
                seen.add(pair)
                if score > best:
                    best, begin = score, j
        if begin > start:
            yield from ((start + a, start + b) for a, b in _spans(parts[start:begin], pairs))
        yield begin, end + 1
        k, start, seen = end + 1, None, set()


def find(text: str | None, model: Classifier, least: float, similar: float) -> list[dict]:
    """The confirmed license paragraphs of a text, in order: the line one begins in, its family, and its code points.

    A licence may be wrapped over lines, or stand on one line of a longer paragraph, so paragraphs are looked for as spans
    dense in word pairs of one template. Spans with more pairs in common go first, and no two of them overlap. A span
    with less than the share ``similar`` of its template's pairs is left out unread: nothing would confirm it.
    """
    text = text or ""
    parts = words_of(text)
    there = Counter(i for p in model.known.intersection(zip(parts, parts[1:])) for i in model.of_pair[p])
    wanted = [i for i, n in there.items() if n >= similar * len(model.templates[i][1])]
    return _confirmed(text, sorted(wanted), model, least, similar) if wanted else []


def _confirmed(text: str, wanted: Sequence[int], model: Classifier, least: float, similar: float) -> list[dict]:
    found = []
    for block in _blocks(text):
        parts = [w for w, *_ in block]
        spans = []
        for i in wanted:
            pairs = model.templates[i][1]
            for a, b in _spans(parts, pairs):
                common = len(_pairs(parts[a : b + 1]) & pairs)
                if common >= similar * len(pairs):
                    spans.append((-common, -common / len(pairs), a, b))
        taken = np.zeros(len(block), bool)
        for *_, a, b in sorted(set(spans)):
            if taken[a : b + 1].any():
                continue
            first, last = a, b + 1
            while first > 0 and a - first < _AROUND and block[first - 1][1] == block[a][1]:
                first -= 1
            while last < len(block) and last - b <= _AROUND and block[last][1] == block[b][1]:
                last += 1
            family, p = model.predict_words(parts[first:last])
            if family != UNKNOWN and p >= least and (s := model.similarity(family, parts[a : b + 1])) >= similar:
                taken[a : b + 1] = True
                place = {"start": block[a][2], "end": block[b][3]}
                found.append({"paragraph": block[a][1], "family": family, "probability": p, "similarity": s, **place})
    return sorted(found, key=lambda x: x["start"])


def _scan(model: Classifier, least: float, similar: float, names: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()),
                       ("start", pa.int64()), ("end", pa.int64())])
        )
        for batch in batches:
            found = [find(t.as_py(), model, least, similar) for t in batch["__text"]]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(found, kind)], names=[*names, "licenses"])

    return run


def scan(docs: DataFrame, model: Classifier | None = None, least: float = 0.5, similar: float = 0.5) -> DataFrame:
    """The columns of ``docs`` but ``text`` (and ``licenses``, replaced) and ``licenses``: the license paragraphs of each document.

    Texts are read whole. The classifier reads every paragraph (see ``find``) that has the share ``similar`` of the word pairs of a
    template; one that it gives to a family with a probability of ``least`` or more counts if it has that share of one of the
    family's own templates. Everything else is the unknown class. ``paragraph`` is the line that it begins in, ``start`` and ``end`` are
    code points. Null and empty texts have none; repeated rows are scanned each. No shuffle.
    """
    model = model or train()
    names = [c for c in docs.columns if c not in ("text", "licenses")]
    rows = docs.select(*names, F.col("text").alias("__text"))
    schema = with_fields(docs.select(*names).schema, f"licenses {_FOUND}")
    return rows.mapInArrow(_scan(model, least, similar, names), schema)
