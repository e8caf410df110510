import textwrap

import pytest
from helpers_llm import awkward, documents, empty

from lakerill.llm import licenses

#: The license lines that occur in the documents.
LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache",
}


@pytest.fixture(scope="module")
def model():
    return licenses.train()


def test_license_lines_of_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [(x.paragraph, x.family) for x in r.licenses] for r in licenses.scan(docs, model).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == [(i, LINES[x]) for i, x in enumerate(r.text.split("\n")) if x in LINES]


def test_every_template_and_nothing_unrelated(model):
    for family, sentences in licenses.TEMPLATES.items():
        for t in sentences:
            for text in (t, t.upper(), f"Note: {t} Thank you."):
                assert [x["family"] for x in licenses.find(text, model, 0.5, 0.5)] == [family], text
    for t in licenses.UNRELATED:
        assert licenses.find(t, model, 0.5, 0.5) == []


def test_unseen_paragraphs(model):
    rows = licenses.examples(seed=99, copies=5)
    right = [model.predict(t)[0] == f for t, f in rows]
    assert sum(right) / len(right) > 0.9


def test_awkward_rows(spark, model):
    docs = awkward(spark, ["licenses"])
    rows = licenses.scan(docs, model).collect()
    assert len(rows) == docs.count() and all(r.licenses == [] for r in rows)
    assert licenses.scan(empty(spark), model).collect() == []
    assert licenses.scan(documents(spark), model).count() == documents(spark).count()


#: Notices as projects write them: the public texts, with names, versions and addresses of their own.
NOTICES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software"
        " is furnished to do so, subject to the following conditions:"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
        " following disclaimer."
    ),
    "GPL": (
        "Foo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
        " the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "LGPL": (
        "This file is part of Foo. Foo is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version."
    ),
    "Apache": (
        'Copyright 2020 Jane Doe. Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies."
    ),
}
#: Notices of families that the templates don't have.
STRANGE = (
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies"
    " this distribution, and is available at https://www.eclipse.org/legal/epl-v20.html",
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell,"
    " or distribute this software.",
    "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
)


def test_wrapped_notices(model):
    for width in (40, 72, 10_000):
        for mark in ("", "# ", " * "):
            for family, notice in NOTICES.items():
                text = "int main\n\n" + textwrap.indent(textwrap.fill(notice, width), mark) + f"\n{mark}\nmore text"
                found = licenses.find(text, model, 0.5, 0.5)
                assert found and {x["family"] for x in found} == {family}, (family, width, mark, found)
                assert all(0 <= x["start"] < x["end"] <= len(text) and x["paragraph"] >= 2 for x in found)
            for notice in STRANGE:
                assert licenses.find(textwrap.indent(textwrap.fill(notice, width), mark), model, 0.5, 0.5) == [], notice


def test_identifiers_and_neighbours(model):
    for name, family in (("MIT", "MIT"), ("Apache-2.0", "Apache"), ("GPL-3.0-or-later", "GPL"), ("LGPL-2.1-only", "LGPL"),
                         ("BSD-3-Clause", "BSD"), ("MPL-2.0", "MPL"), ("ISC", "ISC")):
        assert [x["family"] for x in licenses.find(f"// SPDX-License-Identifier: {name}\n", model, 0.5, 0.5)] == [family]
    lines = ["some prose of the day", *LINES, *LINES, "and the rest of it"]
    got = [(x["paragraph"], x["family"]) for x in licenses.find("\n".join(lines), model, 0.5, 0.5)]
    assert got == [(i, LINES[x]) for i, x in enumerate(lines) if x in LINES]


def test_the_shortcut_loses_nothing(spark, model):
    texts = [r.text for r in documents(spark).collect()] + list(NOTICES.values()) + list(STRANGE)
    texts += [t for t, _ in licenses.examples(seed=3, copies=1)]
    every = range(len(model.templates))
    for t in texts:
        assert licenses.find(t, model, 0.5, 0.5) == licenses._confirmed(t, every, model, 0.5, 0.5)
