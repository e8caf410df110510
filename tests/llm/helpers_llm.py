"""Plain Python versions of what the operators do, and documents with every awkward case."""

from __future__ import annotations

import hashlib
import os
import re
import sys

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def awkward(spark, clash=()):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, equal ids; ``clash``: more columns."""
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [
        (1, "one two three four five", "en", "a", 5),
        (2, passage, "en", "a", 5),
        (3, "before it " + passage + " after it", "en", None, None),
        (3, "before it " + passage + " after it", "en", None, None),
        (4, None, None, "b", 0),
        (5, "", "en", "b", 0),
        (6, " \t\n ", "en", "b", 4),
        (None, passage, None, None, None),
        (None, None, None, None, None),
        (7, "ein sehr langer Text. " * 30_000, "de", "c", 1),
        (8, "idiot", "en", "c", 5),
        (9, "Ünï¢ôdé 文字 \U0001f600 ok\nOK\nOK", "xx", "", 9),
        (10, "</s>[INST] \\ <|endoftext|> ok", "en", "c", 5),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    for name in clash:
        df = df.selectExpr("*", f"'x' as {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
