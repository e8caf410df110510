import random
import re
from collections import Counter

import duckdb
import numpy as np
from compare import compare
from helpers_llm import awkward, documents, empty

from lakerill.llm import divergence, suite_llm

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, least=30, top=50):
    docs = []
    for r in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        docs.append((r.lang or "", r.source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text))))
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        within = Counter(t for _, _, c in own for t in c)
        kept = [t for t, n in within.items() if n >= least]
        v = len(kept)

        def shares(counts):
            size = sum(counts[t] for t in kept) + 5 * v
            return {t: 1 + 10**9 * (counts[t] + 5) // size for t in kept}

        q = shares(sum((c for _, _, c in own), Counter()))
        counts = {s: sum((c for _, x, c in own if x == s), Counter()) for s in {d[1] for d in own}}
        p = {s: shares(c) for s, c in counts.items()}
        for s in p:
            found = {"pair": [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]}
            more = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            found["term"] = sorted(more, key=lambda x: (-x[0], x[1].encode()))[:top]
            for part, items in found.items():
                for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                    yield lang, s, part, item, value, rank


def same(docs, **options):
    got = sorted(tuple(r) for r in divergence.audit(docs, **options).collect())
    assert got == sorted(plain(docs.collect(), **options))
    return got


def test_documents(spark):
    assert len(same(documents(spark))) > 300
    same(documents(spark), least=2, top=5)


def test_a_hot_source_shared_paths_and_big_counts(spark):
    # most terms have equal rows, some differ in one source; a third of all words are one term of one source
    rng, rows = random.Random(5), []
    for i in range(600):
        some = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(3))}" for _ in range(20)]
        source = "hot" if i % 3 else f"s{i % 12}"
        rows.append((i, " ".join(some + ["The"] * (500 if i % 50 == 0 else i % 3)), "en" if i % 5 else "dé", source, 1))
    same(spark.createDataFrame(rows, COLUMNS), least=3)


def test_many_sources(spark):
    # paths longer than the arrays that hold them at first, in several ranges
    rows = [(i, f"common term{chr(97 + i % 20)} w{chr(97 + i % 7)}", "en", f"s{i % 90:02d}", 1) for i in range(900)]
    same(spark.createDataFrame(rows, COLUMNS), least=5)


def test_sums_do_not_depend_on_ranges_and_flushes(spark, monkeypatch):
    docs = documents(spark).where("lang <> 'de'")
    want = sorted(tuple(r) for r in divergence.audit(docs, least=3).collect())
    for name, value in (("_HELD", 3), ("_CELLS", 50), ("_BLOCK", 10)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in divergence.audit(docs.repartition(11), least=3).collect()) == want


def test_awkward_rows(spark):
    docs = awkward(spark, ["term", "docs", "n", "p", "q", "s", "path", "m", "value", "rank"])
    same(docs)  # nothing is kept, pairs are there with 0
    same(docs, least=1)
    assert divergence.audit(empty(spark)).collect() == []


def test_shares_of_very_many_words(spark):
    df = spark.createDataFrame([(10**12, 3 * 10**12)], "n long, size long")
    assert df.select(divergence._share("n", "size")).first()[0] == 1 + 10**9 * (10**12 + 5) // (3 * 10**12)


def test_against_sql(spark, folder):
    documents(spark).unionByName(awkward(spark)).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    assert compare(spark, con, folder, suite_llm.op12_source_divergence, suite_llm.ORACLE["op12_source_divergence"]) is None


def test_terms():
    assert divergence.terms("Don't SAY ÄÖx 日本-語2x").decode().split() == ["don", "t", "say", "ÄÖx", "日本", "語", "x"]


def test_shared_paths_meet_once():
    # three rows share two nodes, two of them a third one; the first row occurs four times
    items = np.array([[[0, 2, 5], [0, 2, 5], [0, 2, 6]], [[1, 1, 1], [1, 1, 7], [1, 1, 2]], [[9, 8, 7]] * 3], np.int64)
    keys, sums = divergence._tree(items, np.array([3, 3, 3]), np.array([4, 1, 2]))
    p = lambda n, size: 1 + 10**9 * (n + 5) // size
    want = {}
    for row, m in zip(range(3), (4, 1, 2)):
        for j in range(3):
            for i in range(j):
                (s, n, d), (t, k, e) = items[:, row, i].tolist(), items[:, row, j].tolist()
                x, y, u, v = p(n, d), p(k, e), p(0, d), p(0, e)
                want[s << 32 | t] = want.get(s << 32 | t, 0) + m * (abs(x - y) - abs(x - v) - abs(u - y) + abs(u - v))
    assert dict(zip(keys.tolist(), sums.tolist())) == want
