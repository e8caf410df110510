import re

import pytest
from helpers_llm import awkward, documents, empty, sha
from pyspark.sql import functions as F

from lakerill.llm import iblt, suite_llm


def plain(rows):
    order = sorted((r for r in rows if r.doc_id is not None), key=lambda r: -r.doc_id) + [r for r in rows if r.doc_id is None]
    pieces = lambda t: {p for p in re.split(r"\n|(?<=[.!?]) ", t) if p}
    near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, r in enumerate(order):
        text, after = r.text or "", order[(i + 1) % len(order)].text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        yield r.doc_id, len(text), sha(edited), near(pieces(text), pieces(edited)), near(pieces(text), pieces(after))


def test_documents(spark, monkeypatch):
    docs = documents(spark)
    monkeypatch.setattr(iblt, "_SLICE", 30)  # several slices
    got = {r.doc_id: r for r in iblt.fingerprints(docs).collect()}
    assert len(got) == docs.count()
    for doc_id, n, digest, near_edited, near_next in plain(docs.collect()):
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)
    by_text = {}
    for r in docs.collect():
        assert by_text.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_awkward_rows(spark):
    # ids are made unique where the order of the rest would be a choice
    docs = awkward(spark, ["slice", "donor", "digests"]).where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in iblt.fingerprints(docs).collect()}
    for doc_id, n, digest, near_edited, near_next in plain(docs.collect()):
        assert (got[doc_id].n_chars, got[doc_id].edited_sha256) == (n, digest)
        assert got[doc_id].near_edited == pytest.approx(near_edited) and got[doc_id].near_next == pytest.approx(near_next)
    whole = iblt.fingerprints(awkward(spark)).collect()
    assert len(whole) == awkward(spark).count()
    assert len({r.fingerprint for r in whole if r.doc_id == 3}) == 1
    assert iblt.fingerprints(empty(spark)).collect() == []


def test_differences_are_recovered_at_every_size(spark):
    # larger and larger differences: the first sketch fails and ever smaller blocks are peeled
    rows = [(n, common) for n in (0, 1, 5, 20, 100, 1000) for common in (0, 50, 400)]
    df = spark.createDataFrame(rows, "n int, common int")
    hashed = lambda a, b: F.transform(F.sequence(a, b), lambda x: F.xxhash64(x))
    base = F.when(F.col("common") > 0, hashed(F.lit(1), F.col("common"))).otherwise(F.array().cast("array<bigint>"))
    more = F.when(F.col("n") > 0, hashed(F.lit(100_001), 100_000 + F.col("n"))).otherwise(F.array().cast("array<bigint>"))
    df = df.select("n", "common", base.alias("a"), F.concat(base, more).alias("b"))
    a, b = iblt.placed(F.col("a")), iblt.placed(F.col("b"))
    held = df.select("n", "a", "b", a.alias("pa"), b.alias("pb"))
    out = held.select("n", "a", "b", iblt.difference(F.col("pa"), F.col("pb")).alias("d"), iblt.difference(F.col("pb"), F.col("pa")).alias("e"))
    for r in out.collect():  # the very digests, and whose they are
        only = set(r.b) - set(r.a)
        assert sorted((x.k, x.n) for x in r.d) == sorted((k, -1) for k in only) and len(only) == r.n
        assert sorted((x.k, x.n) for x in r.e) == sorted((k, 1) for k in only)


def test_a_sketch_peels_alone(spark):
    # six digests in 24 cells: now and then two share all their cells, which is never taken for a result
    keys = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.xxhash64(i, F.col("id")))
    df = spark.range(100).select(keys.alias("a"), F.array().cast("array<bigint>").alias("b"))
    a, b = (iblt.sketch(iblt.placed(F.col(c))) for c in "ab")
    rows = df.select("a", iblt.peel(iblt.subtract(a, b)).alias("found")).collect()
    assert all(r.found is None or {(x.k, x.n) for x in r.found} == {(k, 1) for k in r.a} for r in rows)
    assert sum(r.found is not None for r in rows) > 85


def test_many_different_lines(spark):
    lines = [f"entry {i}" for i in range(100_000)]
    texts = spark.createDataFrame([("\n".join(lines), "\n".join(lines[20:]))], "a string, b string")
    keys = texts.select(iblt.placed(iblt.paragraphs("a")).alias("a"), iblt.placed(iblt.paragraphs("b")).alias("b"))
    assert keys.select(F.size(iblt.difference(F.col("a"), F.col("b"))).alias("d")).first().d == 20
    docs = spark.createDataFrame([(2, "\n".join(lines[:6000])), (1, "\n".join(lines[3:6000]))], "doc_id long, text string")
    got = {r.doc_id: r for r in iblt.fingerprints(docs).collect()}
    for doc_id, _, digest, near_edited, near_next in plain(docs.collect()):
        assert got[doc_id].edited_sha256 == digest
        assert got[doc_id].near_edited == pytest.approx(near_edited) and got[doc_id].near_next == pytest.approx(near_next)


def test_an_inserted_sentence_costs_one_digest(spark, folder):
    line = [f"Sentence number {i} says something." for i in range(40)]
    rows = [(2, " ".join(["A new one.", *line])), (1, " ".join(line))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r.near_next for r in suite_llm.op3_fingerprints(spark, folder).collect()}
    assert got == {1: pytest.approx(40 / 41), 2: pytest.approx(40 / 41)}


def test_the_estimate_is_near(spark):
    keys = lambda a, b: F.transform(F.sequence(a, b), lambda x: F.xxhash64(x, F.col("id")))
    for left, right in ((40, 40), (200, 100), (5, 300)):
        a, b = (iblt.placed(keys(F.lit(x), F.lit(x + n - 1))) for x, n in ((0, left), (100_000, right)))
        about = iblt.estimate(iblt.subtract(iblt.sketch(a), iblt.sketch(b)), F.lit(left - right).cast("bigint"))
        found = [r[0] for r in spark.range(200).select(about).collect()]
        assert sum(found) / 200 == pytest.approx(left + right, rel=0.1)
        assert sum(0.4 < x / (left + right) < 2 for x in found) > 180


def test_main_path_is_native(spark):
    plan = iblt.fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
