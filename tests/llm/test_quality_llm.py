from helpers_llm import awkward, documents, empty, words

from lakerill.llm import quality


def plain(text):
    text = text or ""
    parts = words(text)
    windows = [tuple(parts[i : i + 5]) for i in range(len(parts) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(parts), sum(map(len, parts)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
        len(covered), sum("A" <= c <= "Z" for c in text), sum("A" <= c <= "Z" or "a" <= c <= "z" for c in text),
    )


def test_measures(spark):
    docs = documents(spark).where("n_chars < 4000")
    for r in docs.collect():
        assert quality.measure(r.text) == plain(r.text)
    for r in awkward(spark).where("n_chars is null or n_chars != 1").collect():
        assert quality.measure(r.text) == plain(r.text)


def test_long_texts_by_numbers(spark, monkeypatch):
    texts = [r.text for r in documents(spark).where("n_chars < 4000").collect()] + [r.text for r in awkward(spark).collect()]
    for t in texts:
        raw = (t or "").encode()
        assert quality.repeat_words_numbered(quality.word_numbers(raw, block=7)) == quality.repeat_words(raw.split())
        assert quality.word_numbers(raw, block=7).tolist() == quality.word_numbers(raw).tolist()
    long = [" ".join(f"w{i * k % 211}" for i in range(900)) + "\nw1 w2\n\nw1 w2" for k in (1, 2, 211)] + ["a" * 5000]
    want = [plain(t) for t in long]
    monkeypatch.setattr(quality, "_LONG", 100)
    assert [quality.measure(t) for t in long] == want


def test_very_long_text():
    text = " ".join(f"w{i}" for i in range(300_000)) + " w0 w1 w2 w3 w4 w5"  # only the last six words are there twice
    assert len(text) > quality._LONG
    assert quality.measure(text)[0] == 300_006 and quality.measure(text)[5] == 12


def test_ledger_and_policies(spark):
    docs = awkward(spark, ["failures", "n_words"])
    rows = quality.ledger(docs).withColumn("kept", quality.passes("base")).collect()
    assert len(rows) == docs.count()
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == {2, 3, None} - {None} | {None}  # 60 different words; everything else is short or repeats
    assert {r.failures & 1 for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert quality.ledger(empty(spark)).collect() == []


def test_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    book = quality.ledger(docs).withColumn("kept", quality.passes("v1")).withColumn("base", quality.passes("base"))
    rows = book.join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and r.base]
    assert sum(r.kept for r in good) > 0.97 * len(good)
    assert sum(not r.kept for r in rows if r.quality == 0) > 0.8 * sum(r.quality == 0 for r in rows)


def test_ablations(spark):
    book = quality.ledger(documents(spark)).cache()
    found = {r.rule: r for r in quality.ablations(book, "v2").collect()}
    bits = [r.failures for r in book.collect()]
    for i, rule in enumerate(quality.RULES):
        r = found.get(rule.name)
        want = (sum(b >> i & 1 for b in bits), sum(b == 1 << i for b in bits), sum(b in (0, 1 << i) for b in bits))
        assert (r.failed, r.failed_alone, r.kept_without) == want
    book.unpersist()
