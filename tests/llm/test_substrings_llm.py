import pytest
from helpers_llm import awkward, documents, empty, sha, words

from lakerill.llm import substrings


def plain(rows, window):
    seen = {}
    for r in rows:
        parts = words(r.text)
        for i in range(len(parts) - window + 1):
            key = tuple(parts[i : i + window])
            place = float("inf") if r.doc_id is None else r.doc_id
            seen[key] = min(seen.get(key, place), place)
    out = []
    for r in rows:
        parts, gone = words(r.text), set()
        place = float("inf") if r.doc_id is None else r.doc_id
        for i in range(len(parts) - window + 1):
            if seen[tuple(parts[i : i + window])] < place:
                gone |= set(range(i, i + window))
        out.append((r.doc_id, len(parts), len(gone), sha(" ".join(w for i, w in enumerate(parts) if i not in gone))))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [5, 50])
def test_documents(spark, window):
    docs = documents(spark)
    got = sorted(map(tuple, substrings.digest(docs, window).collect()), key=str)
    assert got == plain(docs.collect(), window)
    assert sum(n for _, _, n, _ in got) > 0


def test_awkward_rows(spark):
    docs = awkward(spark, ["n_words", "shard", "flags"])
    got = sorted(map(tuple, substrings.digest(docs, 50).collect()), key=str)
    assert got == plain(docs.collect(), 50)
    whole = {(r.doc_id, r.lang): r for r in substrings.remove_repeated(docs).collect()}
    assert whole[(4, None)].text is None and whole[(6, "en")].text == " \t\n "
    assert whole[(3, "en")].text == "before it after it"
    assert [tuple(s) for s in whole[(3, "en")].removed_spans] == [(2, 62)]
    assert substrings.digest(empty(spark)).collect() == []


def test_blocks_and_shards(spark):
    # small blocks and more bits: windows meet across blocks
    docs = documents(spark)
    got = substrings.remove_repeated(docs.repartition(7), 10, block=2000, group=20)
    got = sorted((r.doc_id, r.n_words, r.n_removed, sha(" ".join(words(r.text)))) for r in got.collect())
    assert got == sorted(plain(docs.collect(), 10))
