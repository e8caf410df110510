import itertools
from binascii import crc32
from collections import Counter

import numpy as np
import pytest
from helpers_llm import awkward, documents, empty

from lakerill.llm import toxicity

WORDS = "idiot stupid loser trash moron scum pathetic the and thing other with that worthless clown".split()


@pytest.fixture(scope="module")
def model(spark):
    text = " ".join(WORDS * 50)
    return toxicity.language_model(spark.createDataFrame([(text,), (None,)], "text string"))


def test_language_model_counts_every_word(spark):
    docs = documents(spark)
    model = toxicity.language_model(docs)
    grams = Counter()
    for r in docs.collect():
        for w in (r.text or "").lower().split():
            codes = [0, 0, *(toxicity._CODE.get(c, toxicity._SIZE - 1) for c in w), 0]
            grams.update(zip(codes, codes[1:], codes[2:]))
    batch = list(toxicity._gram_counts(docs.toArrow().to_batches()))[0]
    size = toxicity._SIZE
    got = {(g // size // size, g // size % size, g % size): n for g, n in zip(batch["gram"].to_pylist(), batch["n"].to_pylist())}
    assert got == dict(grams)
    assert np.allclose(np.exp(-model).sum(axis=2), 1, atol=1e-3)


def slow_restore(token, model):
    """The cheapest of all paths through the lattice."""
    best = None
    for path in itertools.product(*toxicity.lattice(token)):
        cost = sum(c for _, c in path)
        text = "".join(x for x, _ in path)
        for w in text.split():
            codes = [0, 0, *(toxicity._CODE[c] for c in w), 0]
            cost += sum(float(model[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:]))
        if best is None or cost < best[0] - 1e-6:
            best = (cost, text)
    return best


@pytest.mark.parametrize("token", ["1d10t", "l0$er", "tr@@sh", "m.o.r.o.n", "sttuupid", "iidd1ott", "the!other"])
def test_viterbi_finds_the_best_path(model, token):
    cost, text = slow_restore(token, model)
    assert toxicity.restore(token, model).split() == text.split()


@pytest.mark.parametrize(
    "token, want",
    [("1d10t", "idiot"), ("$tup1d", "stupid"), ("l0s3r", "loser"), ("tr@sh", "trash"), ("m.o.r.o.n", "moron"), ("stuuuupid", "stupid"),
     ("scum!!", "scum"), ("idiot$$$", "idiot"), ("idiot,", "idiot")],
)
def test_disguised_words(model, token, want):
    assert toxicity.read_token(token, model) == [want]


@pytest.mark.parametrize(
    "token, want", [("$tupid", "stupid"), ("!diot", "idiot"), ("+rash", "trash"), ("a$$", "ass"), ("stuupid", "stupid"), ("iidiot", "idiot")]
)
def test_either_reading_may_be_meant(model, token, want):
    assert want in toxicity.read_token(token, model)
    assert token.strip(toxicity._MARKS) in toxicity.read_token(token, model)


def test_a_letter_beside_letters_apart(model):
    assert "stupid" in toxicity.spaced_words("you are a s t u p i d person", model)
    assert "moron" in toxicity.spaced_words("such m o r o n s u", model) or "morons" in toxicity.spaced_words("such m o r o n s u", model)


@pytest.mark.parametrize("size", [150, 197, 198, 199, 200, 201, 5000])
def test_a_word_anywhere_in_a_long_token(model, size):
    token = "the." * (size // 4) + "." * (size % 4) + "1d10t" + ".the" * 60
    assert "idiot" in toxicity.read_token(token, model)


def test_letters_apart(model):
    assert toxicity.spaced_words("you i d i o t and l o s e r", model)[:1] == ["idiot"]
    assert toxicity.spaced_words("a a a a a a a a", model) == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scorer = toxicity.fit(docs.select("doc_id", "text"), labels)
    rows = scorer.score(docs.select("doc_id", "text")).join(labels, "doc_id").collect()
    held = [r for r in rows if crc32(str(r.doc_id).encode()) % 5 == 0]
    toxic, clean = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    better = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert better > 0.95
    assert np.mean([s >= 0.5 for s in toxic]) > 0.85 and np.mean([s < 0.5 for s in clean]) > 0.99


def test_awkward_rows(spark):
    docs = awkward(spark, ["score"])
    labels = spark.createDataFrame([(8, 1), (8, None), (None, 1), (1, 0), (2, 0), (99, 1), (4, 0), (8, 1)], "doc_id long, toxic int")
    scorer = toxicity.fit(docs, labels)
    rows = scorer.score(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert toxicity.fit(empty(spark), labels.limit(0)).score(empty(spark)).collect() == []
    assert toxicity.fit(docs, labels.limit(0)).score(docs).where("score < 0.5").count() == docs.count()


def test_copies_of_a_disguised_word_are_caught(spark):
    rows = [(i, f"the other thing {'idiot' if i % 4 == 0 else 'with'} that {i}", int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.fit(df.drop("toxic"), df.select("doc_id", "toxic"))
    new = [(1, "that 1d10t thing"), (2, "that i d i o t thing"), (3, "the iiidiooot"), (4, "the other thing"), (5, None)]
    new += [(6, "that !diot thing"), (7, "the iidiot"), (8, "that a i d i o t with"), (9, "the thing " + "that." * 60 + "1d10t" + ".with" * 60)]
    got = {r.doc_id: r.score for r in scorer.score(spark.createDataFrame(new, "doc_id long, text string")).collect()}
    assert min(got[i] for i in (1, 2, 3, 6, 7, 8, 9)) > 0.5 > max(got[4], got[5])
