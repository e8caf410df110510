import random

import xxhash
from helpers_llm import awkward, documents, empty, roots, words

from lakerill.llm import simhash

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text, shingle=4):
    parts = words((text or "").translate(LOWER))
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + shingle]) for i in range(len(parts) - shingle + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_mix(h, k):
    h ^= k * 0x9E3779B97F4A7C15 % 2**64
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 1):
        h = (h ^ h >> 33) * factor % 2**64
    return h


def plain_fingerprints(text, shingle, count):
    """Further fingerprints are those of mixed hashes."""
    parts = words((text or "").translate(LOWER))
    if not parts:
        return [0] * count
    shingles = [" ".join(parts[i : i + shingle]) for i in range(len(parts) - shingle + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    out = [plain_fingerprint(text, shingle)]
    for k in range(1, count):
        mixed = [plain_mix(h, k) for h in hashes]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in mixed) > len(mixed)))
    return out


def plain_components(rows, shingle=4, count=1):
    every = [plain_fingerprints(r.text, shingle, count) for r in rows]
    prints = [p[0] for p in every]
    n = len(rows)
    near = [(i, j) for i in range(n) for j in range(i) if any((x ^ y).bit_count() <= 4 for x, y in zip(every[i], every[j]))]
    root = roots(n, near)
    best = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            best[root[i]] = min(best.get(root[i], r.doc_id), r.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", best.get(root[i])) for i, (r, p) in enumerate(zip(rows, prints))), key=str)


def test_components_of_documents(spark):
    docs = documents(spark)
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    want = plain_components(docs.collect())
    assert got == want
    assert len({c for _, _, c in want}) < len(want)


def test_awkward_rows(spark):
    docs = awkward(spark, ["fingerprint", "component_id", "print", "slice"])
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == plain_components(docs.collect())
    assert simhash.near_duplicates(empty(spark)).collect() == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == {c for _, _, c in got} and len(ids) == len(set(ids)) + 1  # the row of id 3 is there twice
    assert simhash.keep_one(empty(spark)).collect() == []


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:  # chains of several steps, and a crowded ball
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
            prints.add(p)
    center = rng.getrandbits(64)
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    n = len(prints)
    want = roots(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    for pretended in (n, 40_000):  # few groups, and groups by leading bits
        edges = simhash.links(df, pretended)
        pairs = [(signed.index(a), signed.index(b)) for a, b in edges.collect()]
        assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in pairs)
        assert roots(n, pairs) == want
        named = dict(map(tuple, simhash.components(edges).collect()))
        for i, s in enumerate(signed):
            group = [signed[j] for j in range(n) if want[j] == want[i]]
            assert named.get(s, s) == min(group)


def test_a_dense_family_is_split_until_it_fits(spark, monkeypatch):
    # a third of all fingerprints are within a few bits of each other
    rng = random.Random(4)
    center = rng.getrandbits(64)
    dense = {center ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (1 << 64) - 1 for _ in range(150)}
    prints = sorted(dense | {rng.getrandbits(64) for _ in range(300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    want = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    place = {p: i for i, p in enumerate(signed)}
    for largest, pairs in ((16_000_000, 2_000_000), (40_000, 50), (4_000, 50)):
        monkeypatch.setattr(simhash, "_LARGEST", largest)
        monkeypatch.setattr(simhash, "_PAIRS", pairs)
        monkeypatch.setattr(simhash, "_GROUP", 100_000)
        edges = [(place[r.a], place[r.b]) for r in simhash.links(df, len(prints)).collect()]
        assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in edges)
        assert roots(len(prints), edges) == want, largest


def rewritten(rng, parts, share):
    """The words with a share of them replaced."""
    at = set(rng.sample(range(len(parts)), round(share * len(parts))))
    return [f"x{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(parts)]


def alike(a, b, shingle=5):
    x, y = ({tuple(p[i : i + shingle]) for i in range(len(p) - shingle + 1)} for p in (a, b))
    return len(x & y) / len(x | y)


def test_several_fingerprints(spark):
    rng = random.Random(8)
    rows = []
    for i in range(60):
        parts = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 250))]
        rows.append((3 * i, " ".join(parts)))
        rows += [(3 * i + k, " ".join(rewritten(rng, parts, share))) for k, share in ((1, 0.01), (2, 0.03))]
    rows += [(1000, None), (1001, ""), (None, rows[0][1]), (1002, rows[5][1]), (1002, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for count in (2, 4):
        got = sorted(map(tuple, simhash.near_duplicates(docs, shingle=5, prints=count).collect()), key=str)
        assert got == plain_components(docs.collect(), 5, count)
    # more fingerprints link more, and never fewer
    one, four = ({r.doc_id for r in simhash.keep_one(docs, shingle=5, prints=n).collect()} for n in (1, 4))
    assert four < one
    texts = dict(rows)
    assert {0, 9, 60} <= four  # the smallest id of each family stays
    for i in range(60):  # very much alike: found
        if alike(texts[3 * i].split(), texts[3 * i + 1].split()) >= 0.97:
            assert 3 * i + 1 not in four
    assert simhash.near_duplicates(empty(spark), prints=3).collect() == []
