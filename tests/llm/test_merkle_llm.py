import hashlib
import zlib

import pytest
from compare import compare
from helpers_llm import awkward, documents, empty
from pyspark.sql import functions as F

from lakerill.llm import merkle, suite_llm


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fields(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(digests):
    """The root and every leaf's siblings (left, right) per level."""
    proofs, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for i, proof in enumerate(proofs):
            a = at[i] // 16 * 16
            proof.append(("".join(nodes[a : at[i]]), "".join(nodes[at[i] + 1 : a + 16])))
            at[i] //= 16
        nodes = [digest("".join(nodes[a : a + 16])) for a in range(0, len(nodes), 16)]
    return nodes[0], proofs


def plain(rows):
    sources = {}
    for r in rows:
        leaf = digest(fields(r.doc_id, r.source, r.lang, r.n_chars, r.text))
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf, r))
    trees = {}
    for source, leaves in sources.items():
        leaves.sort(key=lambda x: x[:3])
        trees[source] = leaves, *tree([x[2] for x in leaves])
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([trees[x][1] for x in order])
    for source, top in zip(order, tops):
        leaves, subroot, proofs = trees[source]
        for (_, _, leaf, r), own in zip(leaves, proofs):
            folded = leaf
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                text = r.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
                folded = digest(fields(r.doc_id, r.source, r.lang, r.n_chars, text))
            for left, right in own + top:
                folded = digest(left + folded + right)
            siblings = digest("".join(a + b for a, b in own + top))
            yield r.doc_id, leaf, subroot, root, siblings, folded, folded == root


def same(docs):
    got = sorted(map(tuple, merkle.audit(docs).collect()), key=repr)
    assert got == sorted(plain(docs.collect()), key=repr)
    return got


def test_documents(spark):
    assert {r[-1] for r in same(documents(spark))} == {True, False}


def test_a_hot_source_and_many_sources(spark):
    # 9,000 documents of one source (three blocks, two tiers), sources of 1, 16, 17, 256 and 257, and 300 sources of one
    sizes = [("hot", 9000), (None, 1), ("b", 16), ("c", 17), ("é", 256), ("", 257), *((f"s{i}", 1) for i in range(300))]
    rows = [(i if i % 3 else i // 3, f"Text {i}", "en", s, i) for s, n in sizes for i in range(n)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


@pytest.mark.parametrize("level", [1, 2])
def test_more_sources_than_a_block(spark, monkeypatch, level):
    monkeypatch.setattr(merkle, "LEVELS", level)
    monkeypatch.setattr(merkle, "_BLOCK_BITS", 4 * level)
    rows = [(i, "x", "en", f"s{i % 300}" if i < 600 else "hot", 1) for i in range(1000)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_awkward_rows(spark):
    same(awkward(spark, ["g", "h", "c", "r", "n", "leaf", "top", "kid", "changed", "__r", "__part"]))
    assert merkle.audit(empty(spark)).collect() == []


def test_a_proof_holds_for_its_leaf_only(spark):
    leaves = spark.range(40).select("id", F.lit("g").alias("grp"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    proofs = merkle.manifest(leaves, "grp", ["id"], ["id"])
    assert proofs.columns == ["id", "grp", "leaf", "subroot", "root", "steps"]
    held = proofs.select(merkle.fold("leaf", "steps") == F.col("root"), merkle.fold(F.sha2("leaf", 256), "steps") == F.col("root"))
    assert {tuple(r) for r in held.collect()} == {(True, False)}


def test_against_sql(spark, folder):
    rows = awkward(spark).unionByName(documents(spark).limit(60)).where("doc_id is not null or text is null")
    rows.write.parquet(f"{folder}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    assert compare(spark, con, folder, suite_llm.op11_merkle_manifest, suite_llm.ORACLE["op11_merkle_manifest"]) is None


def test_proofs_need_no_python_and_no_join(spark):
    plan = merkle.audit(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    # one join: rows of digests with the sizes of their ranges
    assert plan.count("Join") == 1
