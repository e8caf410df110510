"""The corpus pipeline: toxic documents go, near-duplicates and repeated passages go, sources are mixed, sequences packed."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from lakerill.llm import mixing, packing, simhash, substrings, toxicity
from lakerill.llm.text import ship
from lakerill.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects (a score of 0.5 or more)."""
    ship(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: any of four fingerprints of five-word shingles 4 or fewer bits apart."""
    ship(spark)
    return simhash.keep_one(docs, shingle=5, prints=4)


def passages_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 words and more that a smaller doc_id has; ``n_chars`` follows the text."""
    ship(spark)
    kept = substrings.remove_repeated(docs)
    return kept.selectExpr("doc_id", "text", "lang", "source", "cast(char_length(text) as bigint) as n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per time that the mix takes a document, in training order."""
    ship(spark)
    return mixing.in_training_order(mixing.mix(docs)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack_documents(docs, path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", one_of_each),
    ("substrings", passages_out),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
