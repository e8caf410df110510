"""What the operators share: words, Arrow batches of bounded size, packed integers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null has none."""
    return (text or "").encode().split()  # bytes split at exactly the six characters


_shipped: set[str] = set()


#: Rows and bytes of an Arrow batch between Spark and Python, at most: documents are much larger than the rows that Spark's
#: own numbers are made for.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of a session, wherever the driver imported it from, and keep their batches small."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{key}").rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        target = os.path.join(tempfile.mkdtemp(prefix="run-"), "lakerill.zip")  # Spark sends it on from the driver
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted((root / "lakerill").rglob("*.py")):
                z.write(f, f.relative_to(root))
        context.addPyFile(target)
        _shipped.add(context.applicationId)


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` and more fields after it."""
    return T.StructType(schema.fields + T.StructType.fromDDL(ddl).fields)


def n_words(text: str | Column) -> Column:
    """How many words a text column has; a null has none."""
    joined = F.regexp_replace(text, _GAP, " ")
    bare = F.btrim(joined, F.lit(" "))
    gaps = F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit("")))
    return F.when(F.length(bare) > 0, gaps + 1).otherwise(0).cast("bigint")


def batches_of_text(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, or one longer row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(size) // limit
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def word_codes(texts: pa.Array, hash_of) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code per word of all texts, one after the other, and where each text starts (one more at the end).

    Equal words are found by Arrow's dictionary encoding, so ``hash_of`` (bytes to int) runs once per different word.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat, parent = lists.flatten(), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    codes = np.fromiter((hash_of(w.encode()) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    counts = np.bincount(parent.filter(real).to_numpy(zero_copy_only=False).astype(np.int64), minlength=len(texts))
    at = coded.indices.to_numpy(zero_copy_only=False)
    return (codes[at] if len(at) else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def pack(values: np.ndarray, width: int = 8) -> bytes:
    """Integers as bytes, all lowest bytes first: high bytes are mostly equal and compress in the shuffle."""
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    return raw[:, :width].T.tobytes()


def unpack(data: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), np.uint8)
    raw[:, :width] = planes.T
    return raw.reshape(-1).view("<u8")


def pack_steps(values: np.ndarray) -> bytes:
    """Integers that mostly rise, as their differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)
