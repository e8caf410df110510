"""Small metadata calls on whatever file system holds a path (driver side, no table data)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete one file if it is there."""
    _, p, fs = _fs(spark, path)
    fs.delete(p, False)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching ``pattern``, sorted."""
    _, p, fs = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths matching ``pattern`` with their modification time in milliseconds."""
    _, p, fs = _fs(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime()) for s in (fs.globStatus(p) or []))


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path``."""
    _, p, fs = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under another name and rename, so a reader sees the whole text or nothing."""
    jvm, p, fs = _fs(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(path + ".part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(part, p):
        raise OSError(f"{path} exists already")
