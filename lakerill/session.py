"""Where a job may put data that several executors have to see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_made: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A cluster has to name one; only a local session falls back to a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lakerill-")
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared root that no other run uses."""
    path = f"{shared_root(spark)}/lakerill/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_folders(spark: SparkSession) -> int:
    """Delete the folders this process got from ``new_folder``, and return how many there were.

    For the end of a job: frames that read them must not be used any more.
    """
    n = len(_made)
    while _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and go on from the files, so later stages cannot recompute it differently."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
