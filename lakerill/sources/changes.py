"""Change feeds: folders of change records, read as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import CHANGE_META, DELETE, TableSpec


def read_changes(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    streaming: bool = False,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Change records of one table, snapshot rows included, with the declared schema.

    ``max_files`` bounds a micro-batch of the streaming form.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(spec.change_schema).format(fmt)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def image_schema(spec: TableSpec) -> T.StructType:
    """Schema of records that carry full row images: ``op, seq, ts, before, after``."""
    row = T.StructType(spec.schema.fields)
    return T.StructType(
        CHANGE_META.fields + [T.StructField("before", row), T.StructField("after", row)]
    )


def flatten_images(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Turn before/after records into flat change records.

    A change of the key is two records of the same ``seq``: the old key goes, the new one comes.
    """
    moved = F.lit(False)
    for k in spec.key:
        moved = moved | ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}"))
    moved = F.col("before").isNotNull() & F.col("after").isNotNull() & moved
    # a delete without an after-image is known by its old key
    current = F.struct(F.col("op").alias("op"), F.coalesce("after", "before").alias("row"))
    arrival = F.struct(F.lit("c").alias("op"), F.col("after").alias("row"))
    removal = F.struct(F.lit(DELETE).alias("op"), F.col("before").alias("row"))
    steps = F.when(moved, F.array(removal, arrival)).otherwise(F.array(current))
    flat = records.select("seq", "ts", F.explode(steps).alias("step"))
    meta = ["step.op", "seq", "ts"]
    return flat.select(*meta, *[f"step.row.{c}" for c in spec.columns])


#: Operations of a record with images: insert, update, delete, and a row read by a snapshot. Fixed values.
OPERATIONS = ("c", "u", "d", "r")
_CORRUPT = "__corrupt"


def parse_images(lines: DataFrame, spec: TableSpec, line: str = "value") -> DataFrame:
    """JSON records with images, one to a row of text, as ``op, seq, ts, before, after`` with ``line`` and ``reason``.

    Nothing stops at a broken record: ``reason`` says what is wrong with it and is null for a good one. A record has to be JSON whose
    fields have their types (a field may be absent), a known operation, a position, the images that its operation needs
    (``after``, or ``before`` of a delete) and a key in each image it has.
    """
    schema = image_schema(spec)
    parsed = F.from_json(
        line, T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    rows = lines.select(F.col(line).alias("__line"), parsed.alias("r"))
    op, before, after = F.col("r.op"), F.col("r.before"), F.col("r.after")
    keyless = F.lit(False)
    for k in spec.key:
        keyless = keyless | (before.isNotNull() & F.col(f"r.before.{k}").isNull()) | (after.isNotNull() & F.col(f"r.after.{k}").isNull())
    deletes = op == DELETE
    reason = (
        F.when(F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull(), "not a record")
        .when(op.isNull() | ~op.isin(*OPERATIONS), "unknown operation")
        .when(F.col("r.seq").isNull(), "no position")
        .when((deletes & before.isNull()) | (~deletes & after.isNull()), "no image")
        .when(keyless, "no key")
    )
    # read for a snapshot is an insert
    fields = [F.when(op == "r", "c").otherwise(op).alias("op"), "r.seq", "r.ts", before.alias("before"), after.alias("after")]
    return rows.select(*fields, F.col("__line").alias(line), reason.alias("reason"))


def read_images(
    spark: SparkSession, path: str, spec: TableSpec, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    """Records with images from a folder of JSON lines, broken ones included (see ``parse_images``)."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_images(reader.text(path), spec)


def good_changes(records: DataFrame, spec: TableSpec) -> DataFrame:
    """The good ones among parsed records as flat change records; a changed key is a delete and an insert."""
    return flatten_images(records.where("reason is null"), spec)
