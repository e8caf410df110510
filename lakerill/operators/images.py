"""Before-images and changelog kinds of a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hot_keys, same_key
from ..session import materialise
from ..specs import DELETE

#: A key with more changes than this is worked on in slices, each a task of its own.
HOT_ROWS = 1_000_000


def before_after(
    log: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: str = "seq",
    op: str = "op",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every change with the row before and after it, as structs ``before`` and ``after``.

    There is no before-image where the key was absent and no after-image of a delete.

    The previous change of a key is a window over the key. If keys hold so many changes that they would not fit a task, their
    changes are written once, in ranges of (key, order) that Spark cuts from a sample to about equal counts, and each
    range starts with the last change of the key in the range before. Whether there are such keys is counted first.
    """
    image = F.struct(F.col(op).alias("op"), *[F.col(c) for c in columns])
    meta = [c for c in log.columns if c not in key and c not in columns and c not in (op, order)]
    rows = log.select(*key, F.col(order), F.struct(*meta).alias("__meta"), image.alias("__image")) if meta else (
        log.select(*key, F.col(order), F.lit(None).cast("struct<x:int>").alias("__meta"), image.alias("__image"))
    )
    rows = rows.withColumn("__slice", F.lit(0))
    hot = hot_keys(log, key, hot_rows).persist()  # at most MAX_HOT_KEYS rows
    try:
        total = hot.agg(F.sum("n")).first()[0]
        if total is None:
            everything = rows.withColumn("__carried", F.lit(False))
        else:
            everything = _in_ranges(rows, materialise(hot, "hot-keys"), key, order, -(-2 * total // hot_rows))
    finally:
        hot.unpersist()
    previous = F.lag("__image").over(Window.partitionBy(*key, "__slice").orderBy(order))
    changes = everything.withColumn("__previous", previous).where(~F.col("__carried"))

    def payload(source: str):
        return F.struct(*[F.col(f"{source}.{c}").alias(c) for c in columns])

    was = F.coalesce(F.col("__previous.op") != DELETE, F.lit(False))
    return changes.select(
        F.col("__image.op").alias(op),
        F.col(order),
        *key,
        *[F.col(f"__meta.{c}").alias(c) for c in meta],
        F.when(was, payload("__previous")).alias("before"),
        F.when(F.coalesce(F.col("__image.op") != DELETE, F.lit(True)), payload("__image")).alias("after"),
    )


def _in_ranges(rows: DataFrame, hot: DataFrame, key: Sequence[str], order: str, ranges: int) -> DataFrame:
    """``rows`` with those of hot keys cut into slices of about equal counts, and the changes carried between slices."""
    known = F.broadcast(hot.select(*key)).alias("h")
    r = rows.alias("r")
    rest = r.join(known, same_key("r", "h", key), "left_anti")
    cut = r.join(known, same_key("r", "h", key), "left_semi").repartitionByRange(ranges, *key, order)
    # written once: a range would be another one if it was cut again
    cut = materialise(cut.withColumn("__slice", F.spark_partition_id() + 1), "hot-changes")
    last = cut.groupBy(*key, "__slice").agg(F.max_by("__image", order).alias("__image"), F.max(order).alias(order))
    # the slices of one key: far fewer than its rows
    following = F.lead("__slice").over(Window.partitionBy(*key).orderBy("__slice"))
    carried = last.withColumn("__slice", following).where(F.col("__slice").isNotNull())
    own = rest.unionByName(cut).withColumn("__carried", F.lit(False))
    return own.unionByName(carried.withColumn("__carried", F.lit(True)), allowMissingColumns=True)


def changelog_kinds(
    log: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: str = "seq",
    op: str = "op",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The log as row kinds: ``+I`` insert, ``-U``/``+U`` update, ``-D`` delete.

    Kinds follow from the images, so the first change of a key is an insert whatever the source
    called it, and deleting an absent key yields nothing. A change of the key itself arrives here as
    a delete of the old key and an insert of the new one (``flatten_images``).
    """
    images = before_after(log, key, columns, order, op, hot_rows)

    def step(kind: str, image: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(image).alias("row"))

    had, has = F.col("before").isNotNull(), F.col("after").isNotNull()
    steps = (
        F.when(had & has, F.array(step("-U", "before"), step("+U", "after")))
        .when(has, F.array(step("+I", "after")))
        .when(had, F.array(step("-D", "before")))
    )
    exploded = images.select(*key, order, F.explode(steps).alias("step"))
    return exploded.select(*key, order, "step.kind", *[f"step.row.{c}" for c in columns])
