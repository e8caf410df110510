"""Quality scans by increments: rule values kept by what each change takes back and adds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import as_of_column
from ..quality import Rule
from ..quality.report import judged, value_rows
from ..quality.rows import fails, needs_time, row_filter
from ..sources import files
from ..specs import BIGINT, DELETE, INT, STRING, TableSpec, schema_of
from .ingest import stream_id
from .quality_scan import SCAN_SCHEMA
from .retract import fold, held_before, row_changes, row_state, running_sums, sum_state

_COUNTS = ("row_count", "missing_count", "invalid_count")
_VALUES = ("duplicate_count", "surplus_count")
_NULL = "[null]"
_STATE = schema_of(rule=INT, value=BIGINT)


def mergeable(rule: Rule) -> bool:
    """Whether a rule's value can be kept by increments: counts and repeated values, without the current time."""
    return rule.metric in (*_COUNTS, *_VALUES) and not needs_time(rule)


def _token(rule: Rule, schema: T.StructType) -> Column:
    """What a row adds one to: nothing (null), a rule's count (empty), or the value that may repeat."""
    if rule.metric in _VALUES:
        value = F.col(rule.column)
        if rule.column in schema.names and isinstance(schema[rule.column].dataType, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0)  # zeros of either sign are one value
        return F.when(row_filter(rule), F.to_json(F.array(value.cast("string"))))
    if rule.metric == "row_count":
        return F.when(row_filter(rule), "")
    return F.when(fails(rule, schema), "")


_TOKENS = schema_of(rule=INT, token=STRING)


def rule_deltas(changes: DataFrame, batch_id: int, spec: TableSpec, rules: Sequence[Rule], root: str) -> DataFrame:
    """``rule`` (its place), ``token``, ``n_before`` and ``n_after`` of what a batch of changes moves.

    A token is a rule's count, or a value of the column in which a rule looks for repetitions. Under ``root`` are kept the tokens
    of each key's row and how often each token occurs; a batch appends its keys and their old and new values.
    """
    spark = changes.sparkSession
    names = [f"t{i}" for i in range(len(rules))]
    # rules may name columns as they like: tokens are made before anything is renamed
    tokens = [_token(r, changes.schema).alias(n) for n, r in zip(names, rules)]
    key = [f"k{i}" for i in range(len(spec.key))]
    made = changes.select(*[F.col(k).alias(n) for n, k in zip(key, spec.key)], "op", "seq", *tokens)
    rows = row_changes(made, batch_id, row_state(spark, f"{root}/rows", made.schema, key, names), key, names)
    each = F.array(*[F.struct(F.lit(i).alias("rule"), F.col(n).alias("token")) for i, n in enumerate(names)])
    deltas = rows.select("weight", F.explode(each).alias("x")).where("x.token is not null")
    counts = sum_state(spark, f"{root}/tokens", _TOKENS, _TOKENS.fieldNames(), ["n"])
    fold(counts, batch_id)
    moved = running_sums(deltas.select("x.rule", "x.token", F.col("weight").alias("n")), _TOKENS.fieldNames(), ["n"], held_before(counts, batch_id))
    meta = [F.when(F.col("n_after") == 0, DELETE).otherwise("u").alias("op"), F.lit(batch_id).cast("bigint").alias("seq")]
    counts.append_batch(moved.select(*meta, F.lit(None).cast("timestamp_ntz").alias("ts"), "rule", "token", F.col("n_after").alias("n"), "n_before"), batch_id)
    return counts.batch(batch_id).select("rule", "token", "n_before", F.col("n").alias("n_after"))


def _moved(rules: Sequence[Rule]) -> Column:
    """How a change of a token's number changes its rule's value."""
    before, after = F.col("n_before"), F.col("n_after")
    more = after - before
    repeated = (after > 1).cast("bigint") - (before > 1).cast("bigint")
    surplus = F.greatest(after, F.lit(1)) - F.greatest(before, F.lit(1))
    missing = F.col("token") == _NULL
    by_metric = {
        "duplicate_count": F.when(missing, 0).otherwise(repeated),
        "surplus_count": F.when(missing, more).otherwise(surplus),
    }
    moved = more
    for i, rule in enumerate(rules):
        moved = F.when(F.col("rule") == i, by_metric.get(rule.metric, more)).otherwise(moved)
    return moved.cast("bigint")


def start_incremental_scan(
    changes: DataFrame, spec: TableSpec, rules: Sequence[Rule], out: str, checkpoint: str, trigger: Mapping[str, Any]
) -> StreamingQuery:
    """Report on a table after every micro-batch of its change stream, without reading the table.

    Counts of rows, missing and invalid values, and repeated values (``duplicate_count``, ``surplus_count``), with filters, are kept
    by what changes take back and add; other rules, and filters that ask for the current time, raise ``ValueError``. Scan
    *n* is written to ``out`` when batch *n* is done: the values after it, which the next batch starts from, and the
    judged results (``read_scans``). A batch that runs again starts from the same scan and replaces its own.
    """
    if unfit := [r.name for r in rules if not mergeable(r)]:
        raise ValueError(f"these rules need the whole table: {unfit}")
    if others := {r.table for r in rules} - {spec.name}:
        raise ValueError(f"the changes are those of {spec.name}, not of {sorted(others)}")
    spark = changes.sparkSession

    def commit(batch: DataFrame, batch_id: int) -> None:
        moved = rule_deltas(batch, batch_id, spec, rules, f"{out}/_state/{stream_id(spark, checkpoint)}")
        # a row per rule from here on
        sums = moved.select("rule", _moved(rules).alias("value"))
        last = f"{out}/_state/batch={batch_id - 1}"
        if files.exists(spark, last):
            sums = sums.unionAll(spark.read.schema(_STATE).parquet(last))
        new = f"{out}/_state/batch={batch_id}"
        sums.groupBy("rule").agg(F.sum("value").alias("value")).coalesce(1).write.mode("overwrite").parquet(new)
        values = [F.coalesce(F.max(F.when(F.col("rule") == i, F.col("value"))), F.lit(0)).alias(f"v{i}") for i in range(len(rules))]
        found = judged(value_rows(spark.read.schema(_STATE).parquet(new).agg(*values), [(r, f"v{i}") for i, r in enumerate(rules)]))
        stamped = found.withColumn("scan_ts", as_of_column(None)).select(*SCAN_SCHEMA.fieldNames())
        stamped.coalesce(1).write.mode("overwrite").parquet(f"{out}/scan={batch_id}")

    return changes.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(**trigger).start()
