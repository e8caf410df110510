"""Quality reports: all rules of a table in few scans, one result row per rule."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import orphan_counts
from .rows import at_time, invalid, with_time
from .rules import COMPARISONS, Rule

#: What analysis and arguments can get wrong; it stays with the rule.
_NOT_ANSWERABLE = (AnalysisException, ParseException, KeyError, ValueError)
#: A filter that can only compare columns and literals can't fail while it runs.
_CAN_FAIL = re.compile(r"[/%(\[]|\bcast\b", re.IGNORECASE)


class QualityGateError(RuntimeError):
    """Raised by :func:`gate` when rules fail."""

    def __init__(self, failed: list[str]):
        super().__init__("quality rules failed: " + ", ".join(failed))
        self.failed = failed


def _can_fail(rule: Rule) -> bool:
    """Whether a rule's own text may raise an error while it runs (a division by zero, a bad cast)."""
    return rule.metric == "custom" or bool(rule.filter and _CAN_FAIL.search(rule.filter))


def _check_pattern(spark: SparkSession, rule: Rule) -> None:
    if "regex" in rule.args:
        try:
            spark.sparkContext._jvm.java.util.regex.Pattern.compile(rule.args["regex"])
        except Exception as e:
            raise ValueError(f"{rule.name}: no regular expression: {rule.args['regex']!r}") from e


def _in_one_pass(rule: Rule) -> bool:
    return rule.metric in ("row_count", "missing_count", "invalid_count") or (
        rule.metric == "custom" and not rule.filter
    )


def _measure(rule: Rule, df: DataFrame) -> Column:
    """The rule's value as an aggregate over the table."""
    if rule.metric == "custom":
        return F.expr(at_time(rule.args["expr"]))
    if rule.metric == "row_count":
        counted = F.lit(True)
    elif rule.metric == "missing_count":
        counted = F.col(rule.column).isNull()
    else:
        counted = invalid(rule.column, rule.args, df.schema[rule.column].dataType)
    if rule.filter:
        counted = F.expr(at_time(rule.filter)) & counted
    return F.count_if(counted)


def _filtered(df: DataFrame, rule: Rule) -> DataFrame:
    return df.where(F.expr(at_time(rule.filter))) if rule.filter else df


def _values(df: DataFrame, rule: Rule) -> DataFrame:
    """Duplicate measures of a column, from one count per distinct value (counted before the shuffle)."""
    per_value = _filtered(df, rule).groupBy(rule.column).agg(F.count(F.lit(1)).alias("n"))
    present = F.col(rule.column).isNotNull()
    return per_value.agg(
        F.count_if(present & (F.col("n") > 1)).alias("duplicate_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count_if(present)).alias("surplus_count"),
    )


def _answerable(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> bool:
    """Whether Spark can analyse the rule's plan; nothing runs."""
    try:
        _check_pattern(df.sparkSession, rule)
        _table_parts(df, [rule], tables)
    except _NOT_ANSWERABLE:
        return False
    return True


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_rows(measured: DataFrame, rules: Sequence[tuple[Rule, str]], error: bool = False) -> DataFrame:
    """One row per rule from a one-row frame that holds each rule's value in the column named with it."""
    cells = ", ".join(
        f"struct({_text_literal(r.table)} as `table`, {_text_literal(r.name)} as check_name,"
        f" cast({value} as double) as value, {float(r.threshold)!r}D as threshold,"
        f" '{r.comparison}' as comparison, {str(error).lower()} as broken)"
        for r, value in rules
    )
    return measured.selectExpr(f"inline(array({cells}))")


def judged(results: DataFrame) -> DataFrame:
    outcomes = " ".join(f"when '{c}' then value {c} threshold" for c in COMPARISONS)
    return results.selectExpr(
        "`table`", "check_name", "value", "threshold", f"coalesce(case comparison {outcomes} end, false) as passed", "broken"
    ).selectExpr(
        "`table`",
        "check_name",
        "value",
        "threshold",
        "passed",
        "case when broken then 'ERROR' when passed then 'PASS' else 'FAIL' end as status",
    )


def _together(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    measured = df.agg(*[_measure(r, df).alias(f"v{i}") for i, r in enumerate(rules)])
    return value_rows(measured, [(r, f"v{i}") for i, r in enumerate(rules)])


def _alone(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    if rule.metric == "orphan_count":
        parent, parent_key = tables[rule.args["parent"]], rule.args["parent_column"]
        orphans = orphan_counts(_filtered(df, rule), parent, rule.column, parent_key)
        value = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("v"))
    else:
        value = _filtered(df, rule).agg(_measure(rule, df).alias("v"))
    return value_rows(value, [(rule, "v")])


def _duplicates(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return value_rows(_values(df, rules[0]), [(r, r.metric) for r in rules])


def _table_parts(df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    parts = []
    shared = [r for r in rules if _in_one_pass(r)]
    if shared:
        parts.append(_together(df, shared))
    by_column: dict[tuple, list[Rule]] = {}
    for rule in rules:
        if rule.metric in ("duplicate_count", "surplus_count"):
            by_column.setdefault((rule.column, rule.filter), []).append(rule)
        elif rule not in shared:
            parts.append(_alone(df, rule, tables))
    return parts + [_duplicates(df, same) for same in by_column.values()]


def report(
    tables: Mapping[str, DataFrame],
    rules: Sequence[Rule],
    as_of: Column | datetime | str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """One row ``(table, check_name, value, threshold, passed, status)`` per rule.

    Counts, ranges, formats and custom metrics of a table share one scan of the columns they need;
    each column checked for duplicates and each reference adds one aggregation. A rule that cannot be
    evaluated (no such table or column, a malformed expression or pattern, no limits, a failure while it runs) is a row with
    status ``ERROR``, so it counts as not passed. Custom metrics, and filters that compute, are evaluated when the report
    is made; everything else when its rows are asked for. ``as_of`` stands for the current time in filters and expressions.
    """
    session = spark or next(iter(tables.values())).sparkSession
    rules = [r.as_reference() for r in rules]
    parts: list[DataFrame] = []
    broken: list[Rule] = []
    for table in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == table]
        df = tables.get(table)
        if df is None:
            broken += mine
            continue
        df = with_time(df, mine, as_of)
        good = mine
        try:
            for r in mine:
                _check_pattern(session, r)
            _table_parts(df, mine, tables)
        except _NOT_ANSWERABLE:  # find out which rules the table cannot answer
            good = [r for r in mine if _answerable(df, r, tables)]
            broken += [r for r in mine if r not in good]
        parts += _table_parts(df, [r for r in good if not _can_fail(r)], tables)
        found, failed = _tried(df, [r for r in good if _can_fail(r)], tables)
        parts += found
        broken += failed
    if broken:
        parts.append(value_rows(session.range(1), [(r, "null") for r in broken], error=True))
    return judged(reduce(DataFrame.unionAll, parts))


def _tried(
    df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame]
) -> tuple[list[DataFrame], list[Rule]]:
    """Values of rules that may fail while they run, evaluated now, and the rules that did fail.

    All together at first; if that fails, one by one, which finds the culprits.
    """
    if not rules:
        return [], []

    def values(some: Sequence[Rule]) -> list[DataFrame]:
        # a row per rule reaches the driver
        rows = [r for part in _table_parts(df, some, tables) for r in part.collect()]
        by_name = {(r["table"], r["check_name"]): r["value"] for r in rows}
        held = [by_name[r.table, r.name] for r in some]
        shown = [("null" if v is None else f"double('{v!r}')") for v in held]
        return [value_rows(df.sparkSession.range(1), list(zip(some, shown)))]

    try:
        return values(rules), []
    except (PySparkException, ArithmeticError):
        found: list[DataFrame] = []
        failed = []
        for rule in rules:
            try:
                found += values([rule])
            except (PySparkException, ArithmeticError):
                failed.append(rule)
        return found, failed


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values of every column, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "missing")


def summary(results: DataFrame) -> DataFrame:
    """One row: checks in total, passed and failed, the verdict, and the failed names in order."""
    failed_names = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.concat("table", F.lit(": "), "check_name"))))
    counted = results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(failed_names, "; ").alias("failed_checks"),
    )
    verdict = F.when(F.col("failed") == 0, "All data quality checks PASSED").otherwise(
        F.format_string("%d checks FAILED", F.col("failed"))
    )
    return counted.withColumn("verdict", verdict)


def gate(results: DataFrame) -> None:
    """Stop the job with :class:`QualityGateError` unless every rule passed."""
    failed = [f"{r['table']}: {r['check_name']}" for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise QualityGateError(sorted(failed))
