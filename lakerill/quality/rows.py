"""What makes a single row fail, and operators on the failing rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_of_column, end_anchored
from .rules import ROW_METRICS, Rule


def _limit(value: Any, dtype: T.DataType) -> Column:
    """A bound as a literal that is compared with the column without casting the column."""
    if isinstance(dtype, T.DecimalType) and isinstance(value, (int, float)):
        return F.lit(Decimal(str(value)))
    return F.lit(value)


def invalid(column: str, args: dict[str, Any], dtype: T.DataType) -> Column:
    """Whether a value breaks one of the limits. NULL on NULL: missing values have their own check."""
    c = F.col(column)
    broken = []
    if "regex" in args:
        broken.append(~c.rlike(end_anchored(args["regex"])))
    if "min" in args:
        broken.append(c < _limit(args["min"], dtype))
    if "above" in args:
        broken.append(c <= _limit(args["above"], dtype))
    if "max" in args:
        broken.append(c > _limit(args["max"], dtype))
    if "values" in args:
        broken.append(~c.isin(list(args["values"])))
    if "max_length" in args:
        broken.append(F.length(c) > args["max_length"])
    if not broken:
        raise ValueError(f"nothing makes {column} invalid")
    return reduce(lambda a, b: a | b, broken)


_AS_OF = "__as_of"
#: Quoted text and names, which stay as they are, or the current time.
_NOW = re.compile(
    r"""(?P<quoted>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`)"""
    r"""|(?<![\w.])(?:(?:current_timestamp|localtimestamp)\b(?:\s*\(\s*\))?|now\s*\(\s*\))""",
    re.IGNORECASE,
)


def at_time(expression: str) -> str:
    """An SQL text with the current time replaced by the column that holds ``as_of``."""
    return _NOW.sub(lambda m: m["quoted"] or _AS_OF, expression)


def needs_time(rule: Rule) -> bool:
    return any(at_time(t) != t for t in (rule.filter or "", str(rule.args.get("expr", ""))))


def with_time(df: DataFrame, rules: Iterable[Rule], as_of: Column | datetime | str | None) -> DataFrame:
    """``df`` with the column that stands for the current time, if a rule asks for it."""
    return df.withColumn(_AS_OF, as_of_column(as_of)) if any(map(needs_time, rules)) else df


def row_filter(rule: Rule) -> Column:
    return F.coalesce(F.expr(at_time(rule.filter)), F.lit(False)) if rule.filter else F.lit(True)


def fails(rule: Rule, schema: T.StructType) -> Column:
    """Whether a row fails a row-wise rule; never NULL."""
    if rule.metric not in ROW_METRICS:
        raise ValueError(f"{rule.metric} does not judge single rows")
    if rule.metric == "missing_count":
        bad = F.col(rule.column).isNull()
    else:
        bad = invalid(rule.column, rule.args, schema[rule.column].dataType)
    return F.coalesce(bad & row_filter(rule), F.lit(False))


def judging_rules(rules: Iterable[Rule], table: str | None = None) -> list[Rule]:
    """The rules of a table that judge rows: all but counts of rows and custom metrics."""
    found = [r.as_reference() for r in rules if table in (None, r.table)]
    if table is None and len({r.table for r in found}) > 1:
        raise ValueError("the rules are about several tables; name the one the rows are of")
    return [r for r in found if r.metric in (*ROW_METRICS, *_REPEATS, "orphan_count")]


_REPEATS = ("duplicate_count", "surplus_count")


def _flagged(
    df: DataFrame,
    rules: Sequence[Rule],
    tables: Mapping[str, DataFrame] | None,
    as_of: Column | datetime | str | None,
) -> tuple[DataFrame, list[str]]:
    """``df`` with a column per rule that is true where the row fails it.

    Rules about a row alone are expressions. Repeated values and orphans are found on the columns concerned alone, and then the
    rows are marked by one join (see ``_bad_values``).
    """
    df = with_time(df, rules, as_of)
    flags = [f"__fails{i}" for i in range(len(rules))]
    beyond = {flag: r for flag, r in zip(flags, rules) if r.metric not in ROW_METRICS}
    if beyond:
        bad, columns = _bad_values(df, beyond, tables)
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__value{i}")) for i, c in enumerate(columns)))
        df = df.join(bad, same, "left").drop(*(f"__value{i}" for i in range(len(columns))))
    for flag, rule in zip(flags, rules):
        found = F.coalesce(F.col(flag), F.lit(False)) & row_filter(rule) if flag in beyond else fails(rule, df.schema)
        df = df.withColumn(flag, found)
    return df, flags


def _bad_values(
    df: DataFrame, rules: Mapping[str, Rule], tables: Mapping[str, DataFrame] | None
) -> tuple[DataFrame, list[str]]:
    """What values of the rules' columns occur together and break a rule, with a column per rule; and the columns.

    Repeated values come from one count per value, orphans from the parent's different keys; both are joined with the
    different combinations of values, which have no more columns than the rules name. A value that many rows have is one
    row here, so large partitions of the rows that are joined with it can be split.
    """
    columns = list(dict.fromkeys(r.column for r in rules.values()))
    values = df.select(*(F.col(c).alias(f"__value{i}") for i, c in enumerate(columns))).distinct()
    for flag, rule in rules.items():
        value = F.col(f"__value{columns.index(rule.column)}")
        if rule.metric in _REPEATS:
            counts = df.where(row_filter(rule)).groupBy(F.col(rule.column).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
            known = counts.where("__n > 1").select("__value", F.lit(True).alias("__known"))
            if rule.metric == "duplicate_count":
                known = known.where("__value is not null")
            bad = F.col("__known").isNotNull()
        else:
            parent = (tables or {})[rule.args["parent"]].select(F.col(rule.args["parent_column"]).alias("__value"))
            known = parent.where("__value is not null").distinct().withColumn("__known", F.lit(True))
            bad = value.isNotNull() & F.col("__known").isNull()
        same = value.eqNullSafe(F.col("__value")) if rule.metric == "surplus_count" else value == F.col("__value")
        values = values.join(known, same, "left").withColumn(flag, bad).drop("__value", "__known")
    return values.where(_any(list(rules))), columns


def _any(flags: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, map(F.col, flags), F.lit(False))


def failing_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    table: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    as_of: Column | datetime | str | None = None,
) -> DataFrame:
    """Rows that fail a rule, with the names of all rules they fail in ``failed_rules``.

    Missing and invalid values, repeated values (every row that has one) and orphans (``tables`` holds the parents) count;
    counts of rows and custom metrics judge no row. ``table`` names the table where the rules are about several;
    ``as_of`` stands for the current time in filters.
    """
    rules = judging_rules(rules, table)
    flagged, flags = _flagged(df, rules, tables, as_of)
    names = F.array_compact(F.array(*[F.when(F.col(f), F.lit(r.name)) for f, r in zip(flags, rules)]))
    return flagged.where(_any(flags)).select(*df.columns, names.cast("array<string>").alias("failed_rules"))


def split(
    df: DataFrame,
    rules: Sequence[Rule],
    table: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    as_of: Column | datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``df`` as (good rows, quarantined rows); every row is in exactly one of them. Arguments as in ``failing_rows``."""
    flagged, flags = _flagged(df, judging_rules(rules, table), tables, as_of)
    bad = _any(flags)
    return flagged.where(~bad).select(*df.columns), flagged.where(bad).select(*df.columns)


def score_over_time(
    df: DataFrame,
    rules: Sequence[Rule],
    ts: str,
    unit: str = "DAY",
    table: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    as_of: Column | datetime | str | None = None,
) -> DataFrame:
    """Share of rows per time unit that fail no rule. Arguments as in ``failing_rows``."""
    flagged, flags = _flagged(df, judging_rules(rules, table), tables, as_of)
    ok = F.count_if(~_any(flags))
    rows = F.count(F.lit(1))
    return (
        flagged.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias("period"))
        .agg(ok.alias("ok_rows"), rows.alias("n_rows"))
        .withColumn("score", F.col("ok_rows") / F.col("n_rows"))
    )


def score_of_scans(scans: DataFrame, window: str = "1 day") -> DataFrame:
    """Share of checks that passed, per window of the scans' time."""
    passed = F.count_if("passed").alias("n_passed")
    counts = scans.groupBy(F.window("scan_ts", window).alias("w")).agg(passed, F.count(F.lit(1)).alias("n_checks"))
    return counts.select(
        F.col("w.start").cast("timestamp_ntz").alias("period"), "n_passed", "n_checks", (F.col("n_passed") / F.col("n_checks")).alias("score")
    )
