"""Type alignment between a source and the lake."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import TableSpec


def to_millis(ts: Column) -> Column:
    """A zone-less timestamp cut to milliseconds, whatever the session's time zone."""
    ts = ts.cast("timestamp_ntz")
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint") % 1000
    return ts - micros * F.expr("interval '0.000001' second")


def align(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast the columns of ``spec`` to their declared types, timestamps to milliseconds.

    Columns the frame lacks become NULL; columns outside the spec stay as they are.
    """
    out = {}
    for field in spec.change_schema.fields:
        if field.name not in df.columns:
            if field.name in spec.columns:
                out[field.name] = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.TimestampNTZType):
            out[field.name] = to_millis(F.col(field.name))
        elif df.schema[field.name].dataType != field.dataType:
            out[field.name] = F.col(field.name).cast(field.dataType)
    return df.withColumns(out) if out else df


def as_of_column(as_of: Column | datetime | str | None) -> Column:
    """The moment a check or a latency is measured at; the wall clock where none is given."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, datetime):
        as_of = as_of.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(as_of, str):
        as_of = F.lit(as_of)
    return as_of.cast("timestamp_ntz")
