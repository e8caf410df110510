"""Predicates whose exact meaning matters to more than one operator."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def end_anchored(pattern: str) -> str:
    r"""The pattern with a closing ``$`` as ``\z``: Java's ``$`` also matches before a last newline."""
    if re.search(r"(?<!\\)(?:\\\\)*\$$", pattern):
        return pattern[:-1] + r"\z"
    return pattern


def same_key(left: str, right: str, key: Iterable[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key],
    )


def newer(left: str, right: str, order: Sequence[str]) -> Column:
    """Whether the row aliased ``left`` is newer than the one aliased ``right``; a NULL is older than any value."""
    return F.struct(*[F.col(f"{left}.{c}") for c in order]) > F.struct(*[F.col(f"{right}.{c}") for c in order])
