"""Operators on change logs, lake tables and their rows."""

from .images import HOT_ROWS, before_after, changelog_kinds
from .joins import orphan_counts, totals_by_dimension
from .lake import Base, Batch, LogTable
from .state import (
    dedup,
    latest_by_window,
    latest_state,
    merge,
    net_changes,
    op_counts,
    reconcile,
)
from .tables import ctas, cvas, evolve, insert_rows, memory_table

__all__ = [
    "HOT_ROWS",
    "Base",
    "Batch",
    "LogTable",
    "before_after",
    "changelog_kinds",
    "ctas",
    "cvas",
    "dedup",
    "evolve",
    "insert_rows",
    "latest_by_window",
    "latest_state",
    "memory_table",
    "merge",
    "net_changes",
    "op_counts",
    "orphan_counts",
    "reconcile",
    "totals_by_dimension",
]
