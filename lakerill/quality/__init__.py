"""Declarative data quality: rules, reports, failing rows, gates."""

from .report import QualityGateError, gate, missing_profile, report, summary
from .rows import fails, failing_rows, score_of_scans, score_over_time, split
from .rules import MONITOR_RULES, SKU_FORMAT, TABLE_RULES, Rule, load_rules

__all__ = [
    "MONITOR_RULES",
    "SKU_FORMAT",
    "TABLE_RULES",
    "QualityGateError",
    "Rule",
    "fails",
    "failing_rows",
    "gate",
    "load_rules",
    "missing_profile",
    "report",
    "score_of_scans",
    "score_over_time",
    "split",
    "summary",
]
