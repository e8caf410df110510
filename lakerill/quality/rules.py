"""Quality rules as data, the two standing rule sets, and the loader for rules written in YAML."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from typing import Any

METRICS = (
    "row_count",
    "missing_count",
    "duplicate_count",  # distinct values that occur more than once
    "surplus_count",  # rows beyond the distinct values, NULLs included
    "invalid_count",  # args: regex, min, max, values, max_length, or values_table and values_column; NULL is never invalid
    "orphan_count",  # args: parent, parent_column
    "custom",  # args: expr, any aggregate expression
)
ROW_METRICS = ("missing_count", "invalid_count")
COMPARISONS = ("=", "!=", ">", ">=", "<", "<=")


@dataclass(frozen=True)
class Rule:
    """A metric of a table with the comparison it has to satisfy."""

    table: str
    name: str
    metric: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)
    filter: str | None = None
    comparison: str = "="
    threshold: float = 0.0

    def __post_init__(self):
        if self.metric not in METRICS:
            raise ValueError(f"unknown metric {self.metric!r}")
        if self.comparison not in COMPARISONS:
            raise ValueError(f"unknown comparison {self.comparison!r}")

    def as_reference(self) -> Rule:
        """A rule whose valid values are a table's column is one about references; any other stays as it is."""
        if self.metric != "invalid_count" or "values_table" not in self.args:
            return self
        if set(self.args) != {"values_table", "values_column"}:
            raise ValueError(f"{self.name}: values of a table go with no other limit; make two rules")
        parent = {"parent": self.args["values_table"], "parent_column": self.args["values_column"]}
        return replace(self, metric="orphan_count", args=parent)


def _some(table: str, name: str, metric: str = "row_count", **kw: Any) -> Rule:
    return Rule(table, name, metric, comparison=">", threshold=0, **kw)


def _none(table: str, name: str, metric: str, column: str, **args: Any) -> Rule:
    return Rule(table, name, metric, column, args)


# The SKU format, the limits, and the names of the standing checks.
SKU_FORMAT = r"^P-[0-9]{3}$"
LAST_DAY = "sale_ts >= current_timestamp - interval '24' hour"

#: Twelve checks of the recurring scan.
MONITOR_RULES: tuple[Rule, ...] = (
    _some("products", "Row count"),
    _some("sales", "Row count"),
    _none("products", "Null IDs", "missing_count", "id"),
    _none("products", "Null SKUs", "missing_count", "sku"),
    _none("products", "Duplicate SKUs", "surplus_count", "sku"),
    _none("products", "Invalid SKU format", "invalid_count", "sku", regex=SKU_FORMAT),
    _none("sales", "Null quantities", "missing_count", "qty"),
    _none("sales", "Non-positive quantities", "invalid_count", "qty", above=0),
    _none("sales", "Null prices", "missing_count", "price"),
    _none("sales", "Non-positive prices", "invalid_count", "price", above=0),
    _none("sales", "Excessive quantities", "invalid_count", "qty", max=100),
    _some("sales", "Recent sales (24h)", filter=LAST_DAY),
)

#: Twenty declared rules of the two tables.
TABLE_RULES: tuple[Rule, ...] = (
    _some("products", "Products table has data"),
    _none("products", "Product ID cannot be null", "missing_count", "id"),
    _none("products", "Product SKU cannot be null", "missing_count", "sku"),
    _none("products", "Product name cannot be null", "missing_count", "name"),
    _none("products", "Product SKU must be unique", "duplicate_count", "sku"),
    _none("products", "Product ID must be unique", "duplicate_count", "id"),
    _none("products", "SKU follows correct format (P-XXX)", "invalid_count", "sku", regex=r"^P-\d{3}$"),
    _some("sales", "Sales table has data"),
    _none("sales", "Sale ID cannot be null", "missing_count", "id"),
    _none("sales", "Product ID reference cannot be null", "missing_count", "product_id"),
    _none("sales", "Quantity cannot be null", "missing_count", "qty"),
    _none("sales", "Price cannot be null", "missing_count", "price"),
    _none("sales", "Sale timestamp cannot be null", "missing_count", "sale_ts"),
    _none("sales", "Quantity must be positive", "invalid_count", "qty", min=1),
    _none("sales", "Price must be positive", "invalid_count", "price", min=0.01),
    _none("sales", "Quantity should be reasonable (max 100)", "invalid_count", "qty", max=100),
    _none("sales", "Price should be reasonable (max $10,000)", "invalid_count", "price", max=10000.00),
    _none("sales", "Sale ID must be unique", "duplicate_count", "id"),
    _some("sales", "Recent sales exist (within 24 hours)", filter=LAST_DAY),
    _none("sales", "Product ID must reference valid product", "invalid_count", "product_id", values=[1, 2, 3, 4]),
)

_CHECK = re.compile(r"^(\w+)(?:\(\s*(\w+)\s*\))?\s*(>=|<=|!=|=|>|<)\s*(-?[\d.]+)$")
_VALID = {
    "valid regex": "regex",
    "valid min": "min",
    "valid max": "max",
    "valid values": "values",
    "valid max length": "max_length",
}


def load_rules(text: str) -> list[Rule]:
    """Rules from a YAML document of ``checks for <table>:`` lists."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading rules from YAML needs PyYAML; pass Rule objects instead") from e
    rules = []
    for heading, checks in (yaml.safe_load(text) or {}).items():
        table = heading.removeprefix("checks for ").strip()
        for check in checks:
            (head, detail), = check.items() if isinstance(check, dict) else [(check, None)]
            found = _CHECK.match(head.strip())
            if not found:
                raise ValueError(f"cannot read check {head!r}")
            metric, column, comparison, threshold = found.groups()
            detail = detail or {}
            if unknown := set(detail) - {"name", "filter", *_VALID}:
                raise ValueError(f"{head!r} has details that are not known: {sorted(unknown)}")
            args = {_VALID[k]: v for k, v in detail.items() if k in _VALID}
            rules.append(
                Rule(
                    table,
                    detail.get("name", head.strip()),
                    metric,
                    column,
                    args,
                    detail.get("filter"),
                    comparison,
                    float(threshold),
                )
            )
    return rules
