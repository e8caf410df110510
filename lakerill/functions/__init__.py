"""Column expressions shared by the operators."""

from .casts import align, as_of_column, to_millis
from .draws import draw
from .money import money_again, money_sums, money_total
from .predicates import end_anchored, newer, same_key
from .skew import MAX_HOT_KEYS, hot_keys

__all__ = [
    "MAX_HOT_KEYS",
    "align",
    "as_of_column",
    "draw",
    "end_anchored",
    "hot_keys",
    "money_again",
    "money_sums",
    "money_total",
    "newer",
    "same_key",
    "to_millis",
]
