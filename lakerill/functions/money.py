"""Exact sums of money that stay in long arithmetic.

Spark keeps a sum of decimals of this width as a big number, unpacked and packed again for every row.
Here an amount in cents is split into a high and a low part, both are summed as longs, and the few sums are
put together as decimals at the end. Sums are exact, so they do not depend on the order of the tasks. Amounts
of ordinary sales (up to 100 pieces) leave room for over 10^11 rows per group; past it Spark's ANSI mode, its
default, stops with an overflow error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 17
_HIGH, _LOW = "__high_", "__low_"


def _parts(name: str, price: Column, qty: Column | None) -> dict[str, Column]:
    cents = (price * 100).cast("bigint")
    # floor division and remainder of a power of two, right for negative amounts as well
    high, low = F.shiftright(cents, _LOW_BITS), cents.bitwiseAND((1 << _LOW_BITS) - 1)
    if qty is not None:
        high, low = qty * high, qty * low
    return {_HIGH + name: high, _LOW + name: low}


def money_sums(name: str, price: Column, qty: Column | None = None) -> list[Column]:
    """Aggregates that make up the sum ``name`` of ``qty * price``, for a price of two decimals."""
    return [F.sum(part).alias(alias) for alias, part in _parts(name, price, qty).items()]


def money_again(name: str) -> list[Column]:
    """Aggregates that add up sums made by :func:`money_sums`."""
    return [F.sum(alias).alias(alias) for alias in (_HIGH + name, _LOW + name)]


def money_total(name: str) -> Column:
    """The sum as an exact decimal of two decimals."""
    high = F.col(_HIGH + name).cast("decimal(20,0)") * F.lit(1 << _LOW_BITS)
    return (high + F.col(_LOW + name).cast("decimal(20,0)")) * F.lit(Decimal("0.01"))
