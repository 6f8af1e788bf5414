"""Division and rounding as the marts define them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Rounded to no decimals, halves away from zero."""
    return F.round(value, 0)


def mean_cost(total: Column, count: Column) -> Column:
    """``total / count`` without truncation; NULL for a zero count."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def whole_ratio(left: Column, right: Column) -> Column:
    """Integer division that drops the remainder; NULL for a zero divisor."""
    return F.call_function("div", left, F.nullif(right, F.lit(0)))
