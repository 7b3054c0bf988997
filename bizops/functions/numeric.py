"""Rounding, guards and ratios as native column expressions.

Two rounding rules are in use on purpose: ``F.round`` (half away from zero) for the SQL style
reports and ``F.bround`` (half to even) for the data-frame style ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(16,4)"


def money(col: Column | str) -> Column:
    """One line's amount; 16 digits keep row arithmetic on machine longs."""
    return _col(col).cast(MONEY)


def dbl(col: Column | str) -> Column:
    return _col(col).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` in double, null where the denominator is zero."""
    return F.try_divide(dbl(num), dbl(den))


def percent(num: Column | str, den: Column | str, decimals: int = 1) -> Column:
    """``100 * num / den`` rounded half away from zero."""
    return F.round(F.try_divide(F.lit(100.0) * dbl(num), dbl(den)), decimals)


def percent_even(num: Column | str, den: Column | str, decimals: int = 1) -> Column:
    """``num / den * 100`` rounded half to even."""
    return F.bround(ratio(num, den) * 100, decimals)


def zero_to_one(col: Column | str) -> Column:
    c = _col(col)
    return F.when(c == 0, F.lit(1.0)).otherwise(c)


def not_below_zero(col: Column) -> Column:
    """Clip at zero, keeping nulls null."""
    return F.when(col < 0, F.lit(0).cast("double")).otherwise(col)


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_where(cond: Column, value: Column | str) -> Column:
    """Conditional sum, zero where nothing matches."""
    return F.coalesce(F.sum(F.when(cond, _col(value))), F.lit(0))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
