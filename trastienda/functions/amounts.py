"""Money and ratios. Money is decimal up to the last step, ratios are double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
COST = "decimal(12,2)"
RATE = "decimal(12,4)"
DERIVED = "decimal(24,6)"
TOTAL = "decimal(38,6)"
TAX_FACTOR = 1.16


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double, NULL instead of an error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(ratio(numerator * F.lit(100), denominator), digits)


def percent_change(now: Column, before: Column, digits: int = 2) -> Column:
    return percent(now - before, before, digits)


def without_tax(amount: Column) -> Column:
    """The net price if the amount already holds the 16 % tax."""
    return amount.cast("double") / F.lit(TAX_FACTOR)
