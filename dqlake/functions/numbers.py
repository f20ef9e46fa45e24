"""Numbers, rounding and money.

Rounding is half-to-even on the binary value, so ``round2`` is ``rint(x * 100) / 100``; Spark's own
``round`` is decimal half-up and differs on ties. Money is summed as decimals: a sum of doubles would depend on
the order in which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A plain decimal number. Java's parser also takes '5d' and 'NaN', which are not numbers here.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
SHORT_PATTERN = r"^[+-]?[0-9]{1,15}(\.[0-9]{1,15})?$"  # cannot overflow
MONEY = "decimal(28,2)"
MAX_INT = 2147483647
MONEY_BOUND = 1e25  # amounts below it, and sums of many of them, fit MONEY


def number(c: Column) -> Column:
    """Text to double; null when it is not a finite number. Short plain numbers need one test and one cast."""
    value = c.try_cast("double")
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(c.rlike(SHORT_PATTERN), value).when(c.rlike(NUMBER_PATTERN) & finite, value)


def round2(c: Column) -> Column:
    return F.rint(c * 100) / 100


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, 100 when there is nothing to share."""
    return F.when(whole > 0, round2(part / whole * 100)).otherwise(F.lit(100.0))


def net_amount(quantity: Column, price: Column, discount: Column) -> Column:
    """Of whole units: quantity is truncated, no discount is 0."""
    return round2((quantity - quantity % 1.0) * price * (1.0 - F.coalesce(discount, F.lit(0.0))))


def money_sum(c: Column) -> Column:
    return F.sum(c.cast(MONEY)).cast("double")


def money_avg(c: Column) -> Column:
    return round2(money_sum(c) / F.count(c))
