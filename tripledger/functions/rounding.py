"""Rounding that gives the same digits in any engine and any row order.

Averages and rates are ratios of whole numbers, so they are rounded half-up in whole-number
arithmetic and turned into a double in the last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000
WIDE = "decimal(38,0)"


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """numerator / denominator, half-up to ``places`` digits, NULL when the denominator is 0.

    Both sides are whole numbers; the denominator is not negative. Decimal arithmetic, so a sum
    over a trillion rows cannot overflow a long.
    """
    num, den = numerator.cast(WIDE), F.nullif(denominator.cast(WIDE), F.lit(0).cast(WIDE))
    scale = F.lit(2 * 10**places).cast("decimal(12,0)")
    quotient = F.call_function("div", F.abs(num) * scale + den, den * F.lit(2))
    return F.signum(num) * quotient.cast("double") / F.lit(float(10**places))


def pct(part: Column, whole: Column, places: int = 4) -> Column:
    return ratio(part * F.lit(100), whole, places)


def micro(value: Column) -> Column:
    """A value rounded to six places, as whole millionths. NaN and infinity become NULL.

    ``rint`` is one machine instruction; ``round`` on a double goes through a decimal object.
    """
    return F.rint(value * F.lit(float(MICRO))).try_cast("bigint")


def from_micro(units: Column) -> Column:
    return units.cast("double") / F.lit(float(MICRO))


def wide_sum(value: Column) -> Column:
    return F.sum(value.cast(WIDE))
