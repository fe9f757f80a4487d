"""Second moments of whole numbers from sums that can be merged without any error.

Sums, sums of squares and of products are decimals, so parts of the data can be added in any order and
grouping with the same result, and one scan gives them all. The mean is split into a whole number and a
remainder, so squares are centred in whole numbers before anything becomes a double: nothing cancels.
Where a sum has more digits than a decimal (squares of numbers near 2**63), Spark's own running
deviation is taken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.rounding import WIDE

_WHOLE = "decimal(19,0)"


def _product(a: Column, b: Column) -> Column:
    return F.try_multiply(a.cast(WIDE), b.cast(WIDE)).cast(WIDE)


def _mean(total: Column, n: Column) -> tuple[Column, Column]:
    """Whole part and remainder of a mean: total = n * whole + rest."""
    whole = F.call_function("div", total, F.nullif(n, F.lit(0)).cast(WIDE)).cast(WIDE)
    return whole, F.try_subtract(total, _product(whole, n))


def _centred(products: Column, x: Column, y: Column, n: Column) -> Column:
    """Sum of (x - mean x)(y - mean y) as a double, from the sums of xy, x and y."""
    (mean_x, rest_x), (mean_y, rest_y) = _mean(x, n), _mean(y, n)
    whole = F.try_subtract(F.try_subtract(products, _product(mean_x, y)), _product(mean_y, rest_x))
    return whole.cast("double") - rest_x.cast("double") * rest_y.cast("double") / n


def _sum(value: Column) -> Column:
    return F.try_sum(value).cast(WIDE)


def deviation(x: Column, scale: int = 1) -> Column:
    """Sample standard deviation of whole numbers, in units of 1/scale; NULL below two values."""
    wide, n = x.cast(_WHOLE), F.count(x)
    squares = _centred(_sum(wide * wide), _sum(wide), _sum(wide), n)
    exact = F.sqrt(F.when(squares > 0, squares).when(squares.isNotNull(), 0.0) / (n - 1))
    return F.when(n > 1, F.coalesce(exact, F.stddev(x.cast("double")))) / F.lit(float(scale))


def correlation(x: Column, y: Column) -> Column:
    """Correlation of two columns of whole numbers over the rows that have both."""
    both = x.isNotNull() & y.isNotNull()
    a, b = (F.when(both, c.cast(_WHOLE)) for c in (x, y))
    n = F.count_if(both)
    sum_a, sum_b = _sum(a), _sum(b)
    spread = (_centred(_sum(a * a), sum_a, sum_a, n) * _centred(_sum(b * b), sum_b, sum_b, n))
    exact = _centred(_sum(a * b), sum_a, sum_b, n) / F.sqrt(spread)
    p, q = a.cast("double"), b.cast("double")
    rough = F.covar_samp(p, q) / F.nullif(F.stddev(p) * F.stddev(q), F.lit(0.0))
    return F.when(spread > 0, exact).when(spread.isNull(), rough)
