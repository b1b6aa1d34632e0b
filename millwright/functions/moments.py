"""Mean and deviation of whole numbers from exact sums.

The count, the sum and the sum of squares are whole numbers, so they come out the same in
whatever order rows arrive, and those of parts add up to those of the whole. A deviation
made from them has the same bits every time.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"


def count_of(x: Column) -> Column:
    return F.count(x)


def sum_of(x: Column) -> Column:
    return F.sum(x.cast("decimal(19,0)")).cast(WHOLE)


def squares_of(x: Column) -> Column:
    return F.sum(x.cast("decimal(19,0)") * x.cast("decimal(19,0)")).cast(WHOLE)


def mean(n: Column, s1: Column) -> Column:
    return s1.cast("double") / F.nullif(n, F.lit(0)).cast("double")


def deviation(n: Column, s1: Column, s2: Column) -> Column:
    """The population's standard deviation; NULL without rows.

    The variance's numerator n * s2 - s1 * s1 is exact as long as it has 38 digits, which
    any count and values of up to 10**9 have; beyond, it is the nearest in doubles.
    """
    count = n.cast("decimal(19,0)")
    exact = F.try_subtract(F.try_multiply(count, s2), F.try_multiply(s1, s1)).cast("double")
    n2, d1, d2 = n.cast("double") * n.cast("double"), s1.cast("double"), s2.cast("double")
    spread = F.coalesce(exact, n.cast("double") * d2 - d1 * d1)
    return F.when(n > 0, F.sqrt(F.greatest(spread, F.lit(0.0)) / n2))
