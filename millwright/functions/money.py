"""Money and ratio arithmetic that does not depend on the order of rows.

A sum of doubles depends on the order in which partitions arrive. Amounts are
therefore summed as decimals of ten places, which hold any amount below 1e20 as it
is written. What a decimal cannot hold (larger, infinite or not a number) is summed
as double beside it and added, so no amount ever leaves a total unseen. Ratios are
rounded half-up through decimals.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(30,10)"
LARGEST = 1e20


def _fits(amount: Column) -> Column:
    return F.abs(amount) < LARGEST


def exact_sum(amount: Column) -> Column:
    """Sum of the amounts that a decimal holds; NULL without any."""
    return F.sum(F.when(_fits(amount), amount.cast(EXACT)))


def rest_sum(amount: Column) -> Column:
    """Sum, as double, of the amounts that a decimal cannot hold; NULL without any."""
    return F.sum(F.when(~_fits(amount), amount.cast("double")))


def total(exact: Column, rest: Column) -> Column:
    """The whole sum from its two parts, as double; NULL without any amount."""
    return F.coalesce(exact.cast("double") + rest, exact.cast("double"), rest)


def mean(exact: Column, rest: Column, n: Column) -> Column:
    """The whole sum over a count, as double; NULL for an empty count."""
    return total(exact, rest) / F.nullif(n, F.lit(0)).cast("double")


def rounded_mean(exact: Column, rest: Column, n: Column, scale: int = 2) -> Column:
    """The mean rounded half-up: exactly, as long as all amounts fit a decimal."""
    quotient = exact / F.nullif(n, F.lit(0)).cast("decimal(18,0)")
    plain = F.round(mean(exact, rest, n), scale)
    return F.when(rest.isNull(), F.round(quotient, scale).cast("double")).otherwise(plain)


def half_up(num: Column, den: Column, scale: int) -> Column:
    """Integer ratio rounded half-up; NULL for an empty denominator.

    The quotient carries 18 decimals, enough to tell a tie from a near-tie for
    any denominator below 10**13.
    """
    quotient = num.cast("decimal(20,0)") / F.nullif(den, F.lit(0)).cast("decimal(18,0)")
    return F.round(quotient, scale)


def unit_cost(amount: Column, quantity: Column) -> Column:
    """Amount per unit to the cent: 0 without a positive quantity, NULL without an amount.

    An amount that no decimal holds has no unit cost to the cent either: NULL.
    """
    quotient = F.when(_fits(amount), amount.cast("decimal(30,10)")) / quantity.cast("decimal(10,0)")
    return F.when(quantity > 0, F.round(quotient, 2).cast("decimal(32,2)")).otherwise(
        F.lit(0).cast("decimal(32,2)")
    )
