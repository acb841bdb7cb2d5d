"""Exact two-digit results.

Measures are decimals. Sums stay exact, averages keep four digits more than
their input before the final rounding, and only the rounded value becomes a
double, so a result does not depend on how rows were spread over partitions.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# digits before the point that a sum of measures may need (10^20 cents)
_SUM_DIGITS = 20


def published(value: Column, digits: int = 2) -> Column:
    """Half-up rounding on the decimal, then a double for the caller."""
    return F.round(value, digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal division that gives NULL for a zero or missing divisor."""
    return F.try_divide(numerator, denominator)


def count_as_decimal(count: Column) -> Column:
    return count.cast("decimal(20,0)")


def squared_units(value: Column, scale: int) -> Column:
    """The square of a decimal measure, counted in units of its last digit: a whole number, so sums of it are exact."""
    units = (value * 10**scale).cast("decimal(14,0)")
    return (units * units).cast("decimal(28,0)")


def deviation_of_parts(total: Column, squares: Column, count: Column, scale: int) -> Column:
    """Population standard deviation from the sum, the sum of :func:`squared_units` and the count.

    The squared distance from the mean's whole part is exact; only then do
    doubles come in, so rows may be added up in any order and over any periods.
    """
    n = F.nullif(count_as_decimal(count), F.lit(0).cast("decimal(20,0)"))
    units = (total.cast(f"decimal({_SUM_DIGITS + scale},{scale})") * 10**scale).cast("decimal(28,0)")
    whole = F.call_function("div", units, n).cast("decimal(19,0)")
    rest = (units - (whole * n).cast("decimal(38,0)")).cast("decimal(20,0)")
    around = squares - (whole * units).cast("decimal(38,0)") - (whole * rest).cast("decimal(38,0)")
    count_ = n.cast("double")
    variance = around.cast("double") / count_ - F.pow(rest.cast("double") / count_, F.lit(2))
    return F.round(F.sqrt(F.greatest(variance, F.lit(0.0))) / 10**scale, 2)


def mean_of_parts(total: Column, count: Column, scale: int) -> Column:
    """Average from a summed total and a summed count.

    Gives what ``avg`` over the single rows gives for a measure of that scale,
    so rows can be added up per station before a join.
    """
    exact = ratio(total.cast(f"decimal({_SUM_DIGITS + scale},{scale})"), count_as_decimal(count))
    return exact.cast(f"decimal(38,{scale + 4})")
