"""Number rules that differ from Spark's defaults."""

from pyspark.sql import functions as F


def big(col):
    """Widen to a 38-digit integer before summing or multiplying byte counts."""
    return F.col(col).cast("decimal(38,0)") if isinstance(col, str) else col.cast("decimal(38,0)")


def int_div(left, right):
    """Integer division, truncating towards zero."""
    return F.call_function("div", left, right)


def round_long(col):
    """Numeric to bigint, half away from zero."""
    return F.round(col, 0).cast("bigint")


def two_decimals(col):
    """Fixed two-decimal text, for sinks only."""
    return F.format_string("%.2f", col)


def count_when(condition):
    """Number of rows meeting ``condition``; 0 if none."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def sum_when(condition, value):
    """Sum of ``value`` over rows meeting ``condition``; null if none."""
    return F.sum(F.when(condition, value))


def round_div(numerator, denominator):
    """Exact quotient rounded half away from zero, for a positive denominator.

    Works on whole numbers only, so no digit is lost before the rounding.
    """
    half_up = lambda n: int_div(n * 2 + denominator, denominator * 2)
    return F.when(numerator < 0, -half_up(-numerator)).otherwise(half_up(numerator))
