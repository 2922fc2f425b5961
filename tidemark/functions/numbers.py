"""Rounding that agrees with the engines and browsers that show the numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 0) -> Column:
    """Round a non-negative DOUBLE on its binary value, not on its decimal text."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / F.lit(scale)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, NULL where `whole` is 0."""
    return round_half_up(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def one_decimal(value: Column) -> Column:
    """`value` in 0..100 to one decimal place, judged on the exact binary fraction.

    A double prints 0.15 but lies a little below it, so it has to become 0.1. Scaled by
    2^57 the fraction is a whole number, and the comparison with one half is exact.
    """
    whole = F.floor(value)
    fraction = ((value - whole) * float(2**57)).cast("bigint")
    tenths = F.shiftright(fraction * 20 + 2**57, 58)
    return (whole * 10 + tenths) / F.lit(10.0)
