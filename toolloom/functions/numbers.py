"""Rounding of the binary number that a double is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float((1 << 27) + 1)


def _halves(x: Column) -> tuple[Column, Column]:
    """A double as the sum of two of 26 bits each."""
    wide = x * _SPLIT
    upper = wide - (wide - x)
    return upper, x - upper


def round_half_even(x: Column, places: int) -> Column:
    """The double nearest to x's exact binary value rounded to so many places, halves to even: Python's ``round``.

    x * 10^places is taken as product and error, whose sum is exact (Dekker), so a product that only
    looks like a half is told from one that is. Values without a fraction left, NaN and the infinities stay.
    """
    scale = 10.0**places
    product = x * scale
    (a, b), (c, d) = _halves(x), _halves(F.lit(scale))
    error = ((a * c - product) + a * d + b * c) + b * d
    small = F.abs(product) < float(1 << 52)
    whole = F.floor(F.when(small, product)).cast("double")
    rest = product - whole - 0.5
    odd = F.pmod(whole, F.lit(2.0)) == 1
    up = (rest > 0) | (rest == 0) & ((error > 0) | (error == 0) & odd)
    return F.when(small & ~F.isnan(x), (whole + F.when(up, 1.0).otherwise(0.0)) / scale).otherwise(x)
