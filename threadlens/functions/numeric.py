"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(col: Column, digits: int) -> Column:
    """Round half to even on the decimal value."""
    return F.bround(col, digits)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 where the denominator is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def fixed2(col: Column) -> Column:
    """Two-decimal text of a number."""
    return F.format_string("%.2f", half_even(col.cast("double"), 2))
