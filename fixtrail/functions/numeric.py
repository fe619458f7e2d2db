"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rounding NumPy applies to doubles."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
